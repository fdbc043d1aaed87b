"""Explicit schemas of the landed files and messages (fixed values)."""

from __future__ import annotations

FLIGHT = (
    "aircraft_msn string, flight_id string, event_timestamp timestamp, engine_1_temp double, engine_2_temp double, "
    "engine_1_pressure double, engine_2_pressure double, engine_1_vibration double, engine_2_vibration double, "
    "fuel_flow_rate double, altitude double, speed double, external_temp double, wind_speed double, wind_direction double"
)
USAGE = (
    "aircraft_msn string, date date, takeoffs int, landings int, flight_hours double, apu_cycles int, apu_hours double"
)
MAINTENANCE = (
    "aircraft_msn string, component_id string, event_timestamp timestamp, event_type string, description string, "
    "action_taken string, technician string, duration_hours double, is_scheduled boolean"
)
ALERT = (
    "aircraft_msn string, component_id string, event_timestamp timestamp, alert_code string, severity string, message string"
)
MESSAGE = (
    "message_id string, sender_id string, content string, timestamp bigint, game_id string, channel_id string, "
    "recipients array<string>, is_friends map<string,boolean>, "
    "metadata struct<game_type:string,sender_level:int,game_context:string>"
)
_VERDICT = "struct<toxicity_score:double,uncertainty:double,timestamp:bigint,decision:string>"
CLASSIFIED = f"{MESSAGE}, classification {_VERDICT}"
ANALYSED = f"{CLASSIFIED}, deep_analysis {_VERDICT}"
MODERATED = f"{ANALYSED}, moderation struct<decision:string,reason:string,moderator_id:string,timestamp:bigint>"
ABNORMAL_PARAMETERS = "array<struct<parameter:string,value:double,mean:double,std:double,deviation:double>>"
