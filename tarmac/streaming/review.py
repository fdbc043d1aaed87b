"""The bounded review queue as continuous state.

Messages are dealt to lanes by their id. A lane keeps its newest waiting messages in keyed state, at most as many as the
whole queue may hold, so the newest of all lanes together are the newest of the stream: no lane needs the others, and the
state has a fixed size whatever the stream brings. After every micro-batch that touches a lane, its content is sent on
as a numbered snapshot; ``current_queue`` reads the last ones.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SNAPSHOT = "lane int, version long, message_id string, arrival long, payload string"
# a lane's messages as a JSON list of [message_id, arrival, payload, since]
LANE_STATE = "waiting string, version long"


def newest_waiting(length: int, ttl_ms: int | None = None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Keeps the newest ``length`` waiting messages of a lane; a decision takes its message out.

    An id that waits already is not taken again. Of equal arrivals the larger id is newer. A message decided in the micro-batch
    that brings it does not wait; one that was decided or pushed out before waits again only if it is sent again and is new
    enough. With ``ttl_ms`` a message that has waited that long leaves with the next micro-batch that reaches its lane (a timer would
    keep a run over what is available from ending).
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stored, version = state.get if state.exists else ("[]", 0)
        now = state.getCurrentProcessingTimeMs()
        alive = lambda since: ttl_ms is None or since + ttl_ms > now
        kept = {ident: entry for ident, *entry in json.loads(stored) if alive(entry[2])}
        decided: set[str] = set()
        # the oldest on top; entries whose message has left are passed over
        oldest = [(arrival, ident) for ident, (arrival, _, _) in kept.items()]
        heapq.heapify(oldest)
        for pdf in parts:
            for ident in pdf.loc[pdf["decided"], "message_id"]:
                decided.add(ident)
                kept.pop(ident, None)
            sent = pdf[~pdf["decided"]]
            for ident, arrival, payload in zip(sent["message_id"], sent["arrival"], sent["payload"]):
                if ident in kept or ident in decided:
                    continue
                kept[ident] = [int(arrival), payload, now]
                heapq.heappush(oldest, (int(arrival), ident))
                while len(kept) > length:
                    arrival, ident = heapq.heappop(oldest)
                    if ident in kept and kept[ident][0] == arrival:
                        del kept[ident]
        state.update((json.dumps([[ident, *entry] for ident, entry in kept.items()]), version + 1))
        rows = [(key[0], version + 1, ident, arrival, payload) for ident, (arrival, payload, _) in kept.items()]
        out = pd.DataFrame(rows or [(key[0], version + 1, None, None, None)], columns=["lane", "version", "message_id", "arrival", "payload"])
        yield out.astype({"arrival": "Int64"})

    return step


def queue_snapshots(
    messages: DataFrame, arrival: str, length: int = 100, key: str = "message_id", decided: Column | None = None, lanes: int = 64, ttl_ms: int | None = None,
) -> DataFrame:
    """Snapshots of the queue's lanes, one row per waiting message (an emptied lane sends one row without message).

    ``messages`` is a stream; ``arrival`` is a column of milliseconds and ``decided`` tells the rows that report a decision. Rows
    without id or arrival are skipped, unless they report a decision, which needs the id only. All other columns travel as JSON in
    ``payload``. One lane gives one queue in the order of arrival; with several, each holds up to ``length`` messages, and a place
    freed by a decision may be taken by an older message of another lane.
    """
    is_decision = F.coalesce(F.lit(False) if decided is None else decided, F.lit(False))
    rest = [F.col(f"`{c}`") for c in messages.columns if c not in (key, arrival)]
    rows = messages.select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(lanes)).cast("int").alias("lane"), F.col(key).cast("string").alias("message_id"),
        F.col(arrival).cast("long").alias("arrival"), is_decision.alias("decided"),
        (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("payload"),
    ).filter("message_id IS NOT NULL AND (decided OR arrival IS NOT NULL)")
    # whole numbers stay whole in pandas
    rows = rows.withColumn("arrival", F.coalesce("arrival", F.lit(0)))
    return rows.groupBy("lane").applyInPandasWithState(newest_waiting(length, ttl_ms), SNAPSHOT, LANE_STATE, "append", GroupStateTimeout.NoTimeout)


def current_queue(snapshots: DataFrame, length: int = 100) -> DataFrame:
    """What waits now, oldest first: ``message_id, arrival, payload``. Reads the last snapshot of each lane only."""
    last = snapshots.groupBy("lane").agg(F.max("version").alias("version"))
    # one row a lane
    waiting = snapshots.join(F.broadcast(last), ["lane", "version"], "left_semi").filter("message_id IS NOT NULL")
    newest = waiting.orderBy(F.desc("arrival"), F.desc("message_id")).limit(length)
    return newest.select("message_id", "arrival", "payload").orderBy("arrival", "message_id")
