"""The moderation pipeline, one DataFrame function per hop.

A message travels as JSON and gains one nested verdict per hop. Each hop names the topic of every row in a
column, so one writer serves several topics.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources import schemas

Scorer = Callable[[DataFrame], DataFrame]

# Topic names of the pipeline.
CLASSIFIED, ANALYSIS_REQUIRED = "classified-messages", "nlp-analysis-required"
ANALYSIS_RESULTS, MODERATION_REQUIRED = "nlp-analysis-results", "moderation-required"


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def parse_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """Typed messages. Text that is no JSON object gets ``error`` and its first 200 characters as ``raw_message``;
    a field of a wrong type or a null content only gets ``error``. A missing friend map is empty.
    """
    schema = f"{schemas.MESSAGE}, _corrupt_record string"
    keys = F.json_object_keys(value)
    parsed = lines.withColumn("_m", F.from_json(value, schema, {"mode": "PERMISSIVE"})).withColumn("_keys", keys)
    broken = F.col("_keys").isNull()
    null_content = F.array_contains("_keys", "content") & F.col("_m.content").isNull()
    error = F.when(broken, "Message non parsable").when(F.col("_m._corrupt_record").isNotNull() | null_content, "Message invalide")
    fields = [F.col(f"_m.{c}").alias(c) for c in ("message_id", "sender_id", "content", "timestamp", "game_id", "channel_id", "recipients")]
    friends = F.coalesce(F.col("_m.is_friends"), F.create_map().cast("map<string,boolean>")).alias("is_friends")
    rest = [c for c in lines.columns if c != value]
    return parsed.select(
        *rest, *fields, friends, F.col("_m.metadata").alias("metadata"), error.alias("error"),
        F.when(broken, F.substring(value, 1, 200)).alias("raw_message"),
    )


def lexicon_scorer(lexicon: Sequence[str] = tx.TOXIC_WORDS, strip_punct: bool = False) -> Scorer:
    """Word-list score with its own uncertainty."""

    def score(df: DataFrame) -> DataFrame:
        scored = df.withColumn("toxicity_score", tx.lexicon_score(F.coalesce("content", F.lit("")), lexicon, strip_punct))
        return scored.withColumn("uncertainty", tx.lexicon_uncertainty("toxicity_score"))

    return score


def undecided_scorer(df: DataFrame) -> DataFrame:
    """What the second look reports without a model: one half, and half unsure."""
    return df.withColumns({"toxicity_score": F.lit(0.5), "uncertainty": F.lit(0.5)})


def _verdict(decision: Column, clock: Column, failed: Column) -> Column:
    return F.struct(
        F.when(~failed, F.col("toxicity_score")).alias("toxicity_score"), F.when(~failed, F.col("uncertainty")).alias("uncertainty"),
        clock.cast("bigint").alias("timestamp"), decision.alias("decision"),
    )


def classify_fast(
    messages: DataFrame, scorer: Scorer | None = None, toxicity_above: float = tx.FAST_TOXICITY, uncertainty_above: float = tx.FAST_UNCERTAINTY,
    clock: Column | None = None,
) -> DataFrame:
    """First verdict in ``classification``. Any scorer may add ``toxicity_score`` and, if it likes, ``uncertainty``."""
    scored = (scorer or lexicon_scorer())(messages)
    if "uncertainty" not in scored.columns:
        scored = scored.withColumn("uncertainty", tx.fast_uncertainty("toxicity_score"))
    failed = F.col("error").isNotNull() if "error" in messages.columns else F.lit(False)
    decision = tx.route_fast("toxicity_score", "uncertainty", toxicity_above, uncertainty_above)
    if "raw_message" in messages.columns:
        decision = F.when(F.col("raw_message").isNotNull(), "ERROR").when(failed, "NEEDS_ANALYSIS").otherwise(decision)
    verdict = _verdict(decision, now_millis() if clock is None else clock, failed)
    return scored.withColumn("classification", verdict).drop("toxicity_score", "uncertainty")


def fast_topic(decision: Column | str = "classification.decision") -> Column:
    return F.when(tx.col(decision) == "NEEDS_ANALYSIS", ANALYSIS_REQUIRED).otherwise(CLASSIFIED)


def analyse_deep(
    messages: DataFrame, scorer: Scorer | None = None, toxicity_above: float = tx.DEEP_TOXICITY, uncertainty_above: float = tx.DEEP_UNCERTAINTY,
    clock: Column | None = None,
) -> DataFrame:
    """Second verdict in ``deep_analysis``: a model score corrected for friends, length and game context."""
    scored = (scorer or undecided_scorer)(messages)
    if "uncertainty" not in scored.columns:
        scored = scored.withColumn("uncertainty", tx.deep_uncertainty("toxicity_score"))
    score, unc = tx.context_adjust("toxicity_score", "uncertainty", tx.friends_ratio("is_friends"), "content", "metadata.game_context")
    adjusted = scored.withColumns({"_s": score, "_u": unc}).drop("toxicity_score", "uncertainty")
    adjusted = adjusted.withColumnsRenamed({"_s": "toxicity_score", "_u": "uncertainty"})
    decision = tx.route_deep("toxicity_score", "uncertainty", toxicity_above, uncertainty_above)
    verdict = _verdict(decision, now_millis() if clock is None else clock, F.lit(False))
    return adjusted.withColumn("deep_analysis", verdict).drop("toxicity_score", "uncertainty")


def deep_topic(decision: Column | str = "deep_analysis.decision") -> Column:
    return F.when(tx.col(decision) == "NEEDS_MODERATION", MODERATION_REQUIRED).otherwise(ANALYSIS_RESULTS)


def distinct_messages(messages: DataFrame, event_time: str, delay: str = "1 hour", key: str = "message_id") -> DataFrame:
    """First arrival of each message; a stream forgets an id once the watermark has passed it."""
    if messages.isStreaming:
        return messages.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    first = messages.groupBy(key).agg(F.min_by(F.struct(*messages.columns), F.col(event_time)).alias("_first"))
    return first.select("_first.*")


def queue(messages: DataFrame, arrival: str, length: int = 100, key: str = "message_id") -> DataFrame:
    """The newest messages of the moderation queue, oldest first."""
    return messages.orderBy(F.desc(arrival), F.desc(key)).limit(length).orderBy(arrival, key)


def with_moderation(messages: DataFrame, decision: Column, reason: Column | None = None, clock: Column | None = None) -> DataFrame:
    """Attach a moderator's decision."""
    return messages.withColumn(
        "moderation",
        F.struct(
            decision.alias("decision"), (F.lit(None) if reason is None else reason).cast("string").alias("reason"),
            F.lit("human_moderator").alias("moderator_id"), (now_millis() if clock is None else clock).cast("bigint").alias("timestamp"),
        ),
    )


def final_decisions(classified: DataFrame, analysed: DataFrame, moderated: DataFrame, clock: Column | None = None) -> DataFrame:
    """Union of the three result streams with ``final_decision``.

    Messages without id or decision are skipped, and those whose verdict is still to come from a later hop.
    """
    clock = now_millis() if clock is None else clock

    def decided(df: DataFrame, field: str, source: str, pending: str | None) -> DataFrame:
        decision = F.col(f"{field}.decision")
        valid = (F.coalesce("message_id", F.lit("")) != "") & (F.coalesce(decision, F.lit("")) != "")
        if pending:
            valid = valid & (decision != pending)
        tag = F.lit(source)
        final = F.struct(
            tag.alias("source"), decision.alias("decision"), clock.cast("bigint").alias("timestamp"),
            tx.final_action(decision).alias("action"), tx.training_value(decision, tag).alias("training_value"),
        )
        return df.filter(valid).withColumn("final_decision", final)

    parts = [
        decided(classified, "classification", "fast_classifier", "NEEDS_ANALYSIS"),
        decided(analysed, "deep_analysis", "deep_analyzer", "NEEDS_MODERATION"),
        decided(moderated, "moderation", "human_moderator", None),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def training_feedback(final: DataFrame) -> DataFrame:
    """Decided messages worth learning from, with their label."""
    return final.filter(F.coalesce("final_decision.training_value", F.lit(False))).select(
        "message_id", F.col("content").alias("text"), (F.col("final_decision.decision") == "TOXIC").cast("double").alias("toxicity")
    )
