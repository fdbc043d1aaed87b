"""A training corpus from raw documents: language, near duplicates, benchmark passages, secrets, packing.

Each stage takes the rows its predecessor kept, written as Parquet and read again, and returns the columns of ``documents``
(the last one returns batches).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontam, langid, neardup, packing, secrets
from tarmac.llm.common import fold_of, table
from tarmac.session import materialise

# The stages learn, sample and cluster, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


# Share of its n-grams that the main language of a text must explain.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents of which one language makes up half at least, as the mixture model shares them out.

    Rejected are texts in which no language dominates and texts without a letter. A document without ``lang`` gets its main language.
    The models learn from the labelled rows of four folds of five; without any, every document is rejected.
    """
    model = langid.train(docs.where(fold_of("doc_id", 5) != 0))
    # not deterministic to the planner, which would otherwise run the inference once for the filter and once for the columns
    found = langid.detector(spark, model).asNondeterministic()(F.col("text"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), found.alias("_found"))
    kept = marked.where((F.col("_found.lang_pred") != langid.UNKNOWN) & (F.col("_found.score") >= LEAST_SHARE))
    lang = F.coalesce("_row.lang", "_found.lang_pred").alias("lang")
    return kept.select(*[lang if c == "lang" else F.col(f"_row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: the smallest by id, nulls last, then by a digest of the text.

    Rows are told apart by id and text, so rows that share an id are judged each by its own text, and copies without an id are
    found. Rows with equal id and text count as one; only those without id and words all stay.
    """
    text = F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("-")), text)))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), key.alias("key"))
    found = materialise(neardup.near_duplicates(docs.select(name.alias("name"), "text"), id_col="name"), "groups")
    plain = (F.col("n_shingles") == 0) & F.col("name.unnamed")
    kept = found.where("kept").groupBy(F.col("name.key").alias("_key")).agg((F.when(F.bool_or(plain), 1).otherwise(F.count("*"))).alias("rows"))
    packed = docs.select(key.alias("_of"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    marked = packed.join(kept, F.col("_of") == F.col("_key"))
    once = marked.where("rows = 1").select("_row")
    several = marked.where("rows > 1").groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return once.unionByName(several).select(*[F.col(f"_row.`{c}`") for c in docs.columns])


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a passage of the benchmark."""
    # a name that no column of the input has
    flag = "_" * (1 + max(map(len, docs.columns), default=0)) + "contaminated"
    marked = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"), flag=flag)
    return marked.where(~F.col(flag)).drop(flag)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with the secrets in their texts masked and n_chars counted anew."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces of similar length."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("secret scans", mask_secrets),
    ("packing", pack_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
