"""The numbered queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, fim, langid, lm, neardup, packing, quality, secrets, toxicity, trie, urlrules
from .common import fold_of, table
from .sqltexts import CHAT_WINDOWS, FILL_IN_MIDDLE, LINE_CLEANING, PREFIX_TRIE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op1_line_cleaning": LINE_CLEANING, "op9_chat_windows": CHAT_WINDOWS, "op11_fill_in_middle": FILL_IN_MIDDLE, "op12_prefix_trie": PREFIX_TRIE}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_line_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    """Line-first cleaning of all documents."""
    return quality.clean_lines(table(spark, folder, "documents"), with_text=False)


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.scan(table(spark, folder, "documents"))


@query
def op10_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from four folds of five."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(fold_of("doc_id", 5) != 0))
    found = langid.identify(docs, model)
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", F.size("langs").cast("long").alias("n_langs"))


@query
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents at a Jaccard similarity of 0.85."""
    return neardup.near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts for the URLs of all pages."""
    return urlrules.judge(table(spark, folder, "pages"))


@query
def op5_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in batches of similar length."""
    return packing.pack(table(spark, folder, "documents"))


@query
def op9_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted in windows, and read back from them."""
    return chat.read_back(chat.windows(chat.control_conversation(table(spark, folder, "conversations"))))


@query
def op6_benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages found in all documents."""
    return decontam.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from two folds of three."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels").where(fold_of("doc_id", 3) != 1))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probabilities of all documents under a model of four folds of five."""
    docs = table(spark, folder, "documents")
    return lm.score_texts(docs, fold_of("doc_id", 5) == 1)


@query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents rearranged for filling in the middle, and read back."""
    return fim.digests(fim.transform(table(spark, folder, "documents")))


@query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by the ranks of a public vocabulary, and decoded."""
    import public_tokenizers

    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    found = bpe.decode(bpe.encode(table(spark, folder, "documents"), encoder), encoder)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, folder, "conversations")).drop("turn_conv", "turn_index")
