"""URL verdicts: listed rules first, then association rules mined by FP-growth from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import sized_join
from .common import materialise

# Fixed values: (verdict, rule); a rule is a host and a path prefix.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LABEL = "label="


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; of equally long ones the first in text order."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + start))
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct marked tokens: host labels, path segments with digits as 0, query keys and the scheme."""
    digits = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    marked = lambda c, mark: F.transform(F.filter(c, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    query = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    parts = F.concat(
        marked(F.split(host, r"\."), "host="), marked(F.split(digits(path), "/"), "path="),
        marked(F.transform(query, lambda x: F.substring_index(x, "=", 1)), "key="), F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
    )
    return F.when(F.instr(url, "://") > 0, F.array_sort(F.array_distinct(parts))).otherwise(F.array().cast("array<string>"))


def token_classes(rows: DataFrame, least_support: float) -> DataFrame:
    """Frequent tokens and their class: tokens of exactly the same rows share one, named by its smallest token.

    A token's rows are told apart by their number and two 64-bit sums (exclusive or) of row hashes.
    """
    least = rows.count() * least_support
    row = [F.bit_xor(F.xxhash64("row", F.lit(i))).alias(f"x{i}") for i in range(2)]
    found = rows.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"), *row).where(F.col("n") >= least)
    names = found.groupBy("n", "x0", "x1").agg(F.min("token").alias("item"))
    return found.join(names, ["n", "x0", "x1"]).select("token", "item")


def in_classes(rows: DataFrame, key: list[str], classes: DataFrame) -> DataFrame:
    """Per key the sorted classes of its tokens; tokens of none are left out, and so are keys without one."""
    parted = sized_join(rows.select(*key, F.explode("tokens").alias("token")), classes, ["token"], "inner", stored=True)
    return parted.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine(labelled: DataFrame, classes: DataFrame, least_support: float, least_confidence: float) -> DataFrame:
    """Rules from combinations of token classes to a label: antecedent, verdict, confidence, support and the anchor class.

    ``labelled`` has row, tokens and verdict. Tokens that always occur together are one item, so keys that a site puts into every URL do not multiply
    the combinations. A rule stays if no rule for the same verdict with fewer of its items is at least as sure; the rules of smaller
    size are looked up by each proper part of the antecedent. The anchor is its rarest item, the key of the inverted index.
    """
    items = in_classes(labelled, ["row"], classes)
    baskets = labelled.join(items, "row", "left").select(
        F.array_append(F.coalesce("items", F.array().cast("array<string>")), F.concat(F.lit(LABEL), "verdict")).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(materialise(baskets, "baskets"))
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("anchor"), "freq")
    found = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(LABEL)))
    found = found.select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("verdict"), "confidence", "support")
    rules = materialise(found.withColumn("rule_id", F.xxhash64("antecedent", "verdict")), "rules")
    masks = F.expr("sequence(1L, shiftleft(1L, size(antecedent)) - 2)")
    some = lambda mask: F.filter("antecedent", lambda x, i: F.getbit(mask, i) == 1)
    part = rules.where(F.size("antecedent") > 1).select("rule_id", "verdict", "confidence", "antecedent", F.explode(masks).alias("mask"))
    part = part.select("rule_id", "verdict", "confidence", some(F.col("mask")).alias("less"))
    short = rules.select(F.col("antecedent").alias("less"), F.col("confidence").alias("surety"), "verdict")
    beaten = part.join(short, ["less", "verdict"]).where("surety >= confidence").select("rule_id").distinct()
    kept = rules.join(beaten, "rule_id", "left_anti")
    anchored = kept.select("*", F.explode("antecedent").alias("anchor")).join(single, "anchor")
    chosen = anchored.groupBy("rule_id").agg(F.min(F.struct("freq", "anchor")).alias("rarest"))
    return kept.join(chosen, "rule_id").select("rule_id", F.col("rarest.anchor").alias("anchor"), "antecedent", "verdict", "confidence", "support")


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = LISTED, labels: DataFrame | None = None,
    least_support: float = 0.005, least_confidence: float = 0.8,
) -> DataFrame:
    """One row per page: the id, host, path, rule, verdict, and the support and confidence of a mined rule.

    The longest listed rule that fits decides. URLs without one go to the mined rules: the surest of those whose tokens all
    occur in the URL, then the best supported, the longest, the one that blocks. Without any rule the verdict is ``allow``.
    Rules are learned from ``labels`` (url, verdict) or, if not given, from the URLs that a listed rule decides. URLs
    with equal tokens are judged once. A candidate meets a URL only through its anchor. Tokens that the labelled URLs only know together stand for
    each other: a rule asks for any one of them. Mining grows with the combinations of tokens that are frequent together and yet not always.

    Null URLs and those without "://" have an empty host and path, no tokens, and are allowed. Repeated rows give repeated
    results. With no labelled URL there are no mined rules. Empty tables give empty ones; other columns are not read.
    """
    host, path = parsed(F.col("url"))
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    base = base.withColumns({"host": host, "path": path}).withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    base = base.withColumn("tokens", F.coalesce(tokens(F.col("url"), F.col("host"), F.col("path")), F.array().cast("array<string>")))
    base = base.select("id", "host", "path", "listed", "tokens").withColumns({"key": F.xxhash64("tokens"), "row": F.monotonically_increasing_id()})
    base = materialise(base, "urls")
    if labels is None:
        labelled = base.where("listed IS NOT NULL AND size(tokens) > 0").select("row", "tokens", F.col("listed.verdict").alias("verdict"))
    else:
        host, path = parsed(F.col("url"))
        labelled = labels.select(tokens(F.col("url"), host, path).alias("tokens"), "verdict").where("size(tokens) > 0 AND verdict IS NOT NULL")
        labelled = materialise(labelled.withColumn("row", F.monotonically_increasing_id()), "labelled")
    kinds = base.where("listed IS NULL AND size(tokens) > 0").groupBy("key", "tokens").agg(F.count("*").alias("n"))
    if labelled.isEmpty():
        best = base.limit(0).select("key", "tokens", F.lit(None).cast("struct<confidence:double,support:double,size:int,blocks:boolean,verdict:string>").alias("best"))
    else:
        classes = materialise(token_classes(labelled, least_support), "classes")
        mined = materialise(mine(labelled, classes, least_support, least_confidence), "rules")
        kinds = in_classes(kinds, ["key", "tokens"], classes)
        met = sized_join(kinds.select("key", "tokens", "items", F.explode("items").alias("anchor")), mined, ["anchor"], "inner", stored=True)
        met = met.where(F.size(F.array_except("antecedent", "items")) == 0)
        rank = F.struct("confidence", "support", F.size("antecedent").alias("size"), (F.col("verdict") == "block").alias("blocks"), "verdict")
        best = met.groupBy("key", "tokens").agg(F.max(rank).alias("best"))
    # a hot pattern of URLs stays where it is while the patterns are few, and is split by its size beyond that
    out = sized_join(base, best, ["key", "tokens"])
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"), F.coalesce("listed.verdict", "best.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("best.confidence")).alias("confidence"), F.when(F.col("listed").isNull(), F.col("best.support")).alias("support"),
    )
