"""Chat formatting in budgeted windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

# Fixed marks of the template. No escaped text holds "<|", so none of them can occur inside a text.
NEW, SEEN, TEXT, END = "<|turn|>", "<|seen|>", "<|text|>", "<|end|>"
WORD = r"[^\x20\x09-\x0D]+"
# Turns whose span starts are gathered at a time.
BLOCK = 512


def escaped(c: Column) -> Column:
    """Double every backslash, then part "<|"; ``unescaped`` is the exact inverse.

    Backslashes come in even runs after the first step, so a single one between "<" and "|" is the second step's own.
    """
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def windows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = 512, history_budget: int = 128, most_history: int = 4,
) -> DataFrame:
    """Formatted windows: the conversation id, ``window``, ``text``, ``loss`` (start and length of each target) and ``n_tokens``.

    Tokens are words. Prefix sums over the turns choose the spans: a span takes turns while it stays within the budget left
    by the system turn and the history. Every window after the first repeats the system turn (a first turn of role
    ``system``) and the longest run of at most ``most_history`` turns before the span within ``history_budget`` tokens.
    Repeated turns carry another mark and are never under the loss mask, so each assistant text is a target exactly
    once. Turns are never cut: one that exceeds the budget alone has a span of its own.

    Turns are ordered by number, null first, then role and text, so ties and repeated rows have a defined place. Null
    roles and texts count as empty. Rows of a null id form one conversation. Of a conversation only numbers (a few a turn) are gathered in one row,
    where the spans are chosen; texts meet by conversation and window, and a window holds one budget of tokens or one turn. Empty tables
    give empty ones. Other columns are not read, so their names cannot clash.
    """
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    base = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    base = base.withColumns({"er": escaped(F.col("role")), "et": escaped(F.col("text")), "tok": F.regexp_count("text", F.lit(WORD)).cast("long")})
    base = base.withColumn("len", (F.length("er") + F.length("et") + F.lit(len(NEW) + len(TEXT) + len(END))).cast("long"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(
        "conv", (F.row_number().over(order) - 1).cast("long").alias("i"), "role", "er", "et", "tok", "len",
        F.coalesce(F.sum("tok").over(before), F.lit(0)).alias("pre"), F.coalesce(F.sum("len").over(before), F.lit(0)).alias("at"),
        F.first("role").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("first_role"),
    )
    base = materialise(base, "turns")
    # history of a span that starts here: turns before it, after the system turn, near enough by number and by prefix sum
    system = F.col("first_role") == "system"
    along = Window.partitionBy("conv").orderBy("i")
    earlier = [F.lag("pre", k).over(along) for k in range(1, most_history + 1)]
    near = [((F.col("i") - k >= system.cast("int")) & (F.col("pre") - p <= history_budget)).cast("int") for k, p in enumerate(earlier, 1)]
    history = sum((F.coalesce(n, F.lit(0)) for n in near), F.lit(0))
    numbers = base.select("conv", "i", "tok", "pre", system.alias("sys"), history.alias("history"))
    convs = numbers.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("i", "tok", "pre", "history"))).alias("t"), F.bool_or("sys").alias("sys"))
    convs = convs.withColumn("own", F.expr(f"greatest({budget - history_budget} - IF(sys, t[0].tok, 0), 1)"))
    # the starts are gathered block by block, so that no long array is copied at every turn
    convs = convs.withColumn("blocks", F.expr(f"transform(sequence(0, CAST((size(t) - 1) / {BLOCK} AS INT)), b -> slice(t, b * {BLOCK} + 1, {BLOCK}))"))
    found = "array_append(s.here, named_struct('i', x.i, 'history', x.history))"
    step = f"(s, x) -> IF(x.pre + x.tok - s.pre > own AND x.i > 0, named_struct('pre', x.pre, 'here', {found}), s)"
    inner = f"aggregate(b, named_struct('pre', a.pre, 'here', CAST(array() AS array<struct<i: bigint, history: int>>)), {step})"
    first = "named_struct('pre', 0L, 'all', array(array(named_struct('i', 0L, 'history', 0))))"
    convs = convs.withColumn("spans", F.expr(f"flatten(aggregate(blocks, {first}, (a, b) -> transform(array({inner}), r -> named_struct('pre', r.pre, 'all', array_append(a.all, r.here)))[0]).all)"))
    ended = "transform(spans, (s, w) -> named_struct('window', w, 's', s.i, 'h', s.i - s.history, 'e', coalesce(get(spans, w + 1).i, CAST(size(t) AS BIGINT))))"
    spans = convs.select("conv", "sys", F.explode(F.expr(ended)).alias("x")).select("conv", "sys", "x.*")
    again = F.col("sys") & (F.col("s") > 0)
    places = F.concat(F.when(again, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>")), F.sequence("h", F.col("e") - 1))
    placed = spans.select(F.col("conv").alias("c"), "window", "s", again.alias("again"), F.explode(places).alias("place"))
    met = base.join(placed, F.col("conv").eqNullSafe(F.col("c")) & (F.col("i") == F.col("place")))
    piece = F.concat(F.when(F.col("i") < F.col("s"), F.lit(SEEN)).otherwise(F.lit(NEW)), "er", F.lit(TEXT), "et", F.lit(END))
    target = (F.col("i") >= F.col("s")) & (F.col("role") == "assistant")
    met = met.select("conv", "window", "again", F.struct("i", "tok", "len", "at", piece.alias("piece"), target.alias("target"), F.length("er").alias("er"), F.length("et").alias("et")).alias("p"))
    out = met.groupBy("conv", "window").agg(F.bool_or("again").alias("again"), F.sort_array(F.collect_list("p")).alias("t"))
    out = out.withColumn("from", F.expr("IF(again, t[0].len, 0) - t[IF(again, 1, 0)].at"))
    loss = F.expr(f"""transform(filter(t, x -> x.target), x -> named_struct(
        'start', CAST(from + x.at + {len(NEW) + len(TEXT)} + x.er AS BIGINT), 'length', CAST(x.et AS BIGINT)))""")
    return out.select(
        F.col("conv").alias(conv_col), F.col("window").cast("long").alias("window"), F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("text"), loss.alias("loss"),
        F.expr("aggregate(t, 0L, (n, x) -> n + x.tok)").alias("n_tokens"),
    )


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted windows say: turns and targets of each conversation, as counts and digests."""
    # a window's last piece is empty: the text ends with an end mark
    pieces = F.split("text", F.lit(END.replace("|", r"\|")))
    own = formatted.withColumn("new", F.filter(pieces, lambda p: F.startswith(p, F.lit(NEW))))
    role = lambda p: unescaped(F.substring_index(F.substring(p, F.lit(len(NEW) + 1), F.length(p)), TEXT, 1))
    body = lambda p: unescaped(F.substring(p, F.instr(p, TEXT) + F.lit(len(TEXT)), F.length(p)))
    own = own.select(
        conv_col, "window", F.size("new").cast("long").alias("n"), F.length("text").cast("long").alias("chars"),
        F.array_join(F.transform("new", lambda p: F.concat(role(p), F.lit("\n"), body(p), F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("loss", lambda m: unescaped(F.substring(F.col("text"), (m["start"] + 1).cast("int"), m["length"].cast("int")))), "").alias("targets"),
    )
    joined = lambda c: F.array_join(F.transform(F.sort_array("w"), lambda x: x[c]), "")
    out = own.groupBy(conv_col).agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"), F.collect_list(F.struct("window", "turns", "targets")).alias("w")
    )
    out = out.withColumns({"turns": joined("turns"), "targets": joined("targets")})
    return out.select(
        conv_col, "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.length("targets").cast("long").alias("loss_chars"),
        F.sha2(F.col("targets").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def control_conversation(like: DataFrame) -> DataFrame:
    """Conversation -7: a user and an assistant row whose text imitates marks of templates."""
    said = "\\### Assistant: </turn> ok"
    rows = like.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    return like.select("conv_id", "turn", "role", "text").unionByName(rows)
