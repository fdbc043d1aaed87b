"""Small frames for the text operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# columns beyond the contract, with names that the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, node string, block long, n_words string"


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), None, None, "x", 7, "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, size=5):
    w = WORD.findall(ascii_lower(text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
