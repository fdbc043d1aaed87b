"""Message scoring and routing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col, let

# The default word list, its reduced form, thresholds and decision names.
TOXIC_WORDS = (
    "idiot", "connard", "salope", "pute", "enculé", "merde", "putain", "con",
    "débile", "crétin", "nique", "fuck", "bitch", "asshole", "retard",
)
TOXIC_WORDS_SMALL = ("idiot", "merde")
FAST_TOXICITY, FAST_UNCERTAINTY = 0.8, 0.4
DEEP_TOXICITY, DEEP_UNCERTAINTY = 0.7, 0.1
SCORE_FACTOR = 3
# Everything but word characters, blanks and !?., goes. (?U): letters with accents are word characters.
STRIP_PATTERN = r"(?U)[^\w\s!?.,]"


def clean_text(text: Column | str) -> Column:
    return F.regexp_replace(F.lower(col(text)), STRIP_PATTERN, "")


def words(text: Column) -> Column:
    """Tokens between blanks; no token for an empty text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def lexicon_hits(tokens: Column, lexicon: Sequence[str]) -> Column:
    """How many tokens are in the word list (repeats count)."""
    listed = F.array(*[F.lit(w) for w in lexicon])
    return F.size(F.filter(tokens, lambda w: F.array_contains(listed, w)))


def lexicon_score(text: Column | str, lexicon: Sequence[str] = TOXIC_WORDS, strip_punct: bool = False) -> Column:
    """``min(1, 3 * hits / tokens)``, 0 without tokens. Punctuation stays on its word unless ``strip_punct``."""
    cleaned = clean_text(text)
    if strip_punct:
        cleaned = F.regexp_replace(cleaned, r"[!?.,]", " ")

    def score(tokens: Column) -> Column:
        n = F.size(tokens)
        share = lexicon_hits(tokens, lexicon) / n * F.lit(SCORE_FACTOR)
        return F.when(n > 0, F.least(F.lit(1.0), share)).otherwise(F.lit(0.0))

    return let(words(cleaned), score)


def lexicon_uncertainty(score: Column | str) -> Column:
    score = col(score)
    return F.when((score > 0.3) & (score < 0.7), F.lit(0.5)).otherwise(F.lit(0.0))


def fast_uncertainty(score: Column | str) -> Column:
    """Peaks at one half for a score in the middle."""
    return F.greatest(F.lit(0.0), F.lit(0.5) - F.abs(col(score) - 0.5))


def deep_uncertainty(score: Column | str) -> Column:
    """Peaks at one."""
    return F.lit(1.0) - F.abs(col(score) - 0.5) * 2


def friends_ratio(is_friends: Column | str) -> Column:
    """Share of recipients marked as friends; 0 for an empty or missing map."""
    m = col(is_friends)
    known = F.coalesce(F.size(F.map_keys(m)), F.lit(0))
    friends = F.coalesce(F.size(F.map_filter(m, lambda _, v: F.coalesce(v, F.lit(False)))), F.lit(0))
    return friends / F.greatest(F.lit(1), known)


def context_adjust(
    score: Column | str,
    uncertainty: Column | str,
    friends: Column | str,
    content: Column | str,
    game_context: Column | str,
) -> tuple[Column, Column]:
    """Score and uncertainty after the friend, length and game-context corrections, in that order."""
    score, unc, among_friends = col(score), col(uncertainty), col(friends) > 0.5
    unc = F.when(among_friends, F.greatest(F.lit(0.0), unc - 0.1)).otherwise(unc)
    short = F.char_length(F.coalesce(col(content), F.lit(""))) < 5
    unc = F.when(short, F.least(F.lit(1.0), unc + 0.2)).otherwise(unc)
    has_context = F.coalesce(F.length(col(game_context)) > 0, F.lit(False))
    unc = F.when(has_context, F.greatest(F.lit(0.0), unc - 0.1)).otherwise(unc)
    return F.when(among_friends, F.greatest(F.lit(0.0), score - 0.2)).otherwise(score), unc


def _route(score, uncertainty, toxicity_above: float, uncertainty_above: float, unsure: str) -> Column:
    return (
        F.when(col(uncertainty) > uncertainty_above, F.lit(unsure))
        .when(col(score) > toxicity_above, F.lit("TOXIC"))
        .otherwise(F.lit("OK"))
    )


def route_fast(score, uncertainty, toxicity_above: float = FAST_TOXICITY, uncertainty_above: float = FAST_UNCERTAINTY):
    return _route(score, uncertainty, toxicity_above, uncertainty_above, "NEEDS_ANALYSIS")


def route_deep(score, uncertainty, toxicity_above: float = DEEP_TOXICITY, uncertainty_above: float = DEEP_UNCERTAINTY):
    return _route(score, uncertainty, toxicity_above, uncertainty_above, "NEEDS_MODERATION")


def final_action(decision: Column | str) -> Column:
    """BLOCK, ALLOW, or NULL for any other decision."""
    decision = col(decision)
    return F.when(decision == "TOXIC", "BLOCK").when(decision == "OK", "ALLOW")


def training_value(decision: Column | str, source: Column | str) -> Column:
    """True for toxic messages and for accepted ones that took a second look; NULL otherwise."""
    decision, source = col(decision), col(source)
    second_look = source.isin("deep_analyzer", "human_moderator")
    return F.when((decision == "TOXIC") | ((decision == "OK") & second_look), F.lit(True))
