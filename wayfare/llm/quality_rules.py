"""Quality rules: a table of thresholds compiled into one projection.

Every figure is a column expression over the whole text, so the rules run where
the scan runs: no shuffle, no user function. Texts that are null or empty have
figures of zero and fail the length rule; repeated rows give repeated results;
a null doc_id is carried along. Only doc_id and text are read, so further
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import SPACES, text_of, words_of

SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "was", "for", "with", "as", "on", "by", "a",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "ist", "im", "ein", "eine",
    "de", "la", "le", "et", "les", "des", "un", "une", "du", "que", "dans", "pour",
    "el", "los", "en", "y", "se", "del", "las", "por", "con", "una",
)


@dataclass(frozen=True)
class Rule:
    """``figure / base`` must lie in [low, high]; a base of None takes the figure itself."""

    name: str
    figure: str
    base: str | None = None
    low: float | None = None
    high: float | None = None


#: Thresholds of the production run.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.15),
    Rule("exclamations", "n_exclamations", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def passes(rule: Rule) -> Column:
    """One rule as a column; compared by products, so a base of zero divides nothing."""
    value, base = F.col(rule.figure).cast("double"), F.lit(1.0) if rule.base is None else F.col(rule.base).cast("double")
    out = F.lit(True)
    if rule.low is not None:
        out = out & (value >= F.lit(rule.low) * base)
    if rule.high is not None:
        out = out & (value <= F.lit(rule.high) * base)
    return out


def figures(docs: DataFrame) -> DataFrame:
    """doc_id and the figures that the rules speak of."""
    text, words = F.col("t"), F.col("w")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    split = docs.select("doc_id", text_of().alias("t")).select("doc_id", "t", words_of(text).alias("w"), lines.alias("l"))
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_exclamations"),
        F.size(F.filter(words, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        windows.alias("h"),
    )
    return repeat_words(counted)


def repeat_words(df: DataFrame) -> DataFrame:
    """Words in 3-word windows that occur twice or more; ``h`` has the window digests in order.

    Texts without any repeated window, the most, stop at the comparison of two
    sizes. For the others the digests are sorted with their places, neighbours
    compared, and the places found put back in order, so that the cost follows
    the length of a text and not its square.
    """
    none = F.array().cast("array<struct<x:bigint,i:int>>")
    ranked = df.withColumn(
        "h",
        F.when(
            F.size("h") > F.size(F.array_distinct("h")),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
        ).otherwise(none),
    )
    h = F.col("h")
    twice = F.filter(
        h, lambda e, j: F.get(h, j - 1)["x"].eqNullSafe(e["x"]) | F.get(h, j + 1)["x"].eqNullSafe(e["x"])
    )
    places = ranked.withColumn("h", F.sort_array(F.transform(twice, lambda e: e["i"])))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "h", start,
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["upto"])).alias("n"), (i + 3).alias("upto")),
        lambda a: a["n"],
    )
    return places.withColumn("n_repeat_words", covered.cast("long")).drop("h")


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Figures of every document, the names of the rules it breaks, and the verdict.

    ``base_failed``: fewer words than ``min_words``, or more than ``max_repeat_percent``
    of the words in repeated 3-word windows. ``kept``: not base_failed and no rule broken.
    """
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    broken = F.filter(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    return (
        figures(docs)
        .withColumn("base_failed", base_failed)
        .withColumn("broken_rules", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
    )
