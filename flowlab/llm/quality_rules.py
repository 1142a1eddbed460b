"""Quality rules: a table of thresholds compiled into one projection, with DataFrame expressions only.

Each text is measured once (words, symbols, stop words, lines, repeated windows of words); a rule bounds the quotient of two
measures, and all rules become one Boolean expression each over the measures. Bounds are compared by integer products, so
no rule hangs on rounding. Nothing is shuffled and no row depends on another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LETTERED = r"[^\x20\x09-\x0D\p{L}]*\p{L}[^\x20\x09-\x0D]*"
BULLET = r"^[\x20\t]*[-*\x{2022}\x{2023}]"
ELLIPSIS = r"(\.\.\.|\x{2026})[\x20\t\r]*$"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30  # base: words, and percent of words in repeated windows

# Frequent words of the languages that the rules expect, English, German, French, Spanish.
STOP_WORDS = ("the of and to a in is that it for was on with be as by this are "
              "der die und in den von zu das mit sich des auf im ist nicht dem ein eine "
              "de la le et les des en un du que une pour est qui dans par pas au sur "
              "que el en y los se del las por un con no una su para es al lo").split()


@dataclass(frozen=True)
class Rule:
    """``least`` <= 100 * measure / per <= ``most``; a bound of None does not bind, and neither does a rule where ``per`` is 0."""

    name: str
    measure: str
    per: str
    least: int | None = None
    most: int | None = None


# The thresholds, in percent.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 2000),
    Rule("symbols", "n_symbols", "n_words", None, 20),
    Rule("lettered_words", "n_lettered", "n_words", 60, None),
    Rule("stop_words", "n_stop_words", "n_words", 1, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullets", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipses", "n_lines", None, 50),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lettered", "n_stop_words", "n_lines", "n_dup_lines", "n_bullets",
            "n_ellipses", "n_repeat_words")


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules from a table (name, measure, per, least, most) of at most 1,000 rows; more are an error."""
    rows = table.select("name", "measure", "per", "least", "most").orderBy("name").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("a threshold table has at most 1,000 rows")
    return [Rule(*r) for r in rows]


def broken(rule: Rule) -> Column:
    """Does a row of measures break the rule? Never null."""
    for name in (rule.measure, rule.per):
        if name not in MEASURES:
            raise ValueError(f"{name} is no measure")
    share, per = F.col(rule.measure) * 100, F.col(rule.per)
    out = F.lit(False)
    if rule.least is not None:
        out = out | (share < per * rule.least)
    if rule.most is not None:
        out = out | (share > per * rule.most)
    return (per > 0) & out


def stop_forms() -> list[str]:
    """Stop words as they stand in texts: as they are and with a capital."""
    return sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the MEASURES of each whole text, as longs.

    A null text is an empty one, whose measures are all 0. Repeated rows are measured each, null keys too; an empty
    table gives no row; other columns are not read. Steps are columns of their own so that each array is made once.
    """
    windows = F.transform(F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
                          lambda w, i: F.xxhash64(w, *[F.get("_words", i + j) for j in range(1, WINDOW)]))
    # Hashes only say that no window repeats; where one may, the windows are compared as texts.
    as_text = F.sort_array(F.transform(F.slice("_words", 1, F.size("_words") - (WINDOW - 1)), lambda w, i: F.struct(
        F.array_join(F.slice("_words", i + 1, WINDOW), " ").alias("w"), i.alias("at"))))
    repeated = F.sort_array(F.transform(F.filter("_sorted", lambda s, i: (
        F.coalesce(F.get("_sorted", i - 1)["w"] == s["w"], F.lit(False))
        | F.coalesce(F.get("_sorted", i + 1)["w"] == s["w"], F.lit(False)))), lambda s: s["at"]))
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("_at", i + 1), p + WINDOW) - p)), F.lit(0), lambda total, n: total + n)
    with_word = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD))
    none = F.array().cast("array<struct<w:string,at:int>>")
    steps = (docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
             .withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
             .withColumn("_lines", with_word)
             .withColumn("_windows", windows)
             .withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), as_text).otherwise(none))
             .drop("_windows")
             .withColumn("_at", repeated).drop("_sorted"))
    found = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOL)),
        "n_lettered": F.regexp_count("_text", F.lit(LETTERED)),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop_forms()))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullets": F.size(F.filter("_lines", lambda line: line.rlike(BULLET))),
        "n_ellipses": F.size(F.filter("_lines", lambda line: line.rlike(ELLIPSIS))),
        "n_repeat_words": covered,
    }
    return steps.select(F.col("_key").alias(key), *[found[m].cast("bigint").alias(m) for m in MEASURES])


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``measures`` returns, with base_failed, failed (names of the rules a text breaks, in their order) and kept.

    ``base_failed``: fewer than LEAST_WORDS words, or over MOST_REPEATED percent of the words in windows of eight words that
    occur twice or more in the text. ``kept``: neither that nor any rule. A text without words fails at the base. Further
    cases as in ``measures``.
    """
    names = F.array(*[F.when(broken(r), r.name) for r in rules]) if rules else F.array().cast("array<string>")
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    measured = measures(docs, key, text)
    return (measured.withColumn("base_failed", base).withColumn("failed", F.array_compact(names))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))
