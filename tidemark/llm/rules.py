"""Quality rules: one table of thresholds, compiled into one projection."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his from at are this or an which "
    "der die das und ist von zu den mit für auf im nicht ein eine sich des dem auch "
    "le la les et un une du est que qui dans pour pas sur par au aux "
    "el los las y en por con para del se no al lo como su"
).split()

#: Measure, least value and greatest value that a kept document may have; None leaves a side open.
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 16.0),
    ("symbols_per_word", None, 0.1),
    ("marks_per_word", None, 0.5),
    ("stop_word_ratio", 0.02, None),
    ("repeat_word_ratio", None, 0.5),
    ("dup_line_ratio", None, 0.5),
    ("ellipsis_line_ratio", None, 0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words in windows of three words found twice or more.

    The windows' hashes are sorted with their places, so that equal ones are
    neighbours; a text of n words costs n log n, not n squared.
    """

    def window(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.array_sort(F.transform(at, lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i"))))

    def count(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, b)["h"] == a["h"], F.lit(False))
        twice = F.filter(s, lambda x, k: same(x, k + 1) | same(x, k - 1))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(window(w), count))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the counts that the rules use, for every row; null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_text"))
    full = F.filter(F.split("_text", "\n"), lambda line: F.regexp_replace(line, BLANK, "") != "")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    counted = base.select(
        id_col,
        let(words_of(F.col("_text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )).alias("w"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length("_text") - F.length(F.translate("_text", "!?", ""))).cast("long").alias("n_marks"),
        let(full, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda line: F.rtrim(line).rlike(r"(\.\.\.|…)$"))).cast("long").alias("n_ellipsis_lines"),
        )).alias("l"),
    ).select(id_col, "w.*", "l.*", "word_chars", "n_symbols", "n_marks")
    return counted.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("n_marks", "n_words").alias("marks_per_word"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio"),
    )


def compile_rules(rules: tuple = RULES) -> Column:
    """The table as one condition: true where every measure is within its bounds."""
    bounds = []
    for name, low, high in rules:
        if low is not None:
            bounds.append(F.col(name) >= F.lit(low))
        if high is not None:
            bounds.append(F.col(name) <= F.lit(high))
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple = RULES) -> DataFrame:
    """Every row's id, counts, ratios, ``base_failed`` and ``kept``.

    ``base_failed``: under 50 words, or over half of the words in windows of
    three words found twice or more in the text. ``kept``: not that, and within
    all thresholds. A null or empty text has no words, no lines and ratios of 0;
    it fails. Null and repeated ids are rows like any other; other columns are
    not read. Windows are told apart by 64-bit hashes.
    """
    measured = measures(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & compile_rules(rules))
