"""Quality rules, line first: rules judge each line, failing lines go, and a text that loses too much of itself goes too.

Native: split, sort and array functions only, so Spark runs it inside the scan's own stage.  Nothing is
shuffled; a row's arrays are as long as its text.

A null text is an empty one: no words, no lines, `base_failed`, not kept.  Rows are judged one by one, so equal
rows, null ids and repeated ids all come back as they are; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that parts words, and the characters that count as symbols.
SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: A sentence's end: a stop, with quotes or brackets behind it if any, at the end of a line.
SENTENCE_END = r"""[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}]["')\]\x{2019}\x{201D}\x{BB}]*$"""
#: A word whose end or whole is a run of signs, as in shouting and in mangled text.
SIGN_RUN = r"[!?#*$%&|<>=~_^+]{2,}"
#: A sign that stands between the entries of a menu or a trail.
SEPARATORS = "|/>\xbb\u203a\u2022\xb7"
SEPARATOR = rf"(?:^|[\x20\x09-\x0D])[{SEPARATORS}]+(?:[\x20\x09-\x0D]|$)"
#: What pages say about themselves, in whole words.
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies", "enable javascript", "lorem ipsum",
    "sign up to", "sign in to", "log in to", "subscribe to our", "click here to", "read more", "share this", "skip to content", "back to top",
)
BOILERPLATE = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(PHRASES)})(?:[^\p{{L}}\p{{N}}]|$)"
#: A line fails when more than one word in so many carries a run of signs, or is a separator.
ONE_IN = 4
MIN_WORDS = 50  # the base rules: fewer words fail
MAX_REPEATED = 50  # per cent of words in windows that occur twice
MIN_KEPT = 50  # per cent of a text's characters that must be in lines that pass


def line_fails(line: Column, with_signs: Column, with_phrases: Column) -> Column:
    """Whether a trimmed line with a word breaks a rule: no sentence end, runs of signs, a menu, or boilerplate.

    The flags say whether the whole text holds a separator or a phrase at all; most hold none, and their lines are
    not searched for any.
    """
    words = F.regexp_count(line, F.lit(WORD))
    return (
        ~F.right(line, F.lit(8)).rlike(SENTENCE_END)
        | (line.rlike(SIGN_RUN) & (F.regexp_count(line, F.lit(SIGN_RUN)) * ONE_IN > words))
        | (with_signs & (F.regexp_count(line, F.lit(SEPARATOR)) * ONE_IN > words))
        | (with_phrases & line.rlike(BOILERPLATE))
    )


def _holds_any(text: Column, parts: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda total, x: total + F.length(x))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, the verdicts, and `clean_text`, the lines that pass, joined by line breaks.

    Repeated windows of three words are found by sorting a text's own windows, so a text of n words costs
    n * log(n) whatever repeats in it.  Each step is a projection of its own, so that none is computed twice.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    trimmed = text.select("doc_id", "text", F.btrim("text", F.lit(SPACE)).alias("body"), F.lower("text").alias("low"))
    no_words = F.array().cast("array<string>")
    split = trimmed.select(
        "doc_id",
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.when(F.col("body") != "", F.split("body", SPACES)).otherwise(no_words).alias("first"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
        _holds_any(F.col("text"), SEPARATORS).alias("with_signs"),
        _holds_any(F.col("low"), PHRASES).alias("with_phrases"),
    )
    counted = split.select(
        "doc_id", "n_symbols",
        F.size("first").cast("bigint").alias("n_words"),
        F.length(F.array_join("first", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "first",
        F.slice("first", 2, F.size("first")).alias("second"),
        F.slice("first", 3, F.size("first")).alias("third"),
        F.sequence(F.lit(1), F.greatest(F.size("first"), F.lit(1))).alias("at"),
        F.transform("lines", lambda x: F.btrim(x, F.lit(SPACE))).alias("lines"), "with_signs", "with_phrases",
    )
    results = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    carried = [*results, "lines", "with_signs", "with_phrases"]
    windows = counted.select(*carried, F.sort_array(F.arrays_zip("first", "second", "third", "at")).alias("left"))
    windows = windows.select(*carried, "left", F.slice("left", 2, F.size("left")).alias("right"))

    def equal(pair: Column) -> Column:  # the last words differ most often
        return (
            (pair["left"]["third"] == pair["right"]["third"])
            & (pair["left"]["second"] == pair["right"]["second"])
            & (pair["left"]["first"] == pair["right"]["first"])
        )

    twice = F.filter(F.arrays_zip("left", "right"), equal)
    places = F.flatten(F.transform(twice, lambda p: F.array(*[p[side]["at"] + i for side in ("left", "right") for i in range(3)])))
    passing = F.filter("lines", lambda x: ~line_fails(x, F.col("with_signs"), F.col("with_phrases")))
    found = windows.select(
        *results, "lines", F.size(F.array_distinct(places)).cast("bigint").alias("n_repeat_words"), passing.alias("passing")
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    weighed = found.select(
        *results, "n_repeat_words", base_failed.alias("base_failed"),
        F.size("lines").cast("bigint").alias("n_lines"), F.size("passing").cast("bigint").alias("n_kept_lines"),
        _chars(F.col("lines")).alias("line_chars"), _chars(F.col("passing")).alias("kept_chars"),
        F.array_join("passing", "\n").alias("clean_text"),
    )
    enough = (F.col("line_chars") > 0) & (100 * F.col("kept_chars") >= MIN_KEPT * F.col("line_chars"))
    return weighed.withColumn("kept", ~F.col("base_failed") & enough)
