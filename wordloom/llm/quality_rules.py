"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Null texts count as empty: no words, base rule failed, not kept.  Every input row gives one
result row; repeated rows and repeated ids are judged one by one.  Other columns of the input
are dropped, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import SPACE_CHARS, let, space_words

# The symbols and the base rule's numbers of the contract.
SYMBOLS = "#*$%&|<>"
BASE_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

# Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in that is for it with as was on be at by are this from or an "
    "der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un une du que est pour qui dans au sur par pas plus ce il elle "
    "el los las y del se por con no una su para al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text if ``low <= measure <= high``."""

    measure: str
    low: float
    high: float


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", 0.0, 0.1),
    Rule("stop_word_ratio", 0.02, 0.95),
    Rule("dup_line_ratio", 0.0, 0.5),
    Rule("bullet_line_ratio", 0.0, 0.9),
    Rule("ellipsis_line_ratio", 0.0, 0.3),
    Rule("letter_word_ratio", 0.7, 1.0),
    Rule("shouted_word_ratio", 0.0, 0.3),
)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more in ``words``."""
    width = REPEAT_WINDOW
    hashes = F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(
            F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), starts, lambda b, a: F.least(F.lit(width), b - a)
        )
        # the last start has no successor: its null gap counts as a whole window
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + F.coalesce(gap, F.lit(width)))

    def among(ordered: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return let(F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"])), covered)

    def count(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(ordered, among))

    return let(hashes, count)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the contract's counts and one column for each measure of the rules."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select("doc_id", body.alias("body"), space_words(body).alias("words"), F.split(body, "\n").alias("raw"))
    has_word = lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != ""
    rows = base.select("doc_id", "body", "words", F.filter("raw", has_word).alias("lines"))
    words, lines = F.col("words"), F.col("lines")
    n_words, n_lines = F.size(words), F.size(lines)
    counted = rows.select(
        "doc_id",
        n_words.cast("bigint").alias("n_words"),
        F.length(F.translate("body", SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(words).cast("bigint").alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("n_stop"),
        F.size(F.filter(words, lambda w: w.rlike(r"\p{IsAlphabetic}"))).alias("n_letter"),
        F.size(F.filter(words, lambda w: (F.length(w) > 2) & (w == F.upper(w)) & (w != F.lower(w)))).alias("n_shouted"),
        F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^[-*•]"))).alias("n_bullet"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"(\.\.\.|…)$"))).alias("n_ellipsis"),
    )
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _share(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _share(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        _share(F.col("n_stop"), F.col("n_words")).alias("stop_word_ratio"),
        _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _share(F.col("n_bullet"), F.col("n_lines")).alias("bullet_line_ratio"),
        _share(F.col("n_ellipsis"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        _share(F.col("n_letter"), F.col("n_words")).alias("letter_word_ratio"),
        _share(F.col("n_shouted"), F.col("n_words")).alias("shouted_word_ratio"),
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The measures of every row of ``docs`` with ``base_failed`` and the verdict ``kept``."""
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    passed = F.lit(True)
    for rule in rules:
        passed = passed & F.col(rule.measure).between(rule.low, rule.high)
    return measures(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passed)
