"""Sentence ends learned from the corpus itself, without labels.

The published unsupervised method (Kiss and Strunk 2006): log-likelihood ratios tell abbreviations from words that
happen to end sentences, pairs of words that belong together across a period, and words that often begin a
sentence; how a word is written elsewhere decides what is left.  All of it follows from two aggregations over the text,
counts per word type and counts per pair of types around a period.  Nothing is collected: the model is a set of tables.

Words stand between blanks.  Quotes and brackets around a word and commas, colons and semicolons behind it are not part of it.
Numbers are one type.  A line never shares a sentence with the next one; a line without words has no sentence.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.functions.columns import once
from wordloom.operators.joins import skew_safe_join
from wordloom.sources.scratch import materialize

# The method's published thresholds and the probability of a period behind an abbreviation.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
PERIOD_AFTER_ABBREVIATION = 0.99
OPENING, CLOSING, PAUSE = "(\"'[{«“‘¿¡", ")\"']}»”’", ",;:"
NUMBER = "#"
COUNTS = ["upper_begin", "lower_begin", "upper_inside", "lower_inside", "upper_unknown"]


class SentenceModel(NamedTuple):
    """``types(typ, n, n_period, ...)`` and ``collocations(typ, next, n, score)``, both written tables."""

    types: DataFrame
    collocations: DataFrame


def line_words(line: Column) -> Column:
    """The words of a line as they stand between blanks."""
    return F.array_remove(F.split(F.regexp_replace(line, tx.SPACE_CLASS, " "), " "), "")


def _case(word: Column) -> Column:
    return F.when(F.regexp_like(word, F.lit("^\\p{Ll}")), "lower").when(F.regexp_like(word, F.lit("^\\p{Lu}")), "upper").otherwise("none")


def _told(typ: Column, case: Column, end: Column) -> Column:
    return F.struct(typ.alias("typ"), case.alias("case"), end.alias("end"))


def _describe_core(word: Column, core: Column) -> Column:
    """``describe`` for a word of which ``core`` is left between quotes, brackets and pauses."""
    period = core.endswith(".") & ~core.endswith("..")
    # of a word with a core, all that may stand behind it
    paused = F.translate(F.substring(word, F.length(F.rtrim(word, F.lit(CLOSING + PAUSE))) + 1, F.length(word)), CLOSING, "") != ""
    end = F.when(period, F.when(paused, "paused").otherwise("period")).when((core.endswith("!") | core.endswith("?")) & ~paused, "mark").otherwise("plain")
    bare = F.lower(F.when(period, F.substring(core, F.lit(1), F.length(core) - 1)).otherwise(core))
    return _told(F.when(F.regexp_like(core, F.lit("^[0-9][0-9.,]*$")), NUMBER).otherwise(bare), _case(core), end)


def describe(word: Column) -> Column:
    """Type, case of the first letter and kind of end of one word.

    ``end``: ``mark`` (! or ?), ``period`` (one period), ``paused`` (a period with a pause behind it) or ``plain``.
    A word of letters, as most are, is its own type and skips the rest.
    """
    core = F.rtrim(F.ltrim(word, F.lit(OPENING)), F.lit(CLOSING + PAUSE))
    # inside a lambda nothing is shared: the core is bound by a transform of its own, so it is found once
    marked = F.transform(F.array(core), lambda c: _describe_core(word, c))[0]
    return F.when(F.regexp_like(word, F.lit("^\\p{L}+$")), _told(F.lower(word), _case(word), F.lit("plain"))).otherwise(marked)


def _described(lines: DataFrame) -> DataFrame:
    """One row per word with the one before it in its line."""
    words = lines.select(once("words", F.transform(line_words(F.col("line")), describe)))
    pairs = F.transform("words", lambda w, i: F.struct(F.get("words", i - 1).alias("prev"), w.alias("word")))
    return words.select(once("pairs", pairs)).select(F.explode("pairs").alias("p")).select("p.prev", "p.word")


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, 0.0).otherwise(x * F.log(F.when(x != 0, y)))


def _association(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of ``ab`` joint occurrences of events seen ``a`` and ``b`` times among ``n``."""
    p, p1, p2 = b / n, ab / a, F.when(n > a, (b - ab) / (n - a)).otherwise(0.0)
    joint = _xlogy(ab, p) + _xlogy(a - ab, 1 - p) + _xlogy(b - ab, p) + _xlogy(n - a - b + ab, 1 - p)
    apart = _xlogy(ab, p1) + _xlogy(a - ab, 1 - p1) + _xlogy(b - ab, p2) + _xlogy(n - a - b + ab, 1 - p2)
    return -2.0 * (joint - apart)


def _abbreviation_score(n: Column, n_period: Column, periods: Column, total: Column, typ: Column) -> Column:
    """How much likelier the periods behind a type are if it is an abbreviation, less for long types and for plain uses."""
    p, q = periods / total, F.lit(PERIOD_AFTER_ABBREVIATION)
    null = _xlogy(n_period, p) + _xlogy(n - n_period, 1 - p)
    other = _xlogy(n_period, q) + _xlogy(n - n_period, 1 - q)
    inner = F.length(typ) - F.length(F.translate(typ, ".", ""))
    letters = F.length(typ) - inner
    return -2.0 * (null - other) * F.exp(-letters.cast("double")) * (inner + 1) * F.pow(letters.cast("double"), -(n - n_period).cast("double"))


def train(lines: DataFrame) -> SentenceModel:
    """The model of all ``lines(.., line)``."""
    words = _described(lines)
    typ, case, before = F.col("word.typ"), F.col("word.case"), F.col("prev.end")
    ends_period = F.col("word.end").isin("period", "paused")
    begins = before.isNull() | (before == "mark")
    inside = before == "plain"

    def number(of: Column, name: str) -> Column:
        return F.count_if(of).alias(name)

    counted = words.groupBy(typ.alias("typ")).agg(
        F.count("*").alias("n"), number(ends_period, "n_period"),
        number(begins & (case == "upper"), "upper_begin"), number(begins & (case == "lower"), "lower_begin"),
        number(inside & (case == "upper"), "upper_inside"), number(inside & (case == "lower"), "lower_inside"),
    )
    counted = materialize(counted, "sentence_types")
    # words behind a period: what they count for depends on the type before it
    around = words.where(before.isin("period", "paused")).groupBy(
        F.col("prev.typ").alias("typ"), (before == "paused").alias("paused"), typ.alias("next"), case.alias("case")
    ).agg(F.count("*").alias("n"))
    around = materialize(around, "sentence_pairs")
    total, periods = counted.agg(F.sum("n"), F.sum("n_period")).first()
    total, periods = F.lit(float(total or 0)), F.lit(float(periods or 0))
    has_letter = F.regexp_like("typ", F.lit("\\p{L}"))
    score = _abbreviation_score(F.col("n"), F.col("n_period"), periods, total, F.col("typ"))
    scored = counted.withColumn("score", F.when(has_letter & (F.col("n_period") > 0) & (periods < total), score))
    scored = materialize(scored.withColumn("abbreviation", F.coalesce(F.col("score") >= ABBREVIATION, F.lit(False))), "sentence_scores")

    initial = (F.length("typ") == 1) & F.regexp_like("typ", F.lit("\\p{L}"))
    flags = scored.select("typ", "abbreviation", F.col("n").alias("n_typ"))
    known = skew_safe_join(around, flags, "typ", "n_typ")
    known = materialize(known.withColumn("ends", ~F.col("abbreviation") & ~F.col("paused")), "sentence_ends")
    breaks = F.lit(float(known.where("ends").agg(F.sum("n")).first()[0] or 0))
    starts = known.where(F.col("ends")).groupBy(F.col("next").alias("typ")).agg(
        F.sum("n").alias("n_start"),
        F.sum(F.when((F.col("typ") != NUMBER) & ~initial, F.col("n")).otherwise(0)).alias("n_after_word"),
        F.sum(F.when(F.col("case") == "upper", F.col("n")).otherwise(0)).alias("upper_more"),
        F.sum(F.when(F.col("case") == "lower", F.col("n")).otherwise(0)).alias("lower_more"),
    )
    behind = known.where(~F.col("ends")).groupBy(F.col("next").alias("typ")).agg(
        F.sum(F.when(F.col("case") == "lower", F.col("n")).otherwise(0)).alias("lower_unknown"),
        F.sum(F.when(F.col("case") == "upper", F.col("n")).otherwise(0)).alias("upper_unknown"),
    )
    both = scored.join(starts, "typ", "left").join(behind, "typ", "left").fillna(0)
    n_after = F.col("n_after_word").cast("double")
    linked = _association(breaks, F.col("n").cast("double"), n_after, total)
    often = (n_after > 0) & has_letter & (total * n_after > F.col("n") * breaks)
    types = both.select(
        "typ", "n", "n_period", "score", "abbreviation",
        F.when(often, linked).alias("start_score"), F.coalesce(often & (linked >= STARTER), F.lit(False)).alias("starter"),
        (F.col("upper_begin") + F.col("upper_more")).alias("upper_begin"), (F.col("lower_begin") + F.col("lower_more")).alias("lower_begin"),
        "upper_inside", (F.col("lower_inside") + F.col("lower_unknown")).alias("lower_inside"), "upper_unknown",
    )
    types = materialize(types, "sentence_model")

    special = F.col("abbreviation") | (F.col("typ") == NUMBER) | initial
    pairs = known.where(special & ~F.col("paused")).groupBy("typ", "n_typ", "next").agg(F.sum("n").alias("n"))
    pairs = skew_safe_join(pairs, types.select(F.col("typ").alias("next"), F.col("n").alias("n_next")), "next", "n_next")
    a, b, ab = (F.col(c).cast("double") for c in ("n_typ", "n_next", "n"))
    pairs = pairs.where((ab > 1) & F.regexp_like("next", F.lit("[\\p{L}#]")) & (total * ab > a * b))
    pairs = pairs.withColumn("score", _association(a, b, ab, total)).where(F.col("score") >= COLLOCATION)
    return SentenceModel(types, materialize(pairs.select("typ", "next", "n", "score"), "sentence_collocations"))


def scores(model: SentenceModel) -> DataFrame:
    """``(kind, typ, next, n, score)``: what the model holds for abbreviations, starters and collocations."""
    types = model.types
    none = F.lit(None).cast("string").alias("next")
    abbreviations = types.where("abbreviation").select(F.lit("abbreviation").alias("kind"), "typ", none, F.col("n_period").alias("n"), "score")
    starters = types.where("starter").select(F.lit("starter").alias("kind"), "typ", none, "n", F.col("start_score").alias("score"))
    pairs = model.collocations.select(F.lit("collocation").alias("kind"), "typ", "next", "n", "score")
    return abbreviations.unionByName(starters).unionByName(pairs)


def _ends_sentence() -> Column:
    """Whether the period behind ``typ``, followed by ``next`` written as ``case``, ends a sentence."""
    initial = (F.length("typ") == 1) & F.regexp_like("typ", F.lit("\\p{L}"))
    upper, lower = F.col("case") == "upper", F.col("case") == "lower"
    lowers = F.col("lower_begin") + F.col("lower_inside")
    uppers = F.col("upper_begin") + F.col("upper_inside") + F.col("upper_unknown")
    begins = upper & (lowers > 0) & (F.col("upper_inside") == 0)
    goes_on = lower & ((uppers > 0) | (F.col("lower_begin") == 0))
    return (
        F.when(F.col("together"), False)
        .when(F.col("abbreviation") & ~initial, begins | (upper & F.col("starter")))
        .when(initial | (F.col("typ") == NUMBER), ~F.col("abbreviation") & ~goes_on & ~(initial & ~begins & upper & (lowers == 0)))
        .otherwise(True)
    )


def segment(lines: DataFrame, model: SentenceModel, key: list[str] | None = None) -> DataFrame:
    """``lines`` with ``sentences``, an array: the words of each sentence, joined by blanks.

    ``key`` names the columns that tell lines apart.  Only words with a period inside a line meet the model's
    tables; of a line's text nothing but these words is joined.
    """
    key = key or ["doc_id", "line_no"]
    words = lines.select("*", F.xxhash64("line").alias("_digest"), once("_words", line_words(F.col("line"))))
    told = words.select(*key, "_digest", once("t", F.transform("_words", describe)))
    ended = F.filter(F.transform("t", lambda w, i: F.struct(
        i.alias("at"), w["typ"].alias("typ"), w["end"].alias("end"), F.get("t", i + 1).alias("after"))),
        lambda s: s["after"].isNotNull() & s["end"].isin("period", "mark"))
    spots = told.select(*key, "_digest", once("spots", ended)).select(*key, "_digest", F.explode("spots").alias("s"))
    # written, for each join below may read them several times; what the model knows changes nothing for marks
    spots = materialize(spots.select(*key, "_digest", "s.at", "s.typ", "s.end", F.col("s.after.typ").alias("next"), F.col("s.after.case").alias("case")), "sentence_spots")
    spots = skew_safe_join(spots, model.types.select("typ", "abbreviation", F.col("n").alias("n_typ")), "typ", "n_typ", how="left")
    about = model.types.select(F.col("typ").alias("next"), "starter", *COUNTS, "n")
    spots = skew_safe_join(spots, about, "next", "n", how="left")
    together = model.collocations.select("typ", "next", F.lit(True).alias("together"))
    # words that the model has not seen are no abbreviations and never written otherwise
    spots = spots.join(together, ["typ", "next"], "left")
    spots = spots.fillna(False, ["together", "abbreviation", "starter"]).fillna(0, COUNTS)
    ends = spots.where((F.col("end") == "mark") | _ends_sentence()).select(*key, "_digest", "at")
    # rows that share a key are told apart by their text; equal rows have equal ends
    by_line = ends.groupBy(*key, "_digest").agg(F.sort_array(F.collect_set(F.col("at") + 1)).alias("_ends")).alias("e")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*key, "_digest"]]
    joined = words.alias("w").join(by_line, same, "left").select("w.*", "_ends")
    edges = F.concat(F.array(F.lit(0)), F.coalesce("_ends", F.array().cast("array<int>")), F.array(F.size("_words")))
    joined = joined.select("*", once("_edges", edges))
    cut = F.transform(F.sequence(F.lit(0), F.size("_edges") - 2), lambda i: F.array_join(
        F.slice("_words", F.get("_edges", i) + 1, F.get("_edges", i + 1) - F.get("_edges", i)), " "))
    return joined.withColumn("sentences", F.when(F.size("_words") > 0, cut).otherwise(F.array().cast("array<string>"))).drop("_words", "_digest", "_ends", "_edges")


def sentences_of(lines: DataFrame, model: SentenceModel) -> DataFrame:
    """``(doc_id, line_no, sent_no, sentence)``: each sentence of each line."""
    cut = segment(lines, model).select("doc_id", "line_no", once("sentences", F.col("sentences")))
    return cut.select("doc_id", "line_no", F.posexplode("sentences").alias("sent_no", "sentence"))
