"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (term, document, position) for each training token that some test
item also uses; other tokens cannot take part in a match.  A phrase is looked up from its
rarest terms: the posting lists of the two rarest are shifted by the terms' offsets and
intersected on (document, start), and what is left is compared word by word.  Documents never
meet each other and a hot term is only listed for phrases that have no rarer one.

Near matches (``proximity_matches``) are places where all distinct terms of a phrase stand within ``slop``
words of one of its rarest, in any order, but for one term of a phrase of ``TOLERANT`` and more.  With
one missing, one of the two rarest is still there, and so are two of the three rarest.  So the posting
lists of these three meet in a window of ``slop`` positions on either side, and where enough of them
stand together the other terms are counted in the text around.

Null or empty texts have no words and no hits; items without words are no phrase.  Rows without
``doc_id`` are never hit.  Rows that repeat a ``doc_id`` each give a result row and share their hits.  Only ``doc_id``/``item_id`` and ``text`` are read, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wordloom.llm.words import alnum_words
from wordloom.sources.scratch import materialize

WINDOW = 10
# A table of the test items is broadcast up to so many rows; else it is joined by a shuffle.
BROADCAST_ROWS = 200_000
# Near matches: words between a rare term and the others at most; distinct terms from which one may be missing.
SLOP, TOLERANT = 20, 5
# Posting lists that meet for a near match.
NEAR_LISTS = 3


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcast if it is short enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id and phrase (array of words): each ``window`` consecutive words, or all of a shorter item."""
    words = items.select("item_id", alnum_words(F.col("text")).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1)))
    return (
        words.where(n > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), F.lit(window)).alias("phrase"))
        .distinct()
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Write the postings (doc_id, pos, term) of ``terms``; a row without term gives a document's n_words."""
    words = docs.select("doc_id", alnum_words(F.col("text")).alias("words"))
    marked = words.select("doc_id", F.size("words").alias("n_words"), F.concat(F.array(F.lit("")), "words").alias("words"))
    tokens = marked.select("doc_id", "n_words", F.posexplode("words").alias("at", "word"))
    known = small(terms.select(F.col("term").alias("word"), F.lit(True).alias("known")))
    return materialize(
        tokens.join(known, "word", "left")
        .where(F.col("known") | (F.col("at") == 0))
        .select(
            "doc_id",
            (F.col("at") - 1).alias("pos"),
            F.when(F.col("at") > 0, F.col("word")).alias("term"),
            F.when(F.col("at") == 0, F.col("n_words")).alias("n_words"),
        ),
        "postings",
    )


def postings(index: DataFrame) -> DataFrame:
    return index.where(F.col("term").isNotNull()).select("doc_id", "pos", "term")


def ranked_terms(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Write phrase_id, term, offset, rank, terms: the distinct terms of each phrase, those with the fewest
    postings first; ``terms`` counts them."""
    counts = postings(index).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = phrases.select("phrase_id", F.posexplode("phrase").alias("offset", "term"))
    first = terms.groupBy("phrase_id", "term").agg(F.min("offset").alias("offset"))
    order = Window.partitionBy("phrase_id").orderBy("n", "term")
    # a term without postings ends its phrase: inner joins on it find nothing
    ranked = first.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = ranked.withColumn("rank", F.row_number().over(order))
    return materialize(ranked.withColumn("terms", F.count(F.lit(1)).over(Window.partitionBy("phrase_id"))), "ranked")


def phrase_matches(docs: DataFrame, phrases: DataFrame, ranked: DataFrame, index: DataFrame) -> DataFrame:
    """phrase_id, doc_id, start (from 0), length: each place where the words of ``phrase`` stand in a row."""

    def shifted(rank: int) -> DataFrame:
        listed = small(ranked.where(F.col("rank") == rank).select("phrase_id", "term", "offset", "terms"))
        start = (F.col("pos") - F.col("offset")).alias("start")
        return postings(index).join(listed, "term").select("phrase_id", "doc_id", start, "terms").where("start >= 0")

    first = shifted(1)
    both = first.where("terms > 1").join(shifted(2), ["phrase_id", "doc_id", "start"], "left_semi")
    places = first.where("terms = 1").unionByName(both).join(small(phrases), "phrase_id")
    # exact check of the candidates, a document's at once
    listed = places.groupBy("doc_id").agg(F.collect_list(F.struct("phrase_id", "start", "phrase")).alias("places"))
    # (texts are shuffled as they are and split behind the join: word arrays are twice as large)
    texts = docs.select("doc_id", "text").join(listed, "doc_id").select("doc_id", "places", alnum_words(F.col("text")).alias("words"))
    same = lambda p: F.slice(F.col("words"), p["start"] + 1, F.size(p["phrase"])) == p["phrase"]
    found = texts.select("doc_id", F.explode(F.filter("places", same)).alias("p"))
    return found.select("p.phrase_id", "doc_id", "p.start", F.size("p.phrase").alias("length"))


def proximity_matches(docs: DataFrame, ranked: DataFrame, index: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, phrase_id (may repeat): documents where a phrase's terms stand near each other.

    The lists of the three rarest terms are dealt by phrase and document, so neither a hot term nor a long
    document comes into one task whole.
    """
    spare = (F.col("terms") >= TOLERANT).cast("int")
    rarest = small(ranked.where(F.col("rank") <= NEAR_LISTS).select("phrase_id", "term", "rank", "terms"))
    lists = postings(index).where("doc_id IS NOT NULL").join(rarest, "term").select("phrase_id", "doc_id", "pos", "rank", "terms")
    around = Window.partitionBy("phrase_id", "doc_id").orderBy("pos").rangeBetween(-slop, slop)
    met = F.bit_count(F.bit_or(F.expr("shiftleft(1, rank)")).over(around))
    enough = F.least("terms", F.lit(NEAR_LISTS)) - spare
    heads = lists.withColumn("met", met).where((F.col("rank") <= 1 + spare) & (F.col("met") >= enough))
    places = heads.groupBy("phrase_id", "doc_id").agg(F.collect_list("pos").alias("places"))
    in_order = F.sort_array(F.collect_list(F.struct("rank", "term")))
    terms = materialize(ranked.groupBy("phrase_id").agg(in_order["term"].alias("terms")), "near-terms")
    # the other terms of what is left, a document's at once
    listed = places.join(small(terms), "phrase_id").groupBy("doc_id")
    listed = listed.agg(F.collect_list(F.struct("phrase_id", "places", "terms")).alias("phrases"))
    texts = docs.select("doc_id", "text").join(listed, "doc_id").select("doc_id", "phrases", alnum_words(F.col("text")).alias("words"))

    def close(phrase: Column) -> Column:
        terms, size = phrase["terms"], F.size(phrase["terms"])
        spare = (size >= TOLERANT).cast("int")

        def here(at: Column) -> Column:
            low = F.greatest(at - slop, F.lit(0))
            met = F.array_intersect(F.slice("words", low + 1, at - low + slop + 1), terms)
            # (a place may come from another row with the same id)
            return F.array_contains(F.slice(terms, F.lit(1), spare + 1), F.get("words", at)) & (F.size(met) >= size - spare)

        return F.exists(phrase["places"], here)

    return texts.select("doc_id", F.explode(F.filter("phrases", close)).alias("p")).select("doc_id", "p.phrase_id")


def _covered(spans: Column) -> Column:
    """Positions covered by ``spans``, an array of (start, end) sorted by start."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], done["end"]), F.lit(0))
        return F.struct(F.greatest(done["end"], span["end"]).alias("end"), (done["n"] + new).alias("n"))

    return F.aggregate(spans, start, add, lambda done: done["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, near: bool = False) -> DataFrame:
    """Per document: n_words, n_hit (words inside windows of items), n_items, items_sha256, contaminated;
    with ``near`` also n_near and near_items (ids joined by commas) of the items with a window matched nearly or exactly."""
    of_items = materialize(item_windows(items, window), "windows")
    # numbered once and written, so that every reader sees the same numbers
    phrases = of_items.select("phrase").distinct().select(F.monotonically_increasing_id().alias("phrase_id"), "phrase")
    phrases = materialize(phrases, "distinct-windows")
    index = build_index(docs, materialize(phrases.select(F.explode("phrase").alias("term")).distinct(), "terms"))
    ranked = ranked_terms(phrases, index)
    found = materialize(phrase_matches(docs, phrases, ranked, index), "matches")
    spans = found.select("doc_id", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    hits = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    hits = hits.select("doc_id", _covered(F.col("spans")).alias("n_hit"))
    named = of_items.join(phrases, "phrase").select("item_id", "phrase_id")
    met = found.select("doc_id", "phrase_id").distinct().join(named, "phrase_id").select("doc_id", "item_id").distinct()
    listed = met.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    base = index.where(F.col("term").isNull()).select("doc_id", F.col("n_words").cast("bigint").alias("n_words"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    joined, more = base.join(hits, "doc_id", "left").join(listed, "doc_id", "left"), []
    if near:
        # (an exact place is a near one unless its phrase repeats one term further than the slop)
        close = proximity_matches(docs, ranked, index).unionByName(found.select("doc_id", "phrase_id")).distinct()
        close = close.join(named, "phrase_id").select("doc_id", "item_id").distinct()
        close = close.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("close"))
        joined = joined.join(close, "doc_id", "left")
        close_ids = F.coalesce("close", F.array().cast("array<string>"))
        more = [F.size(close_ids).cast("bigint").alias("n_near"), F.array_join(close_ids, ",").alias("near_items")]
    return joined.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        *more,
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of the items."""
    bad = contamination(docs, items, window).where("contaminated").select("doc_id")
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
