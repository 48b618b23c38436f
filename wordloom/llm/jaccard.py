"""Word n-gram Jaccard join: which texts share enough of their n-grams, and what they hang together with.

A text's set holds the 64-bit hashes of its distinct n-grams of ``size`` words.  Two texts link
when ``per * intersection >= least * union``.

1. Texts of equal sets are one class; its least id stands for it.
2. Blocking loses no link: two sets of sizes a and b that link differ in at most
   ``(per - least) * (a + b) / (per + least)`` hashes.  Sizes are dealt into bands; a band cuts
   the hash range into more segments than two of its sets can differ in, so a pair that links has
   a segment without any difference.  Ids that share such a segment (band, place, content) fall
   into one cluster.  A set with so many empty segments that the untouched ones could all be
   empty also gives its ``(1 - t) n + 1`` least hashes, of which two linked sets share one.
3. Each cluster is laid out in tiles of size bands.  In a tile every set has a hashed bitmap;
   the bits in which two bitmaps differ bound the overlap from above.  Bitmaps, being small, go through the
   tiles first and split clusters that only share a passage; of what is left, texts are read again
   and pairs under the bound have their sorted arrays intersected.  Pairs that already hang together are left
   out, and a tile returns a spanning forest, never its pairs.  A large cluster is cut in blocks and
   gets a tile for each two blocks of a band, so no task holds more than two blocks.
4. Components of the tiles' forests are the answer.

Null and empty texts have empty sets and hang on nothing; fewer than ``size`` words make one
n-gram.  Ids are whole numbers.  Rows that share an id, with equal or different texts, each give a result row
and link on their own: where any id repeats, the texts are written once under row numbers, and these stand
for the ids until components are named.  Rows without an id have no component and null results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wordloom.llm.components import components
from wordloom.sources.scratch import materialize, release

# Hashes in one block of a large cluster.
BLOCK = 1 << 21
WORD_MEMO = 1 << 18
# Column of row numbers, while rows that share an id are told apart.
ROW = "__jaccard_row"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct n-gram hashes of texts; remembers the hashes of frequent words."""

    def __init__(self, size: int) -> None:
        self.size, self.memo = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        memo = self.memo
        if len(memo) > WORD_MEMO:
            memo.clear()
        for word in set(words):
            if word not in memo:
                memo[word] = xxhash.xxh3_64_intdigest(word)
        each = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        grams = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            grams = mixed(grams * np.uint64(0x9E3779B97F4A7C15) + each[i : len(words) - size + 1 + i])
        return np.unique(grams)


@dataclass(frozen=True)
class Threshold:
    """Link if ``per * intersection >= least * union``."""

    least: int = 90
    per: int = 100

    def __post_init__(self) -> None:
        if not 3 * self.per <= 4 * self.least <= 4 * self.per:
            raise ValueError("the threshold lies between 3/4 and 1")

    def differ(self, total: int) -> int:
        """Most hashes in which two linked sets differ, of ``total`` in both together."""
        return (self.per - self.least) * total // (self.per + self.least)

    def linked(self, shared: int, total: int) -> bool:
        return self.per * shared >= self.least * (total - shared)


# Sizes of the bands grow by half.
BAND_STARTS = np.unique([int(1.5**k) for k in range(1, 90)])


def bands(n: int, t: Threshold) -> list[int]:
    """The band of size ``n``, and the next one if a linked set could stand there."""
    own = int(np.searchsorted(BAND_STARTS, n, "right"))
    return [own, own + 1] if t.per * n >= t.least * int(BAND_STARTS[own]) else [own]


def block_keys(hashes: np.ndarray, t: Threshold) -> list[np.ndarray]:
    """Keys of which two linked sets always share one, as they are linked."""
    n, keys = len(hashes), []
    for band in bands(n, t):
        most = t.differ(2 * (int(BAND_STARTS[band]) - 1))
        places = np.uint64(most + 2 + most // 10)
        at = ((hashes >> np.uint64(32)) * places) >> np.uint64(32)
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        content = np.add.reduceat(mixed(hashes), begin)
        keys.append(mixed(content + mixed(at[begin] * np.uint64(1021) + np.uint64(band))))
        if int(places) - len(begin) >= int(places) - most:
            keys.append(mixed(hashes[: n - ceil(t.least * n / t.per) + 1] + np.uint64(band)))
    return keys


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each value of ``keys``, from batches that are sorted by them."""
    open_rows: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(batch)]):
            value = tuple(values[a])
            if value != last and open_rows:
                yield pd.concat(open_rows)
                open_rows = []
            open_rows.append(batch.iloc[a:b])
            last = value
    if open_rows:
        yield pd.concat(open_rows)


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A set's hashed bitmap of ``bits`` bits, a power of two from 64 on, as whole words."""
    row = np.zeros(bits // 64, np.uint64)
    at = mixed(hashes) & np.uint64(bits - 1)
    np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.intp), np.uint64(1) << (at & np.uint64(63)))
    return row


def folded(row: np.ndarray, words: int) -> np.ndarray:
    """The same set's bitmap of ``words`` words, a power of two of at most its own."""
    while len(row) > words:
        row = row[: len(row) // 2] | row[len(row) // 2 :]
    return row


def band_bits(band: int) -> int:
    """Bits of the bitmaps compared in a band: two to four for each hash of its largest set."""
    bits = 64
    while bits < 2 * int(BAND_STARTS[band]):
        bits *= 2
    return bits


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits for each set, eight or more for each hash of the largest."""
    bits = 64
    while bits < 8 * max(map(len, sets)):
        bits *= 2
    return np.stack([bitmap(s, bits) for s in sets])


def forest(
    ids: np.ndarray, sides: np.ndarray, sizes: np.ndarray, maps: np.ndarray, sets: list[np.ndarray] | None, t: Threshold
) -> list[tuple[int, int]]:
    """Links that hold a tile's components together; without ``sets``, pairs that may link by their bitmaps.

    ``sides``: 0 in a tile of one block, else 1 or 2; blocks 1 and 2 are compared with each other only.
    """
    order = np.argsort(sizes, kind="stable")
    ids, sides, sizes, maps, part = ids[order], sides[order], sizes[order], maps[order], np.arange(len(sizes))
    sets = [sets[i] for i in order] if sets is not None else None
    found = []
    for i in range(1, len(sizes)):
        n = int(sizes[i])
        low = int(np.searchsorted(sizes, -(-t.least * n // t.per)))
        if low >= i:
            continue
        apart = np.bitwise_count(maps[low:i] ^ maps[i]).sum(axis=1, dtype=np.int64)
        near = (t.per + t.least) * apart <= (t.per - t.least) * (sizes[low:i] + n)
        near &= (part[low:i] != part[i]) & ((sides[low:i] == 0) | (sides[low:i] != sides[i]))
        close = np.flatnonzero(near)
        for j in low + close[np.argsort(apart[close], kind="stable")]:
            if part[j] != part[i]:
                if sets is None or t.linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), n + int(sizes[j])):
                    found.append((int(ids[i]), int(ids[j])))
                    part[part == part[i]] = part[j]
    return found


def signatures(docs: DataFrame, size: int, t: Threshold, key: str, text: str) -> DataFrame:
    """id, n, digest (of the whole set) and bitmap (as wide as its bands need) of every row."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(size)
        for batch in batches:
            sets = [shingle(x) for x in batch["text"]]
            names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            maps = [bitmap(s, band_bits(bands(len(s), t)[-1])).view(np.int64) for s in sets]
            yield pd.DataFrame({"id": batch["id"], "n": [len(s) for s in sets], "digest": names, "map": maps})

    source = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    return source.mapInPandas(sign, "id bigint, n bigint, digest binary, map array<bigint>")


def clusters(docs: DataFrame, size: int, t: Threshold, key: str, text: str) -> DataFrame:
    """a, b: ids that share a block key, each with the least of them."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(size)
        for batch in batches:
            for rows in range(0, len(batch), 256):
                ids, found = [], []
                for row, body in zip(batch["id"].iloc[rows : rows + 256], batch["text"].iloc[rows : rows + 256]):
                    hashes = shingle(body)
                    # sets this small link with nothing but their equals
                    if t.linked(len(hashes), 2 * len(hashes) + 1):
                        for keys in block_keys(hashes, t):
                            found.append(keys)
                            ids.append(np.full(len(keys), row, np.int64))
                if found:
                    yield pd.DataFrame({"block": np.concatenate(found).view(np.int64), "id": np.concatenate(ids)})

    source = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = source.mapInPandas(keyed, "block bigint, id bigint")
    first = F.first("id").over(Window.partitionBy("block").orderBy("id"))
    return rows.select("id", first.alias("first")).where("id > first").select(F.col("id").alias("a"), F.col("first").alias("b"))


PLACE = ["cluster", "band", "one", "two"]


def tiles_of(members: DataFrame, t: Threshold, block: int, per_hash: float) -> DataFrame:
    """id, cluster, band, one, two, side: the tiles that each of ``members`` (id, cluster, n) stands in.

    A block holds some ``block`` words, of which a set has ``per_hash`` for each hash, and 8192 sets at most.
    """

    def banded(n: pd.Series) -> pd.Series:
        return n.map(lambda x: bands(int(x), t))

    spread = F.pandas_udf(banded, "array<int>")
    rows = members.select("id", "cluster", "n", F.explode(spread("n")).alias("band"))
    mass = rows.groupBy("cluster", "band").agg(F.sum("n").alias("mass"), F.count(F.lit(1)).alias("ids")).where("ids > 1")
    blocks = F.ceil(F.greatest(F.col("mass") * per_hash / block, F.col("ids") / 8192)).cast("int")
    mass = mass.select("cluster", "band", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    tile = F.transform(every, lambda x: F.struct(F.least(own, x).alias("one"), F.greatest(own, x).alias("two"), (own < x).alias("is_one")))
    laid = rows.join(mass, ["cluster", "band"]).select("id", "cluster", "band", F.explode(tile).alias("t"))
    side = F.when(F.col("t.one") == F.col("t.two"), 0).when(F.col("t.is_one"), 1).otherwise(2)
    return laid.select("id", "cluster", "band", "t.one", "t.two", side.alias("side"))


def near(members: DataFrame, t: Threshold, block: int) -> DataFrame:
    """a, b: pairs that hold together what may link by the bitmaps, within the clusters of ``members`` (id, cluster, n, map)."""

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in groups(batches, PLACE):
            words = band_bits(int(rows["band"].iloc[0])) // 64
            maps = np.stack([folded(m.view(np.uint64), words) for m in rows["map"]])
            found = forest(rows["id"].to_numpy(), rows["side"].to_numpy(), rows["n"].to_numpy(), maps, None, t)
            yield pd.DataFrame(found, columns=["a", "b"])

    laid = tiles_of(members, t, block, 1 / 16).join(members.select("id", "n", "map"), "id")
    dealt = laid.select(*PLACE, "side", "id", "n", "map").repartition(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.mapInPandas(joined, "a bigint, b bigint")


def links(docs: DataFrame, members: DataFrame, size: int, t: Threshold, key: str, text: str) -> DataFrame:
    """a, b: links that hold together what links within the clusters of ``members`` (id, cluster, n)."""
    tiles = tiles_of(members, t, BLOCK, 1.0).select("id", F.struct(*PLACE, "side").alias("tile"))
    wanted = materialize(tiles.groupBy("id").agg(F.collect_list("tile").alias("tiles")), "tiles")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(size)
        for batch in batches:
            for rows in range(0, len(batch), 64):
                part = batch.iloc[rows : rows + 64]
                out = [
                    (t["cluster"], t["band"], t["one"], t["two"], t["side"], row, hashes)
                    for row, body, tiles in zip(part["id"], part["text"], part["tiles"])
                    for hashes in [shingle(body).view(np.int64)]
                    for t in tiles
                ]
                yield pd.DataFrame(out, columns=["cluster", "band", "one", "two", "side", "id", "hashes"])

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[int, int]] = []
        for rows in groups(batches, PLACE):
            sets = [h.view(np.uint64) for h in rows["hashes"]]
            sizes = np.array([len(h) for h in sets])
            found += forest(rows["id"].to_numpy(), rows["side"].to_numpy(), sizes, bitmaps(sets), sets, t)
            if len(found) > 10_000:
                yield pd.DataFrame(found, columns=["a", "b"])
                found = []
        yield pd.DataFrame(found, columns=["a", "b"])

    # what is wanted grows with the corpus, so it is not sent to every task even where it is still small
    source = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).join(wanted.hint("merge"), "id")
    laid = source.mapInPandas(sets, "cluster bigint, band int, one int, two int, side int, id bigint, hashes array<bigint>")
    return laid.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInPandas(joined, "a bigint, b bigint")


def _row_components(docs: DataFrame, size: int, threshold: Threshold, key: str, text: str) -> DataFrame:
    """id, n, component (the least id reachable by links) of ``docs``, whose ids are whole numbers, not null and all different."""
    signed = materialize(signatures(docs, size, threshold, key, text), "signatures")
    classes = signed.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"))
    named = materialize(signed.join(classes, "digest", "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "classes")
    reps = signed.join(named.where("n > 0 AND id = rep").select("id"), "id", "left_semi").select("id", "n", "map")
    reps = materialize(reps, "representatives")
    release(signed)

    def grouped(found: DataFrame) -> DataFrame:
        """``reps`` with their clusters, of which those of one member are left out."""
        placed = reps.join(found, F.col("id") == F.col("node")).select("id", "n", "map", F.col("component").alias("cluster"))
        heads = found.select(F.col("component").alias("id")).distinct()
        return placed.unionByName(reps.join(heads, "id").withColumn("cluster", F.col("id")))

    # first by shared segments, then, within these, by bitmaps; texts are only read again for what is left
    coarse = components(clusters(docs, size, threshold, key, text).join(reps.select(F.col("id").alias("a")), "a", "left_semi"))
    fine = components(near(grouped(coarse), threshold, BLOCK))
    members = materialize(grouped(fine).select("id", "n", "cluster"), "members")
    held = components(links(docs, members, size, threshold, key, text))
    release(members)
    least = held.select(F.col("node").alias("rep"), "component")
    return named.join(least, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))


def _ids_repeat(docs: DataFrame, key: str) -> bool:
    return not docs.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()


def _numbered(docs: DataFrame, size: int, threshold: Threshold, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` written under row numbers, and ``row, id, n, component``, components being row numbers, too."""
    numbered = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    found = _row_components(numbered, size, threshold, ROW, text).select(F.col("id").alias("row"), "n", "component")
    ids = numbered.select(F.col(ROW).alias("row"), F.col(key).cast("bigint").alias("id"))
    return numbered, materialize(found.join(ids, "row"), "rows")


def jaccard_components(
    docs: DataFrame, size: int = 3, threshold: Threshold = Threshold(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_shingles, component_id (the least id reachable by links)."""
    lost, docs = docs.where(F.col(key).isNull()), docs.where(F.col(key).isNotNull())
    if _ids_repeat(docs, key):
        _, rows = _numbered(docs.select(key, text), size, threshold, key, text)
        least = rows.groupBy("component").agg(F.min("id").alias("least"))
        found = rows.join(least, "component").select("id", "n", F.col("least").alias("component"))
    else:
        found = _row_components(docs, size, threshold, key, text)
    named = found.select(
        F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
    none = F.lit(None).cast("bigint")
    return named.unionByName(lost.select(key, none.alias("n_shingles"), none.alias("component_id")))


def drop_near_duplicates(docs: DataFrame, size: int, threshold: Threshold, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the one with the least id, of several with that id any one.

    Rows without an id stay, and so does every row without words.
    """
    lost, known = docs.where(F.col(key).isNull()), docs.where(F.col(key).isNotNull())
    if not _ids_repeat(known, key):
        gone = jaccard_components(known, size, threshold, key, text).where(F.col("component_id") != F.col(key)).select(key)
        return docs.join(gone, key, "left_anti").select(docs.columns)
    numbered, rows = _numbered(known, size, threshold, key, text)
    stay = rows.groupBy("component").agg(F.min(F.struct("id", "row")).alias("least")).select(F.col("least.row").alias(ROW))
    return numbered.join(stay, ROW, "left_semi").select(docs.columns).unionByName(lost)
