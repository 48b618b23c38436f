"""Periodic runs, packing and collocations against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import collocations, packing, runs
from wordloom.llm.quotient import CountingQuotientFilter, Shape, merge, shards

SHAPE = "doc_id bigint, text string, lang string, runs string, start string, _body string, _words_of string, body string, code string"


def table(spark, rows):
    """Documents from (id, text, lang), with columns that clash with names inside the operators."""
    return spark.createDataFrame([(i, t, l, "x", "y", None, "z", "b", None) for i, t, l in rows], SHAPE)


def brute_runs(words):
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def periodic_words(rng, letters, longest):
    words = []
    while len(words) < longest:
        unit = [rng.randrange(letters) for _ in range(rng.randint(1, rng.choice([2, 9, 20, 70])))]
        unit = unit * 4 + [rng.randrange(letters)] if rng.random() < 0.3 else unit
        words += (unit * rng.randint(1, 7))[: rng.randint(1, 400)]
    return words[: rng.randint(0, longest)]


@pytest.mark.parametrize("letters", [1, 2, 3, 1000])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for longest in [20, 60, 200, 700] * 40:
        words = periodic_words(rng, letters, longest)
        assert list(map(tuple, runs.find_runs(np.array(words, np.int64)).tolist())) == brute_runs(words)


def test_synchronising_sets_are_consistent_and_dense():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 3, 500)] * 2)
    window = runs._mix(x.astype(np.uint64))
    for scale in (1, 2, 4):
        window = runs._mix(window[:-scale] * np.uint64(7) + window[scale:])
    chosen = set(runs.synchronising_set(window, 8, np.zeros(len(window), bool)).tolist())
    assert {i + 500 for i in chosen if i < 484} == {i for i in chosen if 500 <= i < 984}
    assert all(chosen & set(range(i, i + 8)) for i in range(970))


def contract_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_run_query_equals_the_contract(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{c}" for c in periodic_words(rng, 3, 300)) for _ in range(60)]
    texts += [" ".join(rng.choice(["é", "a b", "ω", "x"]) + rng.choice(" \t\n\x0b\x0c\r") for _ in range(rng.randrange(80))) for _ in range(100)]
    texts += [None, "", " \n ", "a " * 50_000, " ".join(str(rng.randrange(9)) for _ in range(30_000))]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "a a a a a a a", "en"), (3, "b " * 9, "en"), (3, "b " * 9, "en")]
    docs = table(spark, rows)
    planted = docs.select("doc_id", runs.repeat_tail(docs["doc_id"], docs["text"]).alias("text"))
    got = Counter(tuple(r) for r in runs.run_digests(runs.periodic_runs(planted)).collect())
    want = Counter()
    for i, text, _ in rows:
        words = contract_words(i, text)
        found = brute_runs(words) if len(words) < 10_000 else [tuple(r) for r in runs.find_runs(np.unique(words, return_inverse=True)[1]).tolist()]
        gone = {j for a, n, p in found for j in range(a + p, a + n)}
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in found)
        a, n, p = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        rest = " ".join(w for j, w in enumerate(words) if j not in gone)
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (lines, rest)]
        want[(i, len(found), a, n, p, None if a is None else 1000 * n // p, *digests)] += 1
    assert got == want


def test_runs_keep_clashing_columns_and_empty_tables(spark):
    docs = table(spark, [(1, "a b " * 9, "en")])
    assert runs.periodic_runs(docs, keep=("doc_id", "_words_of", "body")).first()["collapsed"] == "a b"
    assert runs.periodic_runs(docs.where("false")).count() == 0


def test_first_fit_decreasing_equals_the_plain_search():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 120))]
        room, plain = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            at = next((b for b, free in enumerate(room) if free >= sizes[i]), len(room))
            if at == len(room):
                room.append(100)
                plain.append([])
            room[at] -= sizes[i]
            plain[at].append(i)
        assert packing.first_fit_decreasing(sizes, 100) == plain


def test_packed_items_are_whole_and_sequences_full():
    rng = random.Random(4)
    for _ in range(100):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        packed = packing.pack(sizes, 64)
        cover = defaultdict(list)
        for sequence in packed:
            used = sum(n for _, _, n in sequence)
            assert used == 64 or used & (used - 1) == 0
            for item, start, n in sequence:
                cover[item].append((start, start + n))
        assert sum(n for s in packed for _, _, n in s) == sum(sizes)
        for item, parts in cover.items():
            edges = [0, *(e for part in sorted(parts) for e in part), sizes[item]]
            assert edges[::2] == edges[1::2]


public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "it's we'll 'S x'y don't.", "<|endoftext|>x <|startoftext|> <|ENDOFTEXT|>.", "é é H̱ ẖ İx ΣΑΣ ǅ ﬁ", "a\x1cb\x85c d　e", "1a2 3.14,$$$",
    "x̣́ ́y", "漢字かな \U0001f600\U0001f468‍\U0001f469", "Wörter,!? (klammer) --strich-- ñandú***", "a" * 5000, "É" * 300 + ".",
]


def test_words_are_encoded_like_whole_texts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(MODEL)
    with open(MODEL, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    rng = random.Random(6)
    letters = "abcxyzABCéÉßñÀŸſıİ'.,$-_012 \t\n ́ǅΣ字<|>"
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    assert encoder.known_rules
    for text in texts:
        got = np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids, text


def test_memory_of_words_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 20)
    with open(MODEL, encoding="utf-8") as file:
        small = packing.WordEncoder(file.read())
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(30)).encode() for _ in range(50)]
    first = [small.encode(t) for t in texts]
    assert first == [small.encode(t) for t in texts]


def test_documents_are_packed_without_gaps(spark):
    from tokenizers import Tokenizer

    rng = random.Random(12)
    texts = [" ".join(rng.choice(["the", "Ofinnd", "été,", "x1"]) for _ in range(rng.choice([0, 3, 40, 900, 5000]))) for _ in range(150)]
    texts += [None, "", *HARD]
    docs = table(spark, [*((i, t, None) for i, t in enumerate(texts)), (None, "no id", None), (1000, "twice", None), (1000, "twice", None)])
    pieces = packing.pack_documents(docs, MODEL, keep=("doc_id", "body"), group=40).collect()
    plain = Tokenizer.from_file(MODEL)
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0 and p["body"] == "b"
        parts[p["doc_id"]].append((p["start"], np.frombuffer(p["ids"], "<u4").tolist(), p["doc_tokens"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, text in [*enumerate(texts), (None, "no id")]:
        ids = [n for _, part, _ in sorted(parts[i]) for n in part]
        assert ids == plain.encode(text or "", add_special_tokens=False).ids + [1]
        assert {t for _, _, t in parts[i]} == {len(ids)}
        at = 0
        for start, part, _ in sorted(parts[i]):
            assert start == at
            at += len(part)
    assert sum(len(p) for _, p, _ in parts[1000]) == 2 * (len(plain.encode("twice").ids) + 1)
    short = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)
        short += at < 2048
    assert short <= 11 * (len(texts) // 40 + 8)
    assert packing.pack_documents(docs.where("false"), MODEL).count() == 0


@pytest.mark.parametrize(("words", "bits"), [(2, 1), (2, 17), (3, 20), (4, 17), (5, 17), (5, 25), (5, 64)])
def test_counting_filters_lose_nothing(words, bits):
    rng, shape = np.random.default_rng(words * bits), Shape(words, bits)
    alphabet = rng.integers(0, min(2**bits, 2**63) - 1, 6, endpoint=True).astype(np.uint64)
    want, by_shard = Counter(), defaultdict(list)
    for n in (0, 1, 700, 700):
        codes = alphabet[rng.integers(0, 6, (n, words))]
        want.update(map(tuple, codes.tolist()))
        for f in shards(shape, codes, min(3, shape.width)):
            by_shard[f.shard].append(CountingQuotientFilter.from_bytes(f.to_bytes(), shape, f.shard, f.shard_bits))
    got = Counter()
    for filters in by_shard.values():
        one = merge(filters)
        assert (np.diff(one.keys()[:, 0].astype(object)) >= 0).all()
        for codes, n in zip(shape.unpack(shape.restore(one.keys())).tolist(), one.counts.tolist()):
            assert one.count(tuple(codes)) == n
            got[tuple(codes)] += n
    assert got == want


def brute_collocations(rows, least, longest, top):
    pieces = defaultdict(list)
    for _, text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        pieces[lang or "und"] += [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]
    out = set()
    for lang, parts in pieces.items():
        n = sum(map(len, parts))
        f = Counter(tuple(p[i : i + k]) for p in parts for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        often = {x: c for x, c in f.items() if c >= least and len(x) > 1}
        kept = []
        for x, a in often.items():
            inside = (y for y, b in often.items() if len(y) > len(x) and b >= a)
            if any(y[i : i + len(x)] == x for y in inside for i in range(len(y) - len(x) + 1)):
                continue
            score, k = min((1000 * a * n // (f[x[:k]] * f[x[k:]]), k) for k in range(1, len(x)))
            kept.append((-score, -a, " ".join(x).encode(), f[x[:k]], f[x[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


@pytest.mark.parametrize("table_words", [1_000_000, 3])
def test_collocations_equal_brute_force(spark, table_words, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH", 500)
    monkeypatch.setattr(collocations, "STRETCH", 700)
    monkeypatch.setattr(collocations, "MERGE", 50)
    rng = random.Random(17)
    words = ["New", "york", "ÉTÉ", "état", "the", "of", "a b", "x", "zz"] + [f"rare{i}" for i in range(200)]
    fixed = ["New York City hall", "of the", "zz zz zz zz zz zz", "été Été x"]
    rows = []
    for i in range(160):
        text = "".join(
            (rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words[:9] if rng.random() < 0.8 else words)) + rng.choice([" ", " ", "\t ", ". ", ",", "\r\n", "\x0b"])
            for _ in range(rng.randrange(60))
        )
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    rows += [(None, None, "en"), (1, "", None), (2, "only, one", "fr"), (3, "york york", "en"), (3, "york york", "en")]
    got = collocations.collocations(table(spark, rows), min_count=6, top=25, table_words=table_words).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, 6, 5, 25) and len(got) > 25


def test_collocations_of_empty_tables(spark):
    docs = table(spark, [(1, "a b", "en")])
    assert collocations.collocations(docs.where("false")).count() == 0
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs, table_words=-1).count() == 0


def test_scores_pass_64_bits(spark):
    wide = spark.range(1).select(*(F.lit(10**13).cast("decimal(18,0)").alias(c) for c in "anlr"))
    assert wide.select(F.call_function("div", F.col("a") * F.col("n") * F.lit(1000).cast("decimal(4,0)"), F.col("l") * F.col("r"))).first()[0] == 1000
