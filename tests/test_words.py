from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.errors import DocumentNotInCollection, WordNotInVocabulary
from wordloom.operators import cooccurrence as cooc
from wordloom.operators import contexts, corpus, encoding, joins, ordering, phrases, termdoc, vocabulary
from wordloom.sources.scratch import materialize


def sentences_of(sents):
    return {(r["doc_id"], r["line_no"], r["sent_no"]): list(r["toks"]) for r in sents.collect()}


def test_vocabulary_golden(micro_sents, micro_vocab):
    counts = dict(rows_of(vocabulary.token_counts(micro_sents)))
    assert counts["cats"] == 3 and counts["nt"] == 1 and len(counts) == 9
    assert [(t, i) for t, i, _ in sorted(rows_of(micro_vocab), key=lambda r: r[1])] == [
        ("cats", 0), ("chase", 1), ("cheese", 2), ("dogs", 3), ("like", 4), ("mice", 5),
    ]
    left_out = vocabulary.out_of_vocabulary(vocabulary.token_counts(micro_sents), micro_vocab)
    assert [t for t, _ in rows_of(left_out)] == ["ca", "fly", "nt"]


def test_offsets_are_dense_per_group_and_weighted(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("w")
    )
    rows = sorted(rows_of(df))
    for group in (None, "g"):
        seen: dict = {}
        want = []
        for k, g, w in rows:
            at = seen.get(g if group else 0, 0)
            want.append((k, at))
            seen[g if group else 0] = at + w
        got = ordering.with_offsets(df, [F.col("k")], "at", weight="w", group=group)
        assert rows_of(got, "k", "at") == sorted(want)
    dense = ordering.dense_index(df, [F.col("k")], "i")
    assert [i for _, i in rows_of(dense, "k", "i")] == list(range(1000))


def test_skew_safe_join_head_and_tail(spark):
    fact = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"w{i}", i) for i in range(100)], "k string, v int")
    dim = fact.groupBy("k").agg(F.count("*").alias("n"))
    want = rows_of(fact.join(dim, "k"), "k", "v", "n")
    for limit in (1, 2, 7, 1000):
        assert rows_of(joins.skew_safe_join(fact, dim, "k", "n", limit), "k", "v", "n") == want


@pytest.mark.parametrize("limit", [10**6, 3])
def test_encoding_keeps_positions(micro_sents, micro_vocab, random_sents, limit):
    ids = dict((t, i) for t, i, _ in rows_of(micro_vocab))
    for r in encoding.encode_sentences(micro_sents, micro_vocab, limit=limit).collect():
        assert r["ids"] == [ids.get(t) for t in r["toks"]]
    vocab = vocabulary.vocabulary(vocabulary.token_counts(random_sents), 110)
    ids = dict((t, i) for t, i, _ in rows_of(vocab))
    got = encoding.encode_sentences(random_sents, vocab, limit=limit).collect()
    assert len(got) == 200 and 3 < len(ids) < 8
    assert all(r["ids"] == [ids.get(t) for t in r["toks"]] for r in got)


def test_term_document_golden(micro, micro_sents, micro_vocab):
    index = corpus.document_index(micro)
    td = materialize(termdoc.term_document_counts(micro_sents, micro_vocab, index), "td")
    want = {(0, 0): 2, (0, 1): 1, (3, 1): 2, **{(i, d): 1 for i in (1, 2, 4, 5) for d in (0, 1)}}
    assert {(i, d): v for i, d, v in rows_of(td)} == want
    weighted = {(i, d): round(v, 5) for i, d, v in rows_of(termdoc.tf_idf(td, 2))}
    assert weighted[(0, 0)] == 1.30103 and weighted[(0, 1)] == 1.0 and weighted[(3, 1)] == 2.60206
    assert rows_of(termdoc.word_vector(td, micro_vocab, index, "dogs")) == [(0, 0.0), (1, 2.0)]
    assert dict(rows_of(termdoc.document_vector(td, micro_vocab, index, "a")))[3] == 0.0
    assert rows_of(termdoc.item_vector(td, micro_vocab, index, "b"))[0][0] == "document"
    with pytest.raises(WordNotInVocabulary):
        termdoc.word_vector(td, micro_vocab, index, "fly")
    with pytest.raises(DocumentNotInCollection):
        termdoc.item_vector(td, micro_vocab, index, "zzz")


def brute_cooc(sents, vocab, window):
    cells: Counter = Counter()
    for toks in sents.values():
        for i, a in enumerate(toks):
            for j in range(max(0, i - window), min(len(toks), i + window + 1)):
                if i != j and a in vocab and toks[j] in vocab:
                    cells[vocab[a], vocab[toks[j]]] += 1
    return cells


@pytest.mark.parametrize("limit", [10**6, 3])
def test_cooccurrence(micro_sents, micro_vocab, random_sents, limit):
    ids = dict((t, i) for t, i, _ in rows_of(micro_vocab))
    got = {(a, b): v for a, b, v in rows_of(cooc.cooccurrence(micro_sents, micro_vocab, 1, limit))}
    assert sum(got.values()) == 16 and got[ids["cats"], ids["chase"]] == 2 and len(got) == 12
    vocab = vocabulary.vocabulary(vocabulary.token_counts(random_sents), 110)
    ids = dict((t, i) for t, i, _ in rows_of(vocab))
    for window in (1, 3, 20):
        got = {(a, b): v for a, b, v in rows_of(cooc.cooccurrence(random_sents, vocab, window, limit))}
        assert got == brute_cooc(sentences_of(random_sents), ids, window)
        assert all(got[b, a] == v for (a, b), v in got.items())


def test_ppmi_golden(micro_sents, micro_vocab):
    cells = materialize(cooc.cooccurrence(micro_sents, micro_vocab, 1), "cells")
    cats, chase, cheese, dogs, like, mice = range(6)
    want = {
        1.0: {(cats, chase): 1.415037, (chase, cats): 1.415037, (cats, like): 0.415037, (like, cats): 0.415037,
              (chase, dogs): 2.0, (dogs, chase): 2.0, (chase, mice): 1.0, (mice, chase): 1.0,
              (cheese, like): 2.0, (like, cheese): 2.0, (like, mice): 1.0, (mice, like): 1.0},
        0.75: {(cats, chase): 1.535618, (chase, cats): 1.431858, (cats, like): 0.535618, (like, cats): 0.431858,
               (chase, dogs): 1.62058, (dogs, chase): 2.12058, (chase, mice): 0.87058, (mice, chase): 1.12058,
               (cheese, like): 2.12058, (like, cheese): 1.87058, (like, mice): 0.87058, (mice, like): 1.12058},
    }
    for alpha, expected in want.items():
        got = {(a, b): round(v, 6) for a, b, v in rows_of(cooc.ppmi(cells, alpha))}
        assert got == expected
    assert cooc.ppmi(cells.where("false")).count() == 0


def test_windows_differ(spark):
    sents = spark.createDataFrame(
        [("d", 0, 0, "dogs fly chase nt cats".split())], "doc_id string, line_no int, sent_no int, toks array<string>"
    )
    vocab = spark.createDataFrame([("dogs", 0, 1), ("chase", 1, 1), ("cats", 2, 1)], "tok string, id int, n bigint")
    pairs = contexts.target_context_pairs(encoding.encode_sentences(sents, vocab), 1, 1)
    assert rows_of(pairs, "pos", "target", "ctx") == [
        (0, "dogs", ["chase"]), (2, "chase", ["dogs", "cats"]), (4, "cats", ["chase"]),
    ]
    assert cooc.cooccurrence(sents, vocab, 1).count() == 0


def test_context_pairs_brute_force(random_sents):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(random_sents), 110)
    ids = dict((t, i) for t, i, _ in rows_of(vocab))
    encoded = encoding.encode_sentences(random_sents, vocab)
    for before, after in ((2, 2), (3, 1), (4, 0)):
        want = []
        for key, toks in sentences_of(random_sents).items():
            known = [(p, t) for p, t in enumerate(toks) if t in ids]
            for i, (p, t) in enumerate(known):
                ctx = [w for _, w in known[max(0, i - before) : i] + known[i + 1 : i + 1 + after]]
                want.append((*key, p, t, ctx))
        assert rows_of(contexts.target_context_pairs(encoded, before, after)) == sorted(want)


def brute_phrases(sents, min_count, threshold):
    uni, bi = Counter(), Counter()
    for toks in sents:
        uni.update(toks)
        bi.update(zip(toks, toks[1:]))
    kinds = len(uni) + len(bi)
    return {p for p, n in bi.items() if (n - min_count) * kinds / uni[p[0]] / uni[p[1]] > threshold}


def brute_merge(toks, found):
    out, i = [], 0
    while i < len(toks):
        if i + 1 < len(toks) and (toks[i], toks[i + 1]) in found:
            out.append(f"{toks[i]}_{toks[i + 1]}")
            i += 2
        else:
            out.append(toks[i])
            i += 1
    return out


@pytest.mark.parametrize("limit", [10**6, 2])
def test_phrases_brute_force(random_sents, limit):
    sents = sentences_of(random_sents)
    current = random_sents
    for _ in range(2):
        found = phrases.phrase_scores(current, 2, 0.045)
        found = materialize(found, "phrases")
        want = brute_phrases(sents.values(), 2, 0.045)
        assert {(a, b) for a, b, _ in rows_of(found)} == want and len(want) > 3
        current = materialize(phrases.apply_phrases(current, found, limit=limit), "phrased")
        sents = {k: brute_merge(t, want) for k, t in sents.items()}
        assert sentences_of(current) == sents


def test_greedy_merge_does_not_overlap(spark):
    sents = spark.createDataFrame([(1, 0, 0, ["b", "b", "b"])], "doc_id int, line_no int, sent_no int, toks array<string>")
    found = spark.createDataFrame([("b", "b", 9.0)], "a string, b string, score double")
    for limit in (10, 0):
        assert phrases.apply_phrases(sents, found, limit=limit).first()["toks"] == ["b_b", "b"]


def test_minibatches_drop_the_rest_and_keep_the_last_file(spark):
    examples = spark.range(130).select(F.col("id").alias("ex_id"))
    got = contexts.minibatches(examples, 64, 2)
    assert got.count() == 128 and rows_of(got.select("mb_id").distinct()) == [(0,), (1,)]
    five = contexts.minibatches(spark.range(5 * 64).select(F.col("id").alias("ex_id")), 64, 2)
    assert rows_of(five.groupBy("file_ix").agg(F.countDistinct("mb_id"))) == [(0, 2), (1, 2), (2, 1)]
    mixed = contexts.shuffle_in_batch(five, 3)
    assert rows_of(mixed) == rows_of(contexts.shuffle_in_batch(five.repartition(5), 3))
    slots = [s for _, _, _, s in rows_of(mixed.where("mb_id = 0"))]
    assert sorted(slots) == list(range(64)) and slots != list(range(64))


def test_examples_are_numbered_in_corpus_order(random_sents):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(random_sents), 110)
    ids = dict((t, i) for t, i, _ in rows_of(vocab))
    want = []
    for _, toks in sorted(sentences_of(random_sents).items()):
        known = [ids[t] for t in toks if t in ids]
        for i in range(2, len(known)):
            x = [s * len(ids) + w for s, w in enumerate(known[i - 2 : i])]
            want.append((len(want), x, known[i]))
    for parts in (1, 5):
        encoded = encoding.encode_sentences(random_sents.repartition(parts), vocab)
        got = contexts.lm_examples(encoded, len(ids), 2)
        assert rows_of(got, "ex_id", "x_idx", "y") == want
    dense = contexts.one_hot_vectors(got, len(ids), 2).orderBy("ex_id").first()["x"].toArray()
    assert dense.sum() == 2 and list(dense.nonzero()[0]) == want[0][1] and len(dense) == 2 * len(ids)


def test_windows_are_cut_by_plain_expressions(spark, random_sents):
    """Windows came from functions over arrays, which are interpreted, and sentences were encoded twice to number their examples."""
    vocab = materialize(vocabulary.vocabulary(vocabulary.token_counts(random_sents), 110), "vocab")
    encoded = encoding.encode_sentences(random_sents, vocab)
    pairs = contexts.target_context_pairs(encoded, 2, 2)
    examples = contexts.lm_examples(encoded, vocab.count(), 2)
    plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in (pairs, examples)]
    assert "transform(" not in plans[0] and plans[0].count("lambdafunction(") <= 2
    assert "transform(" not in plans[1] and "lambdafunction(" not in plans[1] and "ids_of" not in plans[1]
    odd = "doc_id string, line_no int, sent_no int, toks array<string>, ids array<int>"
    rows = [("a", 0, 0, ["x", "y", "z"], [None, None, None]), ("a", 0, 1, [], []), (None, 0, 2, ["x", "y", "x"], [4, None, 4])]
    got = contexts.target_context_pairs(spark.createDataFrame(rows, odd), 1, 1)
    assert sorted(got.select("pos", "target", "ctx").collect()) == [(0, "x", ["x"]), (2, "x", ["x"])]


def test_only_phrases_are_joined(monkeypatch):
    """Every word was joined with the next, also where no phrase opens."""
    toks = pa.array([["a", "b", "c"], [], ["b", "b", "b", "b", "b"], ["a"]], pa.list_(pa.string()))
    flags = np.array([1, 0, 0, 1, 1, 1, 1, 0, 0], bool)
    join, sizes = phrases.pc.binary_join_element_wise, []
    monkeypatch.setattr(phrases.pc, "binary_join_element_wise", lambda a, *rest: sizes.append(len(a)) or join(a, *rest))
    assert phrases._merged(toks, flags).to_pylist() == [["a_b", "c"], [], ["b_b", "b_b", "b"], ["a"]]
    assert phrases._merged(toks, ~(flags | True)).to_pylist() == toks.to_pylist()
    assert sizes == [3, 0]


def test_cooccurrence_shuffles_lists_at_the_rarer_word(spark, random_sents, monkeypatch):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(random_sents), 2)
    ids = {r["tok"]: r["id"] for r in vocab.collect()}
    want = brute_cooc(sentences_of(random_sents), ids, 3)
    for bounds in ((1 << 20, 256, 1 << 20), (50, 2, 3)):
        for name, bound in zip(("PAIRS_PER_COUNT", "COUNTS_PER_LIST", "COUNTS_PER_MERGE"), bounds):
            monkeypatch.setattr(cooc, name, bound)
        found = cooc.cooccurrence(random_sents, vocab, 3)
        got = [((r["row"], r["col"]), r["value"]) for r in found.collect()]
        assert dict(got) == want and len(got) == len(want)
    # cells are summed in arrays; Spark gets a row per list, not per pair
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    empty = random_sents.where("size(toks) < 0")
    assert cooc.cooccurrence(empty, vocab, 3).count() == 0


def test_ppmi_counts_its_marginals_once(spark):
    cells = spark.createDataFrame([(0, 0, 4.0), (0, 1, 2.0), (1, 0, 2.0), (1, 2, 1.0), (2, 1, 1.0)], "row int, col int, value double")
    found = cooc.ppmi(cells, 0.75)
    dense = np.array([[4.0, 2, 0], [2, 0, 1], [0, 1, 0]])
    share = dense.sum(axis=0) ** 0.75 / (dense.sum(axis=0) ** 0.75).sum()
    with np.errstate(divide="ignore"):
        want = np.log2(dense / dense.sum() / (dense.sum(axis=1)[:, None] / dense.sum() * share[None, :]))
    got = {(r["row"], r["col"]): r["value"] for r in found.collect()}
    assert set(got) == set(zip(*np.nonzero(want > 0))) and all(abs(want[at] - v) < 1e-12 for at, v in got.items())
    # read from written tables, not summed again for each use
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
