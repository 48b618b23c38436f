"""Jaccard join, piece encoding, personal data and the classifiers on small tables."""

import hashlib
import random
import time
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from wordloom.llm import components, jaccard, pieces, pii, quality_model, samples, toxicity

SHAPE = "doc_id bigint, text string, lang string, source string, label string, n bigint"


def table(spark, texts):
    rows = [(i, t, None, None, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id at all", None, None, None, None)], SHAPE)


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def brute_components(texts, size, least, per):
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(sets)))
    for a, b in combinations(range(len(sets)), 2):
        if sets[a] and per * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return [len(s) for s in sets], root


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("size, least", [(3, 90), (5, 80), (1, 80)])
@pytest.mark.parametrize("block", [jaccard.BLOCK, 500])
def test_jaccard_equals_brute_force(spark, monkeypatch, size, least, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(size + least)
    texts = ["", None, "one", "ONE", "one two", " \n", "one two three four five six seven eight nine ten"]
    for length in (6, 9, 10, 13, 40, 120, 800):
        start = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        texts += [" ".join(edited(rng, start, k)) for k in (0, 0, 0, 1, 1, 1, 2, 3, 5, 8)]
        texts += [" ".join(start[: -k or None]) for k in (1, 2, 4)]
    rng.shuffle(texts)
    sizes, root = brute_components(texts, size, least, 100)
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(table(spark, texts), size, jaccard.Threshold(least, 100)).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == root
    assert got[None]["component_id"] is None


@pytest.mark.parametrize("least", [75, 80, 90, 100])
def test_blocking_never_loses_a_link(least):
    rng, t = np.random.default_rng(least), jaccard.Threshold(least, 100)
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        both = rng.integers(0, 2**64, n, dtype=np.uint64)
        most = t.differ(2 * n + 2)
        one = np.unique(np.r_[both, rng.integers(0, 2**64, int(rng.integers(0, most // 2 + 1)), dtype=np.uint64)])
        two = np.unique(np.r_[both, rng.integers(0, 2**64, int(rng.integers(0, most // 2 + 2)), dtype=np.uint64)])
        if t.linked(len(np.intersect1d(one, two)), len(one) + len(two)) and not np.array_equal(one, two):
            assert set(np.concatenate(jaccard.block_keys(one, t))) & set(np.concatenate(jaccard.block_keys(two, t)))


def test_jaccard_of_empty_and_repeated_rows(spark):
    assert jaccard.jaccard_components(table(spark, []).where("false")).count() == 0
    docs = spark.createDataFrame([(2, "a b c d"), (2, "a b c d"), (5, "a b c d")], "doc_id bigint, text string")
    assert [r["component_id"] for r in jaccard.jaccard_components(docs).collect()] == [2, 2, 2]
    assert [r["doc_id"] for r in jaccard.drop_near_duplicates(docs, 3, jaccard.Threshold()).collect()] == [2]
    with pytest.raises(ValueError):
        jaccard.Threshold(50, 100)


def test_jaccard_tells_rows_of_one_id_apart(spark):
    """Every row links by its own text; brute force on row numbers, named by the least id of the component."""
    rng = random.Random(11)
    starts = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (60, 60, 200, 8)]
    texts = [" ".join(edited(rng, start, k)) for start in starts for k in (0, 0, 1, 1, 2, 40)] + ["", None, "", "one"]
    ids = [rng.randrange(6) for _ in texts]
    rows = [(i, n, text) for n, (i, text) in enumerate(zip(ids, texts))] + [(None, 99, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id int, place int, text string").selectExpr("*", "'clash' AS row")
    sizes, root = brute_components(texts, 3, 90, 100)
    least = {r: min(i for i, other in zip(ids, root) if other == r) for r in root}
    want = sorted([(i, n, least[r]) for i, n, r in zip(ids, sizes, root)])
    got = [tuple(r) for r in jaccard.jaccard_components(docs).collect()]
    assert sorted(r for r in got if r[0] is not None) == want and (None, None, None) in got
    left = jaccard.drop_near_duplicates(docs, 3, jaccard.Threshold())
    assert left.columns == docs.columns
    stay = [r["place"] for r in left.collect()]
    assert sorted(root[n] for n in stay if n != 99) == sorted(set(root)) and 99 in stay
    assert all(ids[n] == least[root[n]] for n in stay if n != 99)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 30)] + [(50, 29)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {**dict.fromkeys(range(101, 161), 100), **dict.fromkeys([*range(2, 30), 50], 1)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.load_pieces()


TRICKY = ["", " ", "a", "  two  spaces ", "tab\tand\nline\r\n", "▁ mark▁", "é ü 漢字 🎈 \u0000 x", "x" * 5000, "ab" * 400 + " the end", "￾"]


def best_score(text, model):
    best = [0.0] + [-1e18] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + model.longest) + 1):
            if text[i:j] in model.scores:
                best[j] = max(best[j], best[i] + model.scores[text[i:j]][1])
        if text[i] not in model.scores:
            best[i + 1] = max(best[i + 1], best[i] + model.unknown * len(text[i].encode()))
    return best[-1]


def test_pieces_round_trip_and_are_best(model):
    by_id = {i: s for i, s in model.scores.values()}
    rng = random.Random(3)
    texts = TRICKY + ["".join(rng.choice("abcdehilnoprst  .,") for _ in range(rng.randrange(80))) for _ in range(200)]
    for text in texts:
        ids = pieces.encode(text, model).tolist()
        assert pieces.decode(ids, model) == text
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        if text and pieces.MARK not in text and len(text) < 1000:
            assert sum(by_id.get(i, model.unknown) for i in ids) == pytest.approx(best_score(marked, model))


def window_sizes(text, model, block):
    search, sizes, ids = pieces.Search(model), [], []
    for at in range(0, len(text), block):
        ids += search.feed(text[at : at + block])
        sizes.append(search.held())
    return ids + search.end(), sizes


@pytest.mark.parametrize("block", [1, 7, 5000])
def test_streaming_gives_out_final_ids_with_a_small_window(model, block):
    text = pieces.MARK + "theinandofto" * 3000
    ids, sizes = window_sizes(text, model, block)
    assert max(sizes) <= 2 * pieces.WINDOW + model.longest + 1
    assert ids == [i for p in pieces.stream([text], model) for i in p] and len(ids) > 5000
    assert len(list(pieces.stream(iter(text), model))) > 300


@pytest.mark.parametrize("letter", ["=", " ", "a", "_", "=+", "x"])
def test_runs_of_one_character_take_linear_time_and_are_best(model, letter):
    by_id = {i: s for i, s in model.scores.values()}
    for n in (1, 15, 16, 17, 200, 333):
        text = letter * n + "z"
        marked = (pieces.MARK + text).replace(" ", pieces.MARK)
        ids = pieces.encode(text, model).tolist()
        assert sum(by_id.get(i, model.unknown) for i in ids) == pytest.approx(best_score(marked, model))
        assert window_sizes(marked, model, 3)[0] == [i for p in pieces.stream([marked], model) for i in p]
    spent = []
    for n in (20_000, 100_000):
        start = time.process_time()
        assert pieces.decode(pieces.encode(letter * n, model).tolist(), model) == letter * n
        spent.append(time.process_time() - start)
    assert spent[1] < 12 * spent[0] + 0.5


def test_stretches_are_cut_where_no_piece_goes_on(model):
    rng, by_id = random.Random(8), {i: s for i, s in model.scores.values()}
    for _ in range(300):
        text = pieces.MARK + "".join(rng.choice("aeinst.,é;字$") for _ in range(rng.randrange(1, 60)))
        parts = np.frombuffer(pieces._search_stretch(text, model), np.int32).tolist()
        assert pieces.decode(parts, model) == text[1:]
        assert sum(by_id.get(i, model.unknown) for i in parts) == pytest.approx(best_score(text, model))


def test_memory_of_stretches_forgets_and_stays_right(model, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(30)) for _ in range(40)]
    want = [pieces.encode(t, model).tolist() for t in texts]
    monkeypatch.setattr(pieces, "MEMO", 20)
    small = pieces.load_pieces()
    assert [pieces.encode(t, small).tolist() for t in texts * 2] == want * 2


def test_pieces_keep_clashing_columns(spark, model):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (1, None, "x", "y"), (None, "a b", "x", "y"), (1, "a b", "x", "y")], "doc_id bigint, text string, body string, kept string")
    found = pieces.encode_column(docs, model, keep=("doc_id", "body", "kept"))
    rows = [(r["doc_id"], r["body"], r["kept"], r["n_tokens"], r["round_trip"]) for r in found.collect()]
    assert sorted(rows, key=str) == sorted([(1, "x", "y", 2, True)] * 2 + [(1, "x", "y", 0, True), (None, "x", "y", 2, True)], key=str)
    back = pieces.decode_column(found, model, keep=("body", "kept"))
    assert sorted(str(r["text"]) for r in back.collect()) == ["None", "a b", "a b", "a b"]


def test_encode_and_decode_columns(spark, model):
    docs = table(spark, [*TRICKY, None])
    coded = pieces.encode_column(docs, model)
    rows = {r["doc_id"]: r for r in coded.collect()}
    assert all(r["round_trip"] for r in rows.values()) and rows[len(TRICKY)]["ids"] is None and rows[0]["ids"] == []
    back = {r["doc_id"]: r["text"] for r in pieces.decode_column(coded, model).collect()}
    assert [back[i] for i in range(len(TRICKY) + 1)] == [*TRICKY, None]
    assert pieces.encode_column(docs.where("false"), model).count() == 0


CONTRACT = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 12 <= len(d) <= 19 and sum(sum(divmod((1 + k % 2) * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15),
]


def contract_spans(text):
    found = []
    for place, (kind, pattern, ok) in enumerate(CONTRACT):
        for m in re.finditer(pattern, text):
            if ok(m.group(), re.sub("[^0-9]", "", m.group())):
                found.append((m.start(), place, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_base_spans_equal_the_contract():
    rng = random.Random(5)
    fixed = ["4111 1111-1111 1111", "a@b.c@d.e", "x@y x.y@z.w.", "1.2.3.4.5.6.7.8", "999.1.1.1", "0001.2.3.4", "+1 (555) 000-1111.", "+1", "😀 a@b.co +49 30 1234567"]
    texts = fixed + ["".join(rng.choice("0123456789.-+ @ab()") for _ in range(rng.randrange(60))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text)[0] == contract_spans(text), text


def personal(rng):
    return f'call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} or a.{rng.randrange(99)}@mail.example.com'


def test_long_secrets_are_proposed_whole():
    secret = "a1B2c3D4_-" * 400
    for text, at in ((f"token = {secret} end", 8), (f"see {secret} end", 4), (f"password: {secret}.{secret}", 10)):
        end = len(text) - (4 if text.endswith(" end") else 0)
        assert ("secret", at, end) in pii.candidates(text, [], [])
    assert pii.redact(f"token = {secret}", [("secret", 8, 8 + len(secret))]) == "token = [secret]"


def test_personal_data_adds_named_secrets(spark):
    rng = random.Random(9)
    texts = []
    for i in range(240):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        texts.append(f'Some words in {rng.randrange(1900, 2030)}. token = "{key}" and more {rng.randrange(10**15, 10**16)}. {personal(rng)}')
    texts += [None, "", "plain words " * 2000, "9" * 200_000, "a." * 60_000 + "@"]
    rows = {r["doc_id"]: r for r in pii.personal_data(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        base = contract_spans(text or "") if len(text or "") < 10_000 else []
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = rows[i]
        assert row["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(x == k for x, _, _ in base) for k in pii.KINDS]
        assert set(filter(None, shown.split(","))) <= set(row["spans"].split(","))
    caught = sum("secret:" in rows[i]["spans"] for i in range(240))
    assert caught > 230 and rows[242]["spans"] == ""


def test_personal_data_without_examples(spark):
    assert [r["spans"] for r in pii.personal_data(table(spark, ["no data here"])).collect()] == ["", ""]
    assert pii.personal_data(table(spark, []).where("false")).count() == 0
    assert pii.redact("to a@b.co now", [("email", 3, 9)]) == "to [email] now"


def test_boosted_trees_separate_what_one_line_cannot():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (2000, 3))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    held = np.arange(2000) % 4 == 0
    found = pii.fit(x, y, held, precision=0.95)
    p = found.probability(x[held])
    assert ((p > 0.5) == (y[held] == 1)).mean() > 0.95 and 0.5 <= found.threshold <= 1
    again = pii.Trees.from_json(found.to_json())
    assert np.array_equal(again.probability(x), found.probability(x))


def labelled(spark, n=400):
    rng = random.Random(2)
    words = ["river", "stone", "the", "and", "walks", "over", "green", "hill", "of", "small"]
    rude = ["scumbag", "scummer", "idiotic"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(30, 80))]
        toxic, good = int(i % 5 == 0), int(i % 4 != 1)
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(rude)
        text = " ".join(text)
        rows.append((i, text if good else re.sub(" ", "*** ", text), "en" if i % 2 else "de", "s"))
        labels.append((i, good, toxic))
    docs = spark.createDataFrame([*rows, (n, None, None, None), (n + 1, "", "en", "s"), (None, "x", None, None)], "doc_id bigint, text string, lang string, source string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")


def test_quality_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    rows = {r["doc_id"]: r for r in quality_model.score(docs, quality_model.train(docs, labels)).collect()}
    assert len(rows) == 403 and all(0 <= r["score"] <= 1 for r in rows.values())
    held = [r for r in rows.values() if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 50 and np.mean([r["predicted"] == int(r["doc_id"] % 4 != 1) for r in held]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())


def test_quality_training_never_sees_held_out_labels(spark):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert np.array_equal(quality_model.train(docs, labels), quality_model.train(docs, flipped))


def test_classifiers_without_labels(spark):
    docs, labels = labelled(spark, 20)
    none = labels.where("false")
    assert {r["score"] for r in quality_model.score(docs, quality_model.train(docs, none)).collect()} == {0.5}
    assert not any(r["toxic"] for r in toxicity.classify(docs, none).collect())
    assert toxicity.classify(docs.where("false"), labels).count() == 0


def test_sample_of_labels_is_bounded_and_stable(spark):
    docs, labels = labelled(spark)
    found = samples.labelled_sample(docs, labels, ["toxic"], rows=100).select("doc_id").toPandas()
    assert 60 < len(found) < 140
    assert set(found["doc_id"]) == set(samples.labelled_sample(docs, labels.repartition(3), ["toxic"], rows=100).toPandas()["doc_id"])


def test_toxicity_chain_finds_words_by_their_beginning(spark):
    docs, labels = labelled(spark)
    new = spark.createDataFrame([(1000, "the small river scumbags hill", "en", "s"), (1001, "the small river", "en", "s")], docs.schema)
    marked, categories = toxicity.language_categories(docs, labels)
    assert categories == ["toxic_0", "toxic_1", "toxic"]
    chain = toxicity.train(docs, marked, categories)
    rows = {r["doc_id"]: r for r in toxicity.score(docs.union(new), chain).collect()}
    right = [rows[i]["toxic"] == (i % 5 == 0) for i in range(400)]
    assert np.mean(right) > 0.98 and rows[1000]["toxic"] and not rows[1001]["toxic"] and not rows[400]["toxic"]
    assert all(len(r["p_categories"]) == 3 for r in rows.values())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 315 < kept.count() < 331


def test_each_row_is_judged_by_its_own_text(spark):
    docs, labels = labelled(spark)
    bad, good = "the small river scumbags hill", "the small river"
    rows = [(None, bad, "en", "s"), (None, good, "en", "s"), (7001, bad, "en", "s"), (7001, good, "en", "s"), (7002, None, None, None)]
    kept = toxicity.drop_toxic(docs.union(spark.createDataFrame(rows, docs.schema)), labels)
    left = [(r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is None or r["doc_id"] > 7000]
    assert sorted(left, key=str) == sorted([(None, "x"), (None, good), (7001, good), (7002, None)], key=str)
    assert kept.schema == docs.schema


def test_later_models_see_out_of_fold_log_odds():
    rng = np.random.default_rng(4)
    n = 600
    first = rng.integers(0, 2, n)
    second = first * rng.integers(0, 2, n)
    texts = [(np.array(sorted({1 + int(a), 10 + int(rng.integers(0, 5)), 30 + int(b)})), np.ones(3, int)) for a, b in zip(first, second)]
    chain = toxicity.fit_chain(texts, np.stack([first, second], axis=1).astype(float), ["wide", "narrow"])
    assert chain.earlier[0].tolist() == [0.0, 0.0] and chain.earlier[1, 0] > 0


def test_groups_run_across_batches():
    frames = [pd.DataFrame({"k": [1, 1, 2], "v": [1, 2, 3]}), pd.DataFrame({"k": [], "v": []}), pd.DataFrame({"k": [2, 3], "v": [4, 5]})]
    assert [g["v"].tolist() for g in jaccard.groups(iter(frames), ["k"])] == [[1, 2], [3, 4], [5]]
