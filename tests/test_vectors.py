import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.errors import WordNotInVocabulary
from wordloom.functions import vectors as vec
from wordloom.operators import clustering, decomposition, similarity


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    x[7] = 0.0
    x[9] = x[8]
    return x


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(i, f"w{i}", [float(v) for v in p], i % 4) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id int, tok string, vec array<double>, grp int").repartition(3)


def cosine(a, b):
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


def brute_neighbours(points, word, n, measure):
    found = []
    for j in range(len(points)):
        if j != word:
            s = cosine(points[word], points[j]) if measure == "cosine" else -np.linalg.norm(points[word] - points[j])
            if not np.isnan(s):
                found.append((-s, j))
    return [(f"w{j}", round(-s, 9)) for s, j in sorted(found)[:n]]


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_most_similar(vectors, points):
    for measure, fn in (("cosine", vec.cosine), ("euclidean", vec.negative_euclidean)):
        got = similarity.most_similar(vectors, "w3", 7, fn).orderBy("rank").collect()
        want = brute_neighbours(points, 3, 7, measure)
        assert [(r["neighbor"], round(r["similarity"], 9)) for r in got] == want
    with pytest.raises(WordNotInVocabulary):
        similarity.most_similar(vectors, "nope")
    with pytest.raises(ValueError):
        similarity.most_similar(vectors, "w3", 0)


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
@pytest.mark.parametrize("measure", ["cosine", "euclidean"])
@pytest.mark.parametrize("probe_bytes", [1 << 26, 200])
def test_most_similar_batch(spark, vectors, points, measure, probe_bytes):
    words = spark.createDataFrame([(f"w{i}",) for i in (0, 7, 8, 9, 33)] + [("unknown",)], "tok string")
    got = similarity.most_similar_batch(vectors, words, 6, measure, probe_bytes)
    for i in (0, 7, 8, 9, 33):
        mine = got.where(F.col("word") == f"w{i}").orderBy("rank").collect()
        want = brute_neighbours(points, i, 6, measure) if i != 7 or measure != "cosine" else []
        assert [(r["neighbor"], round(r["similarity"], 9)) for r in mine] == want


def test_ties_rank_by_id(spark):
    rows = [(0, "q", [1.0, 0.0]), (3, "c", [0.0, 1.0]), (2, "b", [0.0, 2.0]), (1, "a", [0.0, 3.0])]
    df = spark.createDataFrame(rows, "id int, tok string, vec array<double>")
    for got in (
        similarity.most_similar(df, "q", 2),
        similarity.most_similar_batch(df, df.where("tok = 'q'").select("tok"), 2),
    ):
        assert rows_of(got, "rank", "neighbor") == [(1, "a"), (2, "b")]


def test_sparse_neighbours_skip_empty_rows(spark):
    dense = np.array([[0, 2, 1, 0], [2, 0, 3, 0], [1, 3, 0, 0], [0, 0, 0, 0]], float)
    cells = [(i, j, dense[i, j]) for i in range(4) for j in range(4) if dense[i, j]]
    df = spark.createDataFrame([(i, j, float(v)) for i, j, v in cells], "row int, col int, value double")
    vocab = spark.createDataFrame([(f"w{i}", i, 1) for i in range(4)], "tok string, id int, n bigint")
    got = similarity.most_similar_sparse(df, vocab, "w0", 5).orderBy("rank").collect()
    want = sorted(((-cosine(dense[0], dense[j]), j) for j in (1, 2)))
    assert [(r["neighbor"], round(r["similarity"], 9)) for r in got] == [(f"w{j}", round(-s, 9)) for s, j in want]
    assert similarity.most_similar_sparse(df, vocab, "w3", 5).count() == 0


def test_vectors_for_words(spark, vectors):
    some = spark.createDataFrame([("w1",), ("w2",)], "tok string")
    assert rows_of(similarity.vectors_for_words(vectors, some), "id") == [(1,), (2,)]
    assert similarity.vectors_for_words(vectors).count() == 60
    with pytest.raises(WordNotInVocabulary):
        similarity.vectors_for_words(vectors, spark.createDataFrame([("zz",)], "tok string"))


def test_svd_matches_dense_and_reports_rank(spark):
    rng = np.random.default_rng(0)
    half = rng.normal(size=(30, 4))
    a = half @ half.T
    cells = [(i, j, float(a[i, j])) for i in range(30) for j in range(30)]
    df = spark.createDataFrame(cells, "row int, col int, value double")
    u, sigma = decomposition.svd_truncate(df, 30, 10)
    want_u, want_s, _ = np.linalg.svd(a)
    assert len(sigma) == 4 and np.allclose(sigma, want_s[:4])
    got = np.array([r["vec"] for r in u.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(want_u[:, :4]), atol=1e-9)
    for column in got.T:
        assert column[np.argmax(np.abs(np.round(column, 12)))] > 0
    gram = {(r["i"], r["j"]): r["value"] for r in decomposition.gram(u).collect()}
    assert all(abs(v - (i == j)) < 1e-9 for (i, j), v in gram.items()) and len(gram) == 16


def test_block_iteration_agrees_with_lanczos(spark):
    rng = np.random.default_rng(5)
    a = rng.random((40, 40)) * (rng.random((40, 40)) < 0.4)
    cells = [(i, j, float(a[i, j])) for i in range(40) for j in range(40) if a[i, j]]
    df = spark.createDataFrame(cells, "row int, col int, value double")
    want_u, want_s, _ = np.linalg.svd(a)
    u, sigma = decomposition.svd_truncate(df, 40, 5, lanczos_bytes=0)
    got = np.array([r["vec"] for r in u.orderBy("id").collect()])
    assert np.allclose(sigma, want_s[:5], rtol=1e-8)
    assert np.allclose(np.abs(got), np.abs(want_u[:, :5]), atol=1e-4)
    low = [(i, j, float(v)) for (i, j), v in np.ndenumerate(np.outer(a[0], a[1]))]
    flat = spark.createDataFrame(low, "row int, col int, value double").where("value <> 0")
    assert len(decomposition.svd_truncate(flat, 40, 5, lanczos_bytes=0)[1]) == 1


def test_pca_matches_dense(vectors, points):
    got = np.array([r["coords"] for r in decomposition.pca(vectors).orderBy("id").collect()])
    centred = points - points.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ vt[:2].T), atol=1e-9)


def brute_linkage(d):
    """Merge the closest pair again and again; returns the sorted merge heights."""
    clusters = {i: [i] for i in range(len(d))}
    heights = []
    while len(clusters) > 1:
        names = sorted(clusters)
        best = min(
            (max(d[i, j] for i in clusters[a] for j in clusters[b]), a, b)
            for x, a in enumerate(names) for b in names[x + 1 :]
        )
        heights.append(best[0])
        clusters[best[1]] += clusters.pop(best[2])
    return sorted(heights)


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_distances_and_linkage(spark, points, block_rows):
    some = np.delete(points[:30], 9, axis=0)
    some = np.concatenate([some, np.ones((len(some), 1))], axis=1)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(some)], "id int, vec array<double>")
    var = some.var(axis=0, ddof=1)
    live = var > 0
    want = np.sqrt((((some[:, None, live] - some[None, :, live]) ** 2) / var[live]).sum(axis=2))
    table = clustering.seuclidean_distances(df, block_rows)
    got = {(r["a"], r["b"]): r["distance"] for r in table.collect()}
    n = len(some)
    assert len(got) == n * (n - 1) // 2 == table.count()
    assert all(abs(want[a, b] - d) < 1e-9 and a < b for (a, b), d in got.items())
    merges = clustering.complete_linkage(table).collect()
    assert np.allclose(sorted(r["height"] for r in merges), brute_linkage(want))
    assert max(r["size"] for r in merges) == n and len(merges) == n - 1


def test_linkage_of_one_vector_is_empty(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], "id int, vec array<double>")
    assert clustering.complete_linkage(clustering.seuclidean_distances(one)).count() == 0


def test_group_cohesion_equals_all_pairs(vectors, points):
    got = {r["grp"]: r for r in clustering.group_cohesion(vectors, "grp").collect()}
    real = [i for i in range(60) if i != 7]
    for g in range(4):
        mine, others = [i for i in real if i % 4 == g], [i for i in real if i % 4 != g]
        within = np.mean([cosine(points[i], points[j]) for i in mine for j in mine if i != j])
        between = np.mean([cosine(points[i], points[j]) for i in mine for j in others])
        assert got[g]["n"] == len(mine)
        assert abs(got[g]["within"] - within) < 1e-9 and abs(got[g]["between"] - between) < 1e-9


def test_tiles_cover_all_and_stay_small():
    seen = np.zeros((70_000, 2100), np.int8)
    for a, b in similarity.tiles(70_000, 2100):
        assert (a.stop - a.start) * (b.stop - b.start) <= similarity.TILE_CELLS
        seen[a, b] += 1
    assert (seen == 1).all()
    assert list(similarity.tiles(0, 5)) == []


def test_running_best_ranks_ties_by_id():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 4, (20, 90)).astype(float), rng.permutation(90)
    scores[rng.random(scores.shape) < 0.2] = np.nan
    best = similarity._Best(7)
    for lo in range(0, 90, 13):
        for q in (0, 10):
            best.add(q, scores[q : q + 10, lo : lo + 13], ids[lo : lo + 13])
    for q in range(20):
        want = sorted((-s, i) for s, i in zip(scores[q], ids) if not np.isnan(s))[:7]
        mine = best.query == q
        assert list(zip(-best.score[mine], best.other[mine])) == want


@pytest.mark.parametrize("measure", ["cosine", "dot", "euclidean"])
def test_sparse_measures_equal_dense_ones(spark, measure):
    rng = np.random.default_rng(8)
    dense = rng.random((12, 6)) * (rng.random((12, 6)) < 0.5)
    dense[4] = 0
    cells = spark.createDataFrame(
        [(i, j, float(x)) for (i, j), x in np.ndenumerate(dense) if x], "row int, col int, value double"
    )
    vocab = spark.createDataFrame([(f"w{i}", i) for i in range(12)], "tok string, id int")
    got = similarity.most_similar_sparse(cells, vocab, "w0", 11, measure).orderBy("rank").collect()
    dots, norms = dense @ dense[0], np.linalg.norm(dense, axis=1)
    with np.errstate(invalid="ignore"):
        want = {"cosine": dots / norms / norms[0], "dot": dots, "euclidean": -np.linalg.norm(dense - dense[0], axis=1)}[measure]
    order = sorted((i for i in range(1, 12) if not np.isnan(want[i])), key=lambda i: (-round(want[i], 9), i))
    assert [r["neighbor"] for r in got] == [f"w{i}" for i in order]
    assert np.allclose([r["similarity"] for r in got], want[order])


def test_svd_gives_a_zero_row_to_words_without_cells(spark):
    cells = spark.createDataFrame([(0, 1, 2.0), (1, 0, 2.0), (1, 3, 1.0), (3, 1, 1.0)], "row int, col int, value double")
    for limit in (decomposition.LANCZOS_BYTES, 0):
        u, sigma = decomposition.svd_truncate(cells, 5, 2, lanczos_bytes=limit)
        rows = {r["id"]: r["vec"] for r in u.collect()}
        assert sorted(rows) == [0, 1, 2, 3, 4] and rows[2] == rows[4] == [0.0] * len(sigma)
        assert any(rows[0]) and any(rows[1])


def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    from wordloom.operators import joins

    sent, real = [], F.broadcast
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 4096)
    monkeypatch.setattr(joins.F, "broadcast", lambda df: sent.append(df.count()) or real(df))
    dim = spark.range(200).select(
        F.col("id").alias("k"), F.array_repeat(F.lit(1.0), 100).alias("vec"), (F.col("id") + 1).alias("n")
    )
    fact = spark.range(1000).select((F.col("id") % 200).alias("k"))
    assert joins.skew_safe_join(fact, dim, "k", "n").count() == 1000
    assert sent and max(sent) * 800 <= 4096


@pytest.mark.parametrize("block_bytes", [1 << 20, 20 * 8 * 3, 8])
def test_sparse_products_shuffle_cells_not_vectors(spark, block_bytes):
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((20, 20)) < 0.3, rng.integers(1, 9, (20, 20)), 0).astype(float)
    dense[7] = 0.0
    v = rng.random((20, 7))
    at = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    cells = spark.createDataFrame(at, "row int, col int, value double")
    vectors = spark.createDataFrame([(i, v[i].tolist()) for i in range(20) if i != 3], "id int, vec array<double>")
    v[3] = 0.0
    found = decomposition._times(cells, vectors, "row", "col", block_bytes)
    got = {r["id"]: np.array(r["vec"]) for r in found.collect()}
    met = {j for i, j, _ in at if i != 3}
    assert set(got) == met and all(np.allclose(got[j], (dense.T @ v)[j]) for j in met)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (block_bytes == 8)


def test_lanczos_passes_have_no_more_tasks_than_cores(spark, monkeypatch):
    rng = np.random.default_rng(9)
    a = rng.random((120, 120)) * (rng.random((120, 120)) < 0.3)
    cells = [(i, j, float(a[i, j])) for i in range(120) for j in range(120) if a[i, j]]
    df = spark.createDataFrame(cells, "row int, col int, value double").repartition(9)
    tasks, real = [], decomposition.IndexedRowMatrix
    monkeypatch.setattr(
        decomposition, "IndexedRowMatrix", lambda rows, *size: tasks.append(rows.rdd.getNumPartitions()) or real(rows, *size)
    )
    monkeypatch.setattr(decomposition, "CELLS_PER_TASK", 100)
    monkeypatch.setattr(decomposition, "CELLS_PER_PART", 100, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        u, sigma = decomposition.svd_truncate(df, 120, 6)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # each task of a pass shuffles a vector as long as the vocabulary
    assert tasks and max(tasks) <= spark.sparkContext.defaultParallelism
    want_u, want_s, _ = np.linalg.svd(a)
    got = np.array([r["vec"] for r in u.orderBy("id").collect()])
    assert np.allclose(sigma, want_s[:6], rtol=1e-9) and np.allclose(np.abs(got), np.abs(want_u[:, :6]), atol=1e-6)


def test_word_word_roundtrip_names_words_without_sorting_cells(spark, tmp_path):
    from wordloom.plans.queries import QUERIES

    spark.createDataFrame([(1, "a b a b c. " * 30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES["model_roundtrip_word_word"](spark, str(tmp_path))
        got = {(r["word"], r["context"]): r["value"] for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got["a", "a"] == 60 and got["a", "b"] == got["b", "a"] == 120 and got["c", "a"] == 60 and len(got) == 8
    # the cells of a word are as skewed as its count
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
