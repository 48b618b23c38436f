import hashlib
import inspect
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.errors import WordNotInVocabulary
from wordloom.functions import hashing
from wordloom.operators import blocked_training, corpus, encoding, phrases, vocabulary, word2vec
from wordloom.operators import language_model as lm
from wordloom.operators import series
from wordloom.plans import cli, jobs
from wordloom.plans.models import EmbeddingModel, LanguageModel, TermDocumentModel, WordWordModel
from wordloom.sources import saved
from wordloom.sources.scratch import checkpoint_dir, materialize
from wordloom.sources.text_files import list_documents, read_text_lines
from wordloom.streaming.text_stream import stream_encoded, stream_lines


@pytest.fixture(scope="module")
def small_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return materialize(corpus.read_lines(docs.select("doc_id", "text")), "lines")


def test_scratch_folder_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_term_document_model(spark, micro, tmp_path):
    model = jobs.build_term_document(corpus.read_lines(micro), micro.select("doc_id"), min_count=2)
    model.save(str(tmp_path / "td"))
    again = TermDocumentModel.load(spark, str(tmp_path / "td"))
    assert rows_of(again.td) == rows_of(model.td) and again.settings["min_count"] == 2
    weighted = again.tf_idf()
    assert weighted.word_vector("dogs").where("doc_ix = 1").first()["value"] == pytest.approx(2.60206, abs=1e-5)
    with pytest.raises(ValueError):
        weighted.tf_idf()
    with pytest.raises(ValueError):
        WordWordModel.load(spark, str(tmp_path / "td"))


def test_word_word_model(spark, micro, tmp_path):
    model = jobs.build_word_word(corpus.read_lines(micro), window=1, min_count=2)
    model.save(str(tmp_path / "ww"))
    again = WordWordModel.load(spark, str(tmp_path / "ww"))
    assert rows_of(again.cells) == rows_of(model.cells) and again.settings["window"] == 1
    weighted = again.ppmi(0.75)
    with pytest.raises(ValueError):
        weighted.ppmi()
    with pytest.raises(WordNotInVocabulary):
        again["fly"]
    svd = weighted.svd_truncate(3)
    assert svd.settings["k_effective"] == 3
    assert svd.most_similar("cats", 2).count() == 2
    assert svd.pca().count() == 6


def test_settings_decide_the_path_and_complete_models_are_reused(spark, tmp_path):
    one = saved.config_path(str(tmp_path), {"min_count": 1})
    assert one != saved.config_path(str(tmp_path), {"min_count": 2})
    built = []

    def build():
        built.append(1)
        return {"t": spark.range(3)}

    for _ in range(2):
        tables, settings = saved.build_once(spark, one, build, {"min_count": 1})
        assert tables["t"].count() == 3 and settings["min_count"] == 1
    assert built == [1]
    prep = saved.preprocessor_settings()
    assert prep["version"] == "V1" and saved.preprocessor_from(prep) is None
    assert saved.preprocessor_from(saved.preprocessor_settings("[^a-z]")) is not None
    with pytest.raises(FileNotFoundError):
        saved.load_tables(spark, str(tmp_path / "nothing"))


def test_text_files_keep_line_numbers_across_splits(spark, tmp_path):
    want = []
    for name, n in (("1.txt", 900), ("2.txt", 3), ("3.txt", 0), ("skip.md", 5)):
        lines = [f"  line {i} of {name} é " if i % 7 else " " for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines), encoding="utf8")
        if name.endswith("txt"):
            want += [(name, i, line.strip()) for i, line in enumerate(lines) if line.strip()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = read_text_lines(spark, str(tmp_path), "*.txt")
        assert found.rdd.getNumPartitions() > 3
        got = rows_of(found.select(F.element_at(F.split("doc_id", "/"), -1), "line_no", "line"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(want)
    listed = list_documents(spark, str(tmp_path), "*.txt")
    assert listed.count() == 3 and listed.join(found, "doc_id", "left_anti").count() == 1


def test_stream_equals_batch(spark, tmp_path, micro_sents, micro_vocab):
    (tmp_path / "b.txt").write_text("Mice like cheese.\nDogs chase cats. Dogs can't fly.", encoding="utf8")
    found = spark.createDataFrame([("dogs", "chase", 20.0)], "a string, b string, score double")
    stream = stream_encoded(stream_lines(spark, str(tmp_path)), micro_vocab, [found])
    job = (
        stream.writeStream.format("memory").queryName("stream_out").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    job.awaitTermination(60)
    batch = phrases.apply_phrases(micro_sents.where("doc_id = 'b'"), found)
    want = encoding.encode_sentences(batch, micro_vocab)
    assert rows_of(spark.table("stream_out"), "line_no", "sent_no", "toks", "ids") == rows_of(
        want, "line_no", "sent_no", "toks", "ids"
    )


# ---- word2vec


@pytest.fixture(scope="module")
def pair_corpus(spark):
    """Words a*/b* only ever meet their own kind."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        kind = "ab"[i % 2]
        rows.append((i, 0, 0, [f"{kind}{rng.integers(6)}" for _ in range(8)]))
    df = spark.createDataFrame(rows, "doc_id int, line_no int, sent_no int, toks array<string>")
    return materialize(df.repartition(4, "doc_id"), "pairs")


def test_subsampling_paths_agree_and_ignore_partitioning(pair_corpus):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    want = rows_of(word2vec.subsample(pair_corpus, vocab, 0.01, 3).select("doc_id", "kept"))
    again = word2vec.subsample(pair_corpus.repartition(2), vocab, 0.01, 3)
    joined = word2vec.subsample(pair_corpus, vocab, 0.01, 3, limit=2)
    assert rows_of(again.select("doc_id", "kept")) == want == rows_of(joined.select("doc_id", "kept"))
    kept = sum(len(k) for _, k in want)
    chance = word2vec.keep_probabilities(vocab, 0.01).agg(F.sum(F.col("keep") * F.col("n"))).first()[0]
    assert abs(kept - chance) < 4 * chance**0.5


def test_windows_hold_neighbours_within_reach(pair_corpus):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    kept = word2vec.subsample(pair_corpus, vocab, 1.0, 3)
    words = {r["doc_id"]: [k["id"] for k in r["kept"]] for r in kept.collect()}
    widths = set()
    for r in word2vec.context_windows(kept, 3, 5).collect():
        ids, i = words[r["doc_id"]], r["pos"]
        options = {w: ids[max(0, i - w) : i] + ids[i + 1 : i + 1 + w] for w in (1, 2, 3)}
        fits = [w for w, ctx in options.items() if ctx == r["ctx"]]
        assert fits
        if 3 <= i <= 4:
            widths.add(fits[0])
    assert widths == {1, 2, 3}


def test_noise_follows_its_distribution(pair_corpus):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    assert word2vec.negative_distribution(vocab).agg(F.sum("p")).first()[0] == pytest.approx(1.0)
    windows = word2vec.context_windows(word2vec.subsample(pair_corpus, vocab, 1.0, 3), 2, 5)
    drawn = word2vec.negative_samples(windows, vocab, 5, 3)
    assert drawn.where(F.array_contains("noise", F.col("context"))).count() == 0
    counts = drawn.select(F.explode("noise").alias("id")).groupBy("id").count().collect()
    total = sum(r["count"] for r in counts)
    assert len(counts) == 12 and all(abs(r["count"] / total - 1 / 12) < 0.02 for r in counts)


def test_digits_of_hashes_are_the_hashes(spark):
    rows = spark.range(300).select("id", F.concat_ws("|", "id", F.lit("ü")).alias("t")).coalesce(1)
    names = ["noise|0", "noise|10"]
    want = rows.select(*[hashing.hash32(7, F.lit(n), F.col("t")) for n in names]).collect()
    digits = F.concat(*[hashing.hash_digits(7, F.lit(n), F.col("t")) for n in names]).alias("d")
    found = rows.select(digits).toArrow().column("d").combine_chunks()
    assert hashing.from_digits(found, 2).tolist() == [list(r) for r in want]
    assert hashing.from_digits(found.slice(7, 20), 2).tolist() == [list(r) for r in want[7:27]]
    assert hashing.from_digits(found.slice(0, 0), 2).shape == (0, 2)
    assert hashing.from_digits(pa.array(["", ""]), 0).shape == (2, 0)


def test_hashes_in_arrays_are_those_of_the_column(spark):
    """Empty and wide texts, the longest that fit one block, slices, nulls, and keys of unequal length."""
    keys, most = ["noise|0", "noise|1", "noise|10"], 55 - len("7|noise|10|")
    texts = ["", "0|a|1", "ü" * (most // 2), *["x" * n for n in range(most + 3)], *[f"0|{i}|{i % 3}" for i in range(50)]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1).orderBy("i")
    fits = [r[0] for r in rows.select(hashing.fits_arrays(7, keys, F.col("t"))).collect()]
    assert fits == [len(t.encode()) <= most for t in texts] and not all(fits)
    want = rows.select(*[hashing.hash32(7, F.lit(k), F.col("t")) for k in keys]).collect()
    got = hashing.hash32_of(7, keys, pa.array(["before", *[t if f else None for t, f in zip(texts, fits)]]).slice(1))
    assert [g for g, f in zip(got.tolist(), fits) if f] == [list(w) for w, f in zip(want, fits) if f]
    assert hashing.hash32_of(7, [], pa.array(texts)).shape == (len(texts), 0)


def test_noise_of_long_places_is_the_same(spark, random_sents):
    """An id beyond one md5 block is hashed by Spark; both kinds in one table."""
    vocab = materialize(vocabulary.vocabulary(vocabulary.token_counts(random_sents), 1), "vocab")
    schema = "doc_id string, line_no int, sent_no int, pos int, center int, ctx array<int>"
    windows = spark.createDataFrame([(d, 0, 0, 2, 3, [1, 2]) for d in ("a", "b" * 80, None)], schema)
    few = word2vec.negative_samples(windows, vocab, 3, seed=4)
    many = word2vec.negative_samples(windows, vocab, 3, seed=4, limit=0)
    assert few.count() == 6
    for row in few.collect():
        drawn = many.where((F.col("context") == row["context"]) & F.col("doc_id").eqNullSafe(F.lit(row["doc_id"])))
        assert row["doc_id"] is None or drawn.first()["noise"] == row["noise"]


@pytest.mark.parametrize("algorithm", ["skip-gram", "cbow"])
def test_embeddings_learn_which_words_meet(pair_corpus, algorithm):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    how = dict(vector_size=16, window=4, epochs=8, sample=1.0, seed=4, chunk_words=2400)
    vectors, losses = word2vec.train_word2vec(pair_corpus, vocab, algorithm, **how)
    assert losses[-1] < losses[0] * 0.98
    found = {r["tok"]: np.array(r["vec"]) for r in vectors.collect()}
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    same = np.mean([unit[a] @ unit[b] for a in unit for b in unit if a < b and a[0] == b[0]])
    other = np.mean([unit[a] @ unit[b] for a in unit for b in unit if a[0] != b[0]])
    assert same > other + 0.3


@pytest.mark.parametrize("name", ["w2v_skipgram", "w2v_cbow"])
def test_embedding_queries_train_with_the_full_parameters(spark, monkeypatch, name):
    """The published job's settings: 20 epochs of vectors of 100."""
    from wordloom.plans import queries

    seen = {}

    def train(sents, vocab, algorithm="skip-gram", **how):
        seen.update(how)
        return vocab.select("id", "tok", F.array(F.lit(1.0)).alias("vec")), []

    monkeypatch.setattr(word2vec, "train_word2vec", train)
    queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert (seen["epochs"], seen["vector_size"]) == (20, 100)


@pytest.mark.parametrize("algorithm", ["skip-gram", "cbow"])
def test_embeddings_do_not_depend_on_partitions(pair_corpus, algorithm):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    how = dict(vector_size=8, window=3, epochs=2, sample=0.05, seed=4, chunk_words=500)
    found = []
    for parts in (2, 8):
        vectors, losses = word2vec.train_word2vec(pair_corpus.repartition(parts, "doc_id"), vocab, algorithm, **how)
        rounded = {r["tok"]: np.round(r["vec"], 9).tolist() for r in vectors.collect()}
        found.append((rounded, np.round(losses, 9).tolist()))
    assert found[0] == found[1]


@pytest.mark.parametrize("algorithm", ["skip-gram", "cbow"])
def test_sent_weights_train_as_tables_do(spark, pair_corpus, algorithm):
    """The same vectors and losses, and neither examples nor former weights are left on disk."""
    some = materialize(pair_corpus.where("doc_id < 60"), "some")
    vocab = materialize(vocabulary.vocabulary(vocabulary.token_counts(some), 1), "vocab")
    how = dict(vector_size=8, window=3, epochs=2, sample=0.05, seed=4, chunk_words=150)
    where = Path(checkpoint_dir(spark)) / "wordloom"
    found = []
    for limit in (0, 1 << 20):
        old = set(where.glob("w2v-*"))
        vectors, losses = word2vec.train_word2vec(some, vocab, algorithm, limit=limit, **how)
        found.append(({r["tok"]: np.round(r["vec"], 12).tolist() for r in vectors.collect()}, np.round(losses, 12).tolist()))
        assert len(set(where.glob("w2v-*")) - old) == 1
    assert found[0] == found[1] and len(found[0][0]) == vocab.count()


@pytest.mark.parametrize("skipgram", [True, False])
def test_examples_together_are_the_same(spark, skipgram):
    """Sentences of several parts, too; every chunk comes in one piece and in its order."""
    rng = np.random.default_rng(2)
    rows = [(d, 0, s, [f"w{i}" for i in rng.integers(0, 30, n)]) for d in range(6) for s, n in enumerate((3, 2500, 1, 999, 1003))]
    sents = materialize(spark.createDataFrame(rows, "doc_id int, line_no int, sent_no int, toks array<string>"), "long")
    vocab = materialize(vocabulary.vocabulary(vocabulary.token_counts(sents), 1), "vocab")
    how = (sents, vocab, skipgram, 4, 2, 0.02, 4, 1, 300)
    apart = word2vec.training_examples(*how)
    together = word2vec.training_examples(*how, together=True)
    assert apart.columns == together.columns
    assert sorted(map(str, apart.collect())) == sorted(map(str, together.collect()))
    found = together.withColumn("task", F.spark_partition_id()).collect()
    order = [(r["task"], r["chunk"], r["turn"], r["doc_id"], r["line_no"], r["sent_no"], r["pos"], r["nth"]) for r in found]
    assert order == sorted(order) and len({r["chunk"] for r in found}) == len({(r["task"], r["chunk"]) for r in found}) > 5


@pytest.mark.parametrize("algorithm", ["skip-gram", "cbow"])
def test_one_epoch_equals_the_same_steps_on_arrays(pair_corpus, algorithm):
    """Per chunk the published update, example by example; moves averaged over chunks by use."""
    some = materialize(pair_corpus.where("doc_id < 60"), "some")
    vocab = vocabulary.vocabulary(vocabulary.token_counts(some), 1)
    made = word2vec.training_examples(some, vocab, algorithm == "skip-gram", 4, 5, 1.0, 4, 0, chunk_words=150)
    examples = materialize(made, "examples")
    weights = materialize(word2vec.start_weights(vocab, 8, 4), "weights")
    after, loss = word2vec.train_epoch(weights, examples, 0, 2, step_examples=1)
    n = vocab.count()
    start = np.zeros((2, n, 8))
    for r in weights.collect():
        start[r["side"], r["id"]] = r["vec"]
    moves, uses, total, seen = np.zeros((2, n, 8)), np.zeros((2, n)), 0.0, 0
    chunks = {}
    for r in examples.collect():
        chunks.setdefault(r["chunk"], []).append(r)
    assert len(chunks) > 1
    for rows in chunks.values():
        rows.sort(key=lambda r: (r["turn"], r["doc_id"], r["line_no"], r["sent_no"], r["pos"], r["nth"]))
        now, own = start.copy(), np.zeros((2, n))
        for i, r in enumerate(rows):
            rate = 0.025 + (0.0001 - 0.025) * (i / len(rows)) / 2
            hidden, back = now[0][r["ins"]].mean(axis=0), np.zeros(8)
            forward = np.zeros((n, 8))
            own[0] += np.bincount(r["ins"], minlength=n)
            own[1] += np.bincount([r["out"], *r["noise"]], minlength=n)
            for k, (word, label) in enumerate([(r["out"], 1.0), *((w, 0.0) for w in r["noise"])]):
                if k and word == r["out"]:
                    continue
                guess = 1 / (1 + np.exp(-hidden @ now[1][word]))
                total -= np.log((guess if label else 1 - guess) + 1e-12)
                back += rate * (label - guess) * now[1][word]
                forward[word] += rate * (label - guess) * hidden
            now[1] += forward
            for word in r["ins"]:
                now[0][word] += back
            seen += 1
        moves += own[:, :, None] * (now - start)
        uses += own
    want = start + moves / np.maximum(uses, 1)[:, :, None]
    got = np.zeros_like(want)
    for r in after.collect():
        got[r["side"], r["id"]] = r["vec"]
    assert np.allclose(got, want, atol=1e-12) and loss == pytest.approx(total / seen)


def test_noise_by_join_equals_noise_by_search(pair_corpus):
    vocab = vocabulary.vocabulary(vocabulary.token_counts(pair_corpus), 1)
    windows = word2vec.context_windows(word2vec.subsample(pair_corpus, vocab, 1.0, 3), 2, 5)
    sent = word2vec.negative_samples(windows, vocab, 5, 3)
    joined = word2vec.negative_samples(windows, vocab, 5, 3, limit=2)
    assert rows_of(sent) == rows_of(joined)


def test_embedding_model_with_phrases(spark, small_lines, tmp_path):
    model = jobs.train_embeddings(small_lines, vector_size=8, n_iter=1, phrases_size=1, num_partitions=2)
    model.save(str(tmp_path / "emb"))
    again = EmbeddingModel.load(spark, str(tmp_path / "emb"))
    assert rows_of(again.vectors, "id", "tok") == rows_of(model.vectors, "id", "tok")
    assert len(again.phrase_tables) == 1 and again.settings["algorithm"] == "skip-gram"
    assert again.vectors.where(F.contains("tok", F.lit("_"))).count() > 0


# ---- language model


def sequential(batches, weights, size, epochs, optimizer, l2, frozen=False):
    """Plain mini-batch training with numerically checked gradients' formulas."""
    w = [a.copy() for a in weights]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    costs, t = [], 0
    for _ in range(epochs):
        for words, y in batches:
            cost, _, grads = lm._gradients(w, words, y, l2)
            costs.append(cost)
            t += 1
            for i, g in enumerate(grads):
                if i == 0 and frozen:
                    continue
                if optimizer == "sgd":
                    w[i] -= 0.001 * g
                    continue
                b1t = 0.9 * (1 - 1e-8) ** (t - 1)
                m[i] = b1t * m[i] + (1 - b1t) * g
                v[i] = 0.999 * v[i] + 0.001 * g**2
                w[i] -= 0.001 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w, costs


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(2)
    w = [rng.normal(size=s) for s in ((7, 3), (6, 4), (4,), (7, 4), (7,))]
    words, y = rng.integers(0, 7, (5, 2)), rng.integers(0, 7, 5)
    _, _, grads = lm._gradients(w, words, y, 0.3)
    for i, g in enumerate(grads):
        for at in [tuple(rng.integers(0, s) for s in g.shape) for _ in range(6)]:
            step = 1e-6
            w[i][at] += step
            up = lm._gradients(w, words, y, 0.3)[0]
            w[i][at] -= 2 * step
            down = lm._gradients(w, words, y, 0.3)[0]
            w[i][at] += step
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-4, abs=1e-7)


@pytest.fixture(scope="module")
def lm_data(small_lines):
    vocab, rows = jobs.prepare_minibatches(small_lines, context_size=2, min_count=60, mini_batch_size=32, per_file=5)
    return vocab.count(), rows


@pytest.mark.parametrize("optimizer, frozen", [("adam", False), ("sgd", False), ("adam", True)])
def test_one_partition_is_sequential_training(spark, lm_data, optimizer, frozen):
    size, rows = lm_data
    params = materialize(lm.init_params(spark, size, 2, 6, 5, seed=1), "init")
    local = materialize(rows.coalesce(1).orderBy("split", "file_ix", "file_slot").coalesce(1), "one")
    got, stats = lm.train_language_model(
        local, params, size, epochs=2, lmbda=0.01, optimizer=optimizer, chunk_batches=1 << 40,
        learn_embeddings=not frozen,
    )
    ordered = local.where("split = 'train'").orderBy("file_ix", "file_slot").collect()
    batches = [(np.array(r["x_idx"]).reshape(32, 2) % size, np.array(r["y"])) for r in ordered]
    want, costs = sequential(batches, lm.load_weights(params), size, 2, optimizer, 0.01, frozen)
    for a, b in zip(lm.load_weights(got), want):
        assert np.allclose(a, b, atol=1e-9)
    ids = [r["mb_id"] for r in ordered]
    for epoch in (0, 1):
        seen = {
            r["mb_id"]: r["value"]
            for r in stats.where(f"epoch = {epoch} and split = 'train' and metric = 'cost'").collect()
        }
        start = epoch * len(ids)
        assert np.allclose([seen[i] for i in ids], costs[start : start + len(ids)])


def test_training_on_partitions_lowers_held_out_cost(spark, lm_data, tmp_path):
    size, rows = lm_data
    params = materialize(lm.init_params(spark, size, 2, 8, 8, seed=1), "init")
    for how in (
        dict(sync="average", chunk_batches=10, rate=0.01),
        dict(sync="gradient", chunk_batches=10, steps_per_epoch=8, rate=0.05, path_to_save=str(tmp_path / "lm")),
    ):
        _, stats = lm.train_language_model(rows, params, size, epochs=3, **how)
        cost = {r["epoch"]: r["value"] for r in stats.where("split = 'validate' and metric = 'cost'").collect()}
        assert sorted(cost) == [0, 1, 2] and cost[2] < cost[0] < np.log(size) + 0.05
        n_train = rows.where("split = 'train'").count()
        assert stats.where("split = 'train' and metric = 'accuracy' and epoch = 1").count() == n_train
    assert spark.read.parquet(str(tmp_path / "lm")).select("epoch").distinct().count() == 3


def test_language_model_job(spark, small_lines, tmp_path):
    vectors = spark.createDataFrame([("the", [9.0] * 4)], "tok string, vec array<double>")
    model = jobs.train_language_model(
        small_lines, epochs=1, context_size=2, min_count=60, hidden_units=4, mini_batch_size=16,
        dimensions=4, chunk_batches=20, vectors=vectors, learn_embeddings=False,
    )
    row = model.vocab.where("tok = 'the'").first()["id"]
    kept = model.params.where((F.col("layer") == 0) & (F.col("row") == row)).first()["vals"]
    assert kept == [9.0] * 4
    model.save(str(tmp_path / "net"))
    again = LanguageModel.load(spark, str(tmp_path / "net"), mini_batch_size=1)
    assert again.settings["mini_batch_size"] == 1 and again.layers[1]["activation_fn"] == "ReLU"
    contexts = spark.createDataFrame([(1, [0, again.vocab.count() + 1])], "k int, x_idx array<bigint>")
    top = again.predict(contexts, ["k"], 3).orderBy("rank").collect()
    assert len(top) == 3 and top[0]["p"] >= top[1]["p"] >= top[2]["p"]


def test_no_held_out_batches_record_null(spark, lm_data):
    size, rows = lm_data
    params = materialize(lm.init_params(spark, size, 2, 4, 4), "init")
    _, stats = lm.train_language_model(rows.where("split = 'train'"), params, size, epochs=1)
    held = stats.where("split <> 'train'").collect()
    assert len(held) == 4 and all(r["value"] is None for r in held)


def test_too_large_weights_are_refused(spark, monkeypatch):
    monkeypatch.setattr(lm, "MODEL_BYTES", 100)
    with pytest.raises(ValueError):
        lm.load_weights(lm.init_params(spark, 10, 2, 4, 4))


def test_command_lines(spark, tmp_path):
    text = "Cats chase mice and dogs. Dogs chase cats. Mice like cheese!\n" * 40
    books = tmp_path / "books"
    books.mkdir()
    for name, content in (("1.txt", text), ("2.txt", text), ("3.txt", ""), ("notes.md", text)):
        (books / name).write_text(content)
    source = ["--input", str(books), "--glob", "*.txt", "--save"]

    def save(job, *more):
        cli.main([job, *source, str(tmp_path / job), *more], spark)
        return str(tmp_path / job)

    td = TermDocumentModel.load(spark, save("term-document", "--min_count", "5"))
    assert td.doc_index.count() == 3
    assert [v for _, v in rows_of(td.word_vector("cats"))] == [80.0, 80.0, 0.0]
    ww = WordWordModel.load(spark, save("word-word", "--window", "2", "--min_count", "5"))
    assert ww.settings["window"] == 2 and ww.cells.count() > 0
    emb = EmbeddingModel.load(spark, save("word2vec", "--iter", "1", "--dim", "4", "--phrases", "1"))
    assert emb.vectors.count() == td.vocab.count() or len(emb.phrase_tables) == 1
    for _ in range(2):
        path = save(
            "language-model", "--epochs", "1", "--context_size", "2", "--hidden_units", "3",
            "--dimensions", "3", "--mini_batch_size", "8", "--data", str(tmp_path / "kept"),
        )
    assert LanguageModel.load(spark, path).stats.count() > 0
    assert len(list((tmp_path / "kept").glob("config=*"))) == 1
    assert spark.read.parquet(f"{path}/epochs").count() > 0


def test_scores_do_not_depend_on_vocabulary_blocks(spark, lm_data):
    size, rows = lm_data
    params = lm.init_params(spark, size, 2, 6, 5, seed=1)
    # a softmax away from zero
    draw = F.transform("vals", lambda x: x + 0.1 * F.sin(F.col("row") + 1.0))
    params = materialize(params.withColumn("vals", F.when(F.col("layer") == 2, draw).otherwise(F.col("vals"))), "init")
    flat = rows.select("mb_id", "x_idx", F.posexplode("y").alias("i", "y"))
    examples = materialize(flat.select("mb_id", "i", F.slice("x_idx", F.col("i") * 2 + 1, 2).alias("x_idx"), "y").where("mb_id < 3"), "ex")
    w = lm.load_weights(params)
    first = examples.first()
    p = lm._forward(w, np.array([first["x_idx"]]) % size)[3][0]
    found = []
    for block in (7, 1 << 20):
        scored = lm.score(examples, params, size, ["mb_id", "i"], block).orderBy("mb_id", "i").toPandas()
        top = lm.predict_topk(examples, params, size, ["mb_id", "i"], 4, block).orderBy("mb_id", "i", "rank").toPandas()
        found.append((scored, top))
    (a, at), (b, bt) = found
    assert (a["y_hat"] == b["y_hat"]).all() and np.allclose(a["p_y"], b["p_y"], rtol=1e-12)
    assert (at["word_id"] == bt["word_id"]).all() and np.allclose(at["p"], bt["p"], rtol=1e-12)
    mine = a[(a["mb_id"] == first["mb_id"]) & (a["i"] == first["i"])].iloc[0]
    assert mine["p_y"] == pytest.approx(p[first["y"]]) and mine["y_hat"] == p.argmax()


def test_command_line_passes_its_values_by_name(spark, tmp_path, monkeypatch):
    from wordloom.operators.language_model import CHUNK_BATCHES

    given = {}

    class Saved:
        def save(self, path):
            given["saved"] = path

    def train(*args, **named):
        given.update(inspect.signature(real).bind(*args, **named).arguments)
        return Saved()

    real = jobs.train_language_model
    monkeypatch.setattr(jobs, "train_language_model", train)
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("Cats chase mice.\n")
    cli.main(["language-model", "--input", str(source), "--save", str(tmp_path / "out"), "--dimensions", "7", "--mini_batch_size", "9"], spark)
    assert (given["dimensions"], given["mini_batch_size"], given["epochs"]) == (7, 9, 10)
    assert given.get("chunk_batches", CHUNK_BATCHES) == CHUNK_BATCHES and given["saved"] == str(tmp_path / "out")


def small_network(spark, size):
    """A network of six and five units whose softmax is away from zero."""
    params = lm.init_params(spark, size, 2, 6, 5, seed=1)
    draw = F.transform("vals", lambda x: x + 0.1 * F.sin(F.col("row") + 1.0))
    return materialize(params.withColumn("vals", F.when(F.col("layer") == 2, draw).otherwise(F.col("vals"))), "init")


@pytest.mark.parametrize("how", [dict(optimizer="adam", rate=0.01, lmbda=0.02), dict(optimizer="sgd", rate=0.5, learn_embeddings=False)])
def test_blocked_training_equals_dense_training(spark, lm_data, how):
    size, rows = lm_data
    few = materialize(rows.where("split <> 'train' and mb_id < 1 or split = 'train' and mb_id < 4").coalesce(1), "few")
    params = small_network(spark, size)
    dense, seen = lm.train_language_model(few, params, size, epochs=1, sync="gradient", steps_per_epoch=2, chunk_batches=2, **how)
    got, stats = blocked_training.train(few, params, size, epochs=1, steps_per_epoch=2, block_words=size // 2 + 1, **how)
    for a, b in zip(lm.load_weights(got), lm.load_weights(dense)):
        assert np.allclose(a, b, atol=1e-10)
    key = ["epoch", "split", "mb_id", "metric"]
    a, b = (t.toPandas().sort_values(key).reset_index(drop=True) for t in (stats, seen))
    assert len(a) == len(b) and np.allclose(a["value"], b["value"], rtol=1e-9)


def test_blocked_training_goes_on_from_a_saved_state(spark, lm_data, tmp_path):
    """One epoch and one more equal two, lazily caught-up rows among them, for another size of blocks."""
    size, rows = lm_data
    few = materialize(rows.where("split = 'train' and mb_id < 2").coalesce(1), "few")
    params, where = small_network(spark, size), str(tmp_path / "a")
    whole, _ = blocked_training.train(few, params, size, epochs=2, rate=0.01)
    blocked_training.train(few, params, size, epochs=1, rate=0.01, path_to_save=where)
    rest, stats = blocked_training.train(few, None, size, epochs=1, rate=0.01, resume=f"{where}/state-0", first_epoch=1, block_words=size // 2 + 1)
    for a, b in zip(lm.load_weights(rest), lm.load_weights(whole)):
        assert np.allclose(a, b, atol=1e-12)
    assert {r["epoch"] for r in stats.select("epoch").distinct().collect()} == {1}


def test_lazy_rows_catch_up_with_dense_ones():
    rng = np.random.default_rng(4)
    for rule in (blocked_training.Rule("adam", 0.05), blocked_training.Rule("adam", 0.05, 0.1), blocked_training.Rule("sgd", 0.05, 0.1)):
        dense = [rng.normal(size=(6, 3)), np.zeros((6, 3)), np.zeros((6, 3))]
        lazy, last = [a.copy() for a in dense], np.zeros(6, np.int64)
        for t in range(1, 12):
            g = np.zeros((6, 3))
            touched = rng.choice(6, 2, replace=False)
            g[touched] = rng.normal(size=(2, 3))
            rule.move(*dense, g + rule.lmbda * dense[0], t)
            parts = [a[touched] for a in lazy]
            rule.catch_up(*parts, last[touched], t - 1)
            rule.move(*parts, g[touched] + rule.lmbda * parts[0], t)
            for a, part in zip(lazy, parts):
                a[touched] = part
            last[touched] = t
        rule.catch_up(*lazy, last, 11)
        assert all(np.allclose(a, b, atol=1e-13) for a, b in zip(lazy, dense))


def test_best_words_are_found_without_sorting_all(monkeypatch):
    rng = np.random.default_rng(3)
    cells = rng.integers(0, 4, (50, 30)).astype(float)
    cells[0] = -np.inf
    cells[1, 3:] = -np.inf
    want = {k: np.argsort(-cells, axis=1, kind="stable")[:, :k] for k in (1, 2, 5, 30)}
    kept = cells.copy()
    for k, best in want.items():
        assert (lm._best(cells, k) == best).all() and (cells == kept).all()
    finite = cells[2:].copy()
    monkeypatch.setattr(np, "argsort", None)
    assert (lm._best(finite, 5) == want[5][2:]).all()


def test_sums_of_powers_hold_for_large_logits():
    cells = np.array([[1000.0, 999.0], [-900.0, -900.0]])
    want = np.exp(cells - cells.max(axis=1)[:, None]).sum(axis=1)
    assert np.allclose(lm._sum_exp(cells.copy(), cells.max(axis=1)), want, rtol=1e-14)
    small = np.array([[3.0, 2.0], [-500.0, -501.0]])
    want = np.exp(small - small.max(axis=1)[:, None]).sum(axis=1)
    assert np.allclose(lm._sum_exp(small.copy(), small.max(axis=1)), want, rtol=1e-13)


def test_lookups_leave_examples_in_place(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [int(rng.integers(9)) + 9 * j for j in range(3)], int(rng.integers(9))) for i in range(40)]
    examples = spark.createDataFrame([*rows, (40, [], 1), (41, [8, 17, 26], 1)], "ex_id int, x_idx array<bigint>, y int")
    vectors = spark.createDataFrame([(i, [i + 0.5, -1.0 * i], 3) for i in range(8)], "id int, vec array<double>, n bigint")
    params = materialize(lm.init_params(spark, 9, 3, 2, 4, seed=1), "lookup-params")

    def found():
        x = lm.embed_lookup(examples, vectors, 9, ["ex_id"])
        h = lm.hidden_vectors(examples, params, 9, ["ex_id"]).select("ex_id", "h")
        return x._jdf.queryExecution().executedPlan().toString(), *[dict(map(tuple, df.collect())) for df in (x, h)]

    plan, x, h = found()
    assert "Exchange" not in plan and 40 not in x and 41 not in x and 40 not in h
    monkeypatch.setattr(lm, "BROADCAST_BYTES", 0)
    plan, x_joined, h_joined = found()
    assert "Exchange" in plan and x == x_joined and set(h) == set(h_joined)
    assert all(np.allclose(h[i], h_joined[i], rtol=1e-14) for i in h)


def test_windows_hash_each_word_once(spark):
    schema = "doc_id int, line_no int, sent_no int, kept array<struct<pos: int, id: int>>"
    kept = spark.createDataFrame([(None, 0, 0, [(0, 3), (2, 4), (3, 3)]), (7, 1, 0, [(0, 1)])], schema)
    windows = word2vec.context_windows(kept, 2, seed=5, epoch=1)
    want = set()
    for pos, center in [(0, 3), (2, 4), (3, 3)]:
        # a key that is null leaves no part of the hashed text
        wide = int(hashlib.md5(f"5|window|1|0|0|{pos}".encode()).hexdigest()[:8], 16) % 2 + 1
        ctx = {0: [4, 3][:wide], 2: [3, 3], 3: [3, 4][-wide:]}[pos]
        want.add((None, pos, center, tuple(ctx)))
    assert {(r["doc_id"], r["pos"], r["center"], tuple(r["ctx"])) for r in windows.collect()} == want
    # it was hashed again for each use of the width, and once more by a filter on the windows
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_exploded_noise_is_drawn_once(spark, random_sents):
    vocab = materialize(vocabulary.vocabulary(vocabulary.token_counts(random_sents), 1), "vocab")
    schema = "doc_id int, line_no int, sent_no int, pos int, center int, ctx array<int>"
    windows = spark.createDataFrame([(1, 0, 0, 2, 3, [1, 2]), (None, 0, 0, 0, 0, [5])], schema)
    noise = word2vec.negative_samples(windows, vocab, 3, seed=4).select("doc_id", F.explode("noise").alias("id"))
    assert noise._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 3
    total, ends = 0, []
    for row in vocab.orderBy("id").collect():
        total += round(row["n"] ** 0.75 * 1000)
        ends.append(total)
    want = []
    for doc, place, word in [(1, "1|0|0|2|0", 1), (1, "1|0|0|2|1", 2), (None, "0|0|0|0", 5)]:
        for j in range(3):
            at = int(int(hashlib.md5(f"4|noise|{j}|0|{place}".encode()).hexdigest()[:8], 16) / 2**32 * total)
            drawn = sum(end <= at for end in ends)
            want += [(doc, drawn)] if drawn != word else []
    assert sorted(map(tuple, noise.collect()), key=str) == sorted(want, key=str)


def wide_network(spark, size, rng):
    """Two numbers a word, three hidden units, contexts of two words and a softmax of many words."""
    small = [(1, "w", i, rng.uniform(-1, 1, 3).tolist()) for i in range(4)] + [(1, "b", 0, rng.uniform(0, 1, 3).tolist())]
    words = [(0, "w", i, rng.uniform(0, 4, 2).tolist()) for i in range(size)]
    out = [(2, "w", i, rng.uniform(-0.5, 0.5, 3).tolist()) for i in range(size)]
    rows = words + small + out + [(2, "b", 0, rng.uniform(-0.5, 0.5, size).tolist())]
    return materialize(spark.createDataFrame(rows, lm.PARAMS), "wide")


def test_series_add_up_what_single_words_do():
    """Sums, and the best words with their ties, of a wide vocabulary; far and few examples, too."""
    rng = np.random.default_rng(3)
    w, b = np.round(rng.uniform(-0.5, 0.5, (6500, 3)), 2), np.round(rng.uniform(-0.5, 0.5, 6500), 1)
    h = np.maximum(rng.normal([3, 2, 0], [1, 2, 2], (3000, 3)), 0)
    h[:3] = [[0, 0, 0], [400, 0, 90], [0, 2000, 0]]
    logits = h @ w.T + b
    few = series.best_words(w, b, 3)
    assert len(few) < 1500 and series.pays(3, 6500) and not series.pays(16, 1 << 20)
    assert (few[series_best(logits[:, few], 3)] == series_best(logits, 3)).all()
    top, found = logits.max(axis=1), series.Series(w, b)
    whole = np.exp(logits - top[:, None]).sum(axis=1)
    for _ in range(2):
        assert np.allclose(found.sums(h, top), whole, rtol=1e-13, atol=0)
    assert len(found.slot) > 3 and 0 < (found.place(h) < 0).sum() < 1000


def series_best(logits, k):
    """The order of exact arithmetic: weights are hundredths here, so logits that should be equal are made so."""
    return np.argsort(-np.round(logits, 9), axis=1, kind="stable")[:, :k]


def test_scores_of_a_wide_vocabulary_take_no_power_per_word(spark, monkeypatch):
    size, rng, asked = 6500, np.random.default_rng(5), []
    params = wide_network(spark, size, rng)
    rows = [(i, [int(rng.integers(size)), size + int(rng.integers(size))], int(rng.integers(size))) for i in range(1500)]
    examples = materialize(spark.createDataFrame(rows, "i int, x_idx array<int>, y int"), "ex")
    found, best_words = [], series.best_words
    monkeypatch.setattr(series, "best_words", lambda *how: asked.append(1) or best_words(*how))
    for block in (3000, None):
        scored = lm.score(examples, params, size, ["i"], block).orderBy("i").toPandas()
        top = lm.predict_topk(examples, params, size, ["i"], 3, block).orderBy("i", "rank").toPandas()
        found.append((scored, top))
        assert len(asked) == (0 if block else 2)
    (a, at), (b, bt) = found
    assert len(a) == 1500 and list(a.columns) == list(b.columns) and list(at.columns) == list(bt.columns)
    assert (a["y_hat"] == b["y_hat"]).all() and np.allclose(a["p_y"], b["p_y"], rtol=1e-12)
    assert (at["word_id"] == bt["word_id"]).all() and np.allclose(at["p"], bt["p"], rtol=1e-12)


def test_a_step_on_a_wide_vocabulary_equals_the_step_by_blocks(spark, monkeypatch):
    size, rng, asked = 6500, np.random.default_rng(8), []
    params = wide_network(spark, size, rng)
    rows = [(i % 9, [int(rng.integers(size)), size + int(rng.integers(size))], int(rng.integers(size))) for i in range(1500)]
    examples = materialize(spark.createDataFrame(rows, "mb_id int, x_idx array<int>, y int").coalesce(1), "ex")
    gradients, found = series.best_words, []
    monkeypatch.setattr(series, "best_words", lambda *how: asked.append(1) or gradients(*how))
    for words in (3000, None):
        state, stats = blocked_training.step(examples, blocked_training.start(params), size, blocked_training.Rule("sgd", 100.0), block_words=words)
        found.append((lm.load_weights(blocked_training.params_of(state)), stats.toPandas().sort_values("mb_id")))
        assert len(asked) == (0 if words else 1)
    for a, b in zip(found[0][0], found[1][0]):
        assert np.allclose(a, b, atol=1e-11, rtol=1e-9)
    for c in ("mb_id", "cost", "accuracy"):
        assert np.allclose(found[0][1][c], found[1][1][c], rtol=1e-9)


def test_a_small_softmax_is_gone_through_once(spark, lm_data, monkeypatch):
    """The step from one pass equals the step by blocks, for large logits, too, and asks for no second pass."""
    size, rows = lm_data
    flat = rows.where("split = 'train' and mb_id < 3").select("mb_id", "x_idx", F.posexplode("y").alias("i", "y"))
    examples = materialize(flat.select("mb_id", F.slice("x_idx", F.col("i") * 2 + 1, 2).alias("x_idx"), "y"), "ex")
    for scale in (1.0, 900.0):
        params = small_network(spark, size)
        far = F.when(F.col("layer") == 2, F.transform("vals", lambda x: x * scale)).otherwise(F.col("vals"))
        params = materialize(params.withColumn("vals", far), "far")
        rule, found = blocked_training.Rule("sgd", 1.0), []
        for words in (size // 3, None):
            with monkeypatch.context() as patch:
                if words is None:
                    patch.setattr(lm, "_softmax", None)
                state, stats = blocked_training.step(examples, blocked_training.start(params), size, rule, block_words=words)
            found.append((lm.load_weights(blocked_training.params_of(state)), stats.toPandas().sort_values("mb_id")))
        for a, b in zip(found[0][0], found[1][0]):
            assert np.allclose(a, b, atol=1e-11, rtol=1e-9)
        for c in ("mb_id", "cost", "accuracy"):
            assert np.allclose(found[0][1][c], found[1][1][c], rtol=1e-9)


def test_gradients_are_added_up_without_probabilities(monkeypatch):
    """Blocks of words give the dense gradient, near the range of a double, too, and add to what is there."""
    monkeypatch.setattr(lm, "TILE_CELLS", 16)
    monkeypatch.setattr(lm, "STEP_CELLS", 5)
    rng = np.random.default_rng(3)
    for scale in (1.0, 2000.0):
        w = [rng.normal(size=s) for s in ((7, 3), (6, 4), (4,), (7, 4), (7,))]
        w[3] *= scale
        words, y = rng.integers(0, 7, (5, 2)), rng.integers(0, 7, 5)
        y[0] = lm._forward(w, words)[3][0].argmax()
        x, z, h, p = lm._forward(w, words)
        d = (p - np.eye(7)[y]) / 5
        back = (d @ w[3]) * (z > 0)
        into = [np.ones_like(a) for a in w]
        with np.errstate(divide="ignore"):
            cost, accuracy, got = lm._gradients(w, words, y, 0.0, into, np.empty(99))
            assert cost == pytest.approx(-np.log(p[np.arange(5), y]).mean())
        assert accuracy == (p.argmax(axis=1) == y).mean()
        for a, b in zip(got[1:], (x.T @ back, back.sum(0), d.T @ h, d.sum(0))):
            assert np.allclose(a - 1, b, atol=1e-9 * scale)
    dense = [rng.normal(size=(4, 3)), np.zeros((4, 3)), np.zeros((4, 3))]
    parts, g = [a.copy() for a in dense], rng.normal(size=(4, 3))
    lm.adam_step(*dense, g, 3, 0.1)
    lm._adam_in_cache(*parts, g, 3, 0.1)
    assert all((a == b).all() for a, b in zip(parts, dense))
