"""The registered queries: each takes ``(spark, sf_dir)`` and reads the whole tables it names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions import vectors as vec
from wordloom.functions.hashing import hash_uniform
from wordloom.functions.text import regex_preprocessor
from wordloom.operators import blocked_training, clustering, contexts, corpus, decomposition, encoding
from wordloom.operators import cooccurrence as cooc
from wordloom.operators import language_model as lm
from wordloom.operators import phrases, segmentation, similarity, termdoc, vocabulary, word2vec
from wordloom.operators.joins import skew_safe_join
from wordloom.plans.models import TermDocumentModel, WordWordModel
from wordloom.plans.settings import (
    BATCH, CONTEXT, COOC_MIN_COUNT, FILE_BATCHES, LM_MIN_COUNT, NEGATIVE, SAMPLE, SEED, SMOOTHING, SVD_K,
    TOP_N, W2V_CHUNK_WORDS, W2V_EPOCHS, W2V_MIN_COUNT, W2V_WINDOW, WINDOW,
)
from wordloom.sources.saved import preprocessor_settings, save_tables, load_tables
from wordloom.sources.scratch import materialize, scratch_path
from wordloom.sources.tables import documents_table

Query = Callable[[SparkSession, str], DataFrame]
KEY = corpus.SENTENCE_KEY
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(name: str, digits: int = 6):
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents_table(spark, f"{sf}/documents.parquet")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.read_lines(_documents(spark, sf))


def _sents(spark: SparkSession, sf: str, mode: str = "treebank") -> DataFrame:
    return corpus.sentences(_lines(spark, sf), mode)


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences as a written table, for queries that pass over the corpus more than once."""
    return materialize(_sents(spark, sf), "sentences")


def _vocab(sents: DataFrame, min_count: int = COOC_MIN_COUNT) -> DataFrame:
    return vocabulary.vocabulary(vocabulary.token_counts(sents), min_count)


def _sentence_text(sents: DataFrame) -> DataFrame:
    return sents.select(*KEY, F.array_join("toks", " ").alias("sentence"))


# ---- sources and text


@query
def read_lines(spark, sf):
    return _lines(spark, sf)


@query
def document_index(spark, sf):
    return corpus.document_index(spark.read.parquet(f"{sf}/documents.parquet"))


@query
def shuffled_document_order(spark, sf):
    return corpus.shuffled_document_order(document_index(spark, sf), SEED)


@query
def corpus_split(spark, sf):
    return corpus.split_lines(_lines(spark, sf), seed=SEED).drop("line")


@query
def corpus_split_counts(spark, sf):
    return corpus_split(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@query
def sentence_model(spark, sf):
    model = segmentation.train(_lines(spark, sf))
    return segmentation.scores(model).select("kind", "typ", "next", "n", rounded("score"))


@query
def sentences_trained(spark, sf):
    lines = _lines(spark, sf)
    return segmentation.sentences_of(lines, segmentation.train(lines))


@query
def sentences(spark, sf):
    return _sentence_text(_sents(spark, sf))


@query
def tokens(spark, sf):
    return corpus.tokens(_sents(spark, sf, "whitespace"))


@query
def tokens_treebank(spark, sf):
    return corpus.tokens(_sents(spark, sf))


@query
def clean_tokens(spark, sf):
    keep_digits = regex_preprocessor(r"[^\p{IsAlphabetic}0-9 ]")
    return corpus.tokens(corpus.sentences(_lines(spark, sf), "whitespace", keep_digits))


# ---- vocabulary


@query
def token_counts(spark, sf):
    return vocabulary.token_counts(_sents(spark, sf))


@query
def vocab_min_count(spark, sf):
    return vocabulary.at_least(token_counts(spark, sf), COOC_MIN_COUNT)


@query
def vocabulary_ids(spark, sf):
    return _vocab(_sents(spark, sf))


QUERIES["vocabulary"] = QUERIES.pop("vocabulary_ids")


@query
def vocab_roundtrip(spark, sf):
    path = scratch_path(spark, "vocab-model")
    settings = {"kind": "vocabulary", "min_count": COOC_MIN_COUNT, "preprocessor": preprocessor_settings()}
    save_tables(spark, path, {"vocab": _vocab(_sents(spark, sf))}, settings)
    return load_tables(spark, path)[0]["vocab"]


@query
def vocab_size(spark, sf):
    return vocabulary.vocabulary_size(_vocab(_sents(spark, sf)))


@query
def encode_tokens(spark, sf):
    sents = _prepared(spark, sf)
    coded = encoding.encode_sentences(sents, _vocab(sents)).drop("toks")
    return corpus.tokens(coded, "ids", "id").where(F.col("id").isNotNull())


@query
def in_vocab_tokens(spark, sf):
    sents = _prepared(spark, sf)
    return vocabulary.in_vocabulary(corpus.tokens(sents), _vocab(sents)).select(*KEY, "pos", "tok")


@query
def oov_tokens(spark, sf):
    counts = materialize(token_counts(spark, sf), "counts")
    return vocabulary.out_of_vocabulary(counts, vocabulary.vocabulary(counts, COOC_MIN_COUNT))


# ---- phrases


@query
def bigram_counts(spark, sf):
    return phrases.bigram_counts(_sents(spark, sf))


@query
def phrase_scores(spark, sf):
    return phrases.phrase_scores(_prepared(spark, sf)).select("a", "b", rounded("score"))


@query
def apply_phrases(spark, sf):
    sents = _prepared(spark, sf)
    return _sentence_text(phrases.phrased(sents, phrases.learn_phrases(sents, 1)))


@query
def phrases_two_pass(spark, sf):
    sents = _prepared(spark, sf)
    return _sentence_text(phrases.phrased(sents, phrases.learn_phrases(sents, 2)))


# ---- contexts and examples


def _pairs(spark, sf, min_count, before, after):
    sents = _prepared(spark, sf)
    coded = encoding.encode_sentences(sents, _vocab(sents, min_count))
    return contexts.target_context_pairs(coded, before, after)


def _pair_text(pairs: DataFrame) -> DataFrame:
    return pairs.select(*KEY, "pos", "target", F.array_join("ctx", " ").alias("ctx"))


@query
def target_context_pairs(spark, sf):
    return _pair_text(_pairs(spark, sf, COOC_MIN_COUNT, 2, 2))


@query
def lm_contexts(spark, sf):
    return _pair_text(_pairs(spark, sf, LM_MIN_COUNT, CONTEXT, 0))


@query
def lm_examples(spark, sf):
    return _pair_text(_pairs(spark, sf, LM_MIN_COUNT, CONTEXT, 0).where(F.size("ctx") == CONTEXT))


def _examples(spark, sf) -> tuple[DataFrame, DataFrame]:
    lines = corpus.split_lines(_lines(spark, sf), seed=SEED)
    sents = materialize(corpus.sentences(lines), "sentences")
    vocab = _vocab(sents, LM_MIN_COUNT)
    coded = encoding.encode_sentences(sents, vocab)
    return vocab, contexts.lm_examples(coded, vocab.count(), CONTEXT, "split")


def _batched(spark, sf) -> tuple[DataFrame, DataFrame]:
    vocab, examples = _examples(spark, sf)
    return vocab, contexts.minibatches(contexts.fixed(examples), BATCH, FILE_BATCHES, "split")


@query
def lm_examples_encoded(spark, sf):
    return _examples(spark, sf)[1].select("split", "ex_id", F.array_join("x_idx", ",").alias("x_idx"), "y")


@query
def examples_decoded(spark, sf):
    """Examples written to disk, read back and expanded to one word per context slot."""
    vocab, examples = _examples(spark, sf)
    return contexts.one_hot_positions(contexts.fixed(examples), vocab.count(), ["split", "ex_id"])


@query
def minibatches(spark, sf):
    batched = _batched(spark, sf)[1]
    return batched.select("split", "ex_id", "mb_id", "file_ix", F.array_join("x_idx", ",").alias("x_idx"), "y")


@query
def minibatch_shuffled(spark, sf):
    mixed = contexts.shuffle_in_batch(_batched(spark, sf)[1], SEED, "split")
    return mixed.select("split", "mb_id", "ex_id", "slot")


@query
def minibatch_files(spark, sf):
    return contexts.shuffle_in_file(_batched(spark, sf)[1], SEED, "split")


# ---- term-document matrix


def _term_doc(spark, sf) -> TermDocumentModel:
    sents = _prepared(spark, sf)
    vocab = _vocab(sents)
    index = document_index(spark, sf)
    td = materialize(termdoc.term_document_counts(sents, vocab, index), "td")
    settings = {"kind": "term_document", "weighting": "count", "min_count": COOC_MIN_COUNT}
    return TermDocumentModel(vocab, index, td, settings)


def _tenth_word(vocab: DataFrame) -> str:
    return vocab.where(F.col("id") == 10).first()["tok"]


def _first_document(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").agg(F.min("doc_id")).first()[0]


@query
def term_document_counts(spark, sf):
    return _term_doc(spark, sf).td


@query
def model_roundtrip_term_document(spark, sf):
    path = scratch_path(spark, "td-model")
    _term_doc(spark, sf).save(path)
    model = TermDocumentModel.load(spark, path)
    words = model.td.join(model.vocab, "id").join(model.doc_index, "doc_ix")
    return words.select("tok", "doc_id", "value")


@query
def term_vector(spark, sf):
    model = _term_doc(spark, sf)
    return model.word_vector(_tenth_word(model.vocab))


@query
def document_vector(spark, sf):
    return _term_doc(spark, sf).document_vector(_first_document(spark, sf))


@query
def item_vector(spark, sf):
    """One lookup that finds a word and one that falls through to a document."""
    model = _term_doc(spark, sf)
    return model[_tenth_word(model.vocab)].unionByName(model[_first_document(spark, sf)])


@query
def log_tf(spark, sf):
    value = F.round(termdoc.log_term_frequency(F.col("value")), 6).alias("value")
    return _term_doc(spark, sf).td.select("id", "doc_ix", value)


@query
def idf(spark, sf):
    model = _term_doc(spark, sf)
    found = termdoc.inverse_document_frequency(model.td, model.doc_index.count())
    return found.select("id", "df", rounded("idf"))


@query
def tfidf(spark, sf):
    model = _term_doc(spark, sf)
    return termdoc.tf_idf(model.td, model.doc_index.count()).select("id", "doc_ix", rounded("value"))


@query
def most_similar_tfidf(spark, sf):
    model = _term_doc(spark, sf).tf_idf()
    best = model.most_similar(_tenth_word(model.vocab), TOP_N)
    return best.select("word", "neighbor", rounded("similarity"), "rank")


def top_terms(documents: DataFrame, min_count: int, n: int = TOP_N) -> DataFrame:
    """The ``n`` heaviest TF-IDF words of every document."""
    sents = materialize(corpus.sentences(corpus.read_lines(documents)), "sentences")
    vocab = _vocab(sents, min_count)
    index = corpus.document_index(documents)
    td = materialize(termdoc.term_document_counts(sents, vocab, index), "td")
    weighted = termdoc.tf_idf(td, index.count()).select("id", "doc_ix", rounded("value"))
    best = Window.partitionBy("doc_ix").orderBy(F.col("value").desc(), "id")
    ranked = weighted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    named = ranked.join(vocab.select("id", "tok"), "id").join(index, "doc_ix")
    return named.select("doc_id", "tok", "value", "rank")


@query
def top_terms_per_document(spark, sf):
    return top_terms(_documents(spark, sf), COOC_MIN_COUNT)


# ---- word-word matrix


def _word_word(spark, sf) -> WordWordModel:
    sents = _prepared(spark, sf)
    vocab = _vocab(sents)
    cells = materialize(cooc.cooccurrence(sents, vocab, WINDOW), "cooc")
    settings = {"kind": "word_word", "weighting": "count", "window": WINDOW, "min_count": COOC_MIN_COUNT}
    return WordWordModel(vocab, cells, settings)


@query
def cooccurrence(spark, sf):
    sents = _prepared(spark, sf)
    return cooc.cooccurrence(sents, _vocab(sents), WINDOW)


@query
def model_roundtrip_word_word(spark, sf):
    path = scratch_path(spark, "ww-model")
    _word_word(spark, sf).save(path)
    model = WordWordModel.load(spark, path)
    row = model.vocab.select(F.col("id").alias("row"), F.col("tok").alias("word"), F.col("n").alias("row_n"))
    col = model.vocab.select(F.col("id").alias("col"), F.col("tok").alias("context"), F.col("n").alias("col_n"))
    named = skew_safe_join(skew_safe_join(model.cells, row, "row", "row_n"), col, "col", "col_n")
    return named.select("word", "context", "value")


@query
def context_vector(spark, sf):
    model = _word_word(spark, sf)
    return model[_tenth_word(model.vocab)]


@query
def cooc_marginals(spark, sf):
    return cooc.row_probabilities(_word_word(spark, sf).cells).select("row", "total", rounded("p", 9))


@query
def context_distribution(spark, sf):
    found = cooc.context_distribution(_word_word(spark, sf).cells, SMOOTHING)
    return found.select("col", "total", rounded("p", 9))


def _ppmi_cells(spark, sf, smoothing):
    cells = cooc.ppmi(_word_word(spark, sf).cells, smoothing).select("row", "col", rounded("value"))
    return cells.where(F.col("value") > 0)


@query
def ppmi(spark, sf):
    return _ppmi_cells(spark, sf, 1.0)


@query
def ppmi_smoothed(spark, sf):
    return _ppmi_cells(spark, sf, SMOOTHING)


@query
def most_similar_ppmi(spark, sf):
    model = _word_word(spark, sf).ppmi()
    best = model.most_similar(_tenth_word(model.vocab), TOP_N)
    return best.select("word", "neighbor", rounded("similarity"), "rank")


@query
def most_similar_sparse_dot(spark, sf):
    model = _word_word(spark, sf).ppmi()
    best = model.most_similar(_tenth_word(model.vocab), TOP_N, "dot")
    return best.select("word", "neighbor", rounded("similarity"), "rank")


def _svd(spark, sf):
    model = _word_word(spark, sf).ppmi()
    return decomposition.svd_truncate(model.cells, model.vocab.count(), SVD_K)


@query
def svd_vectors(spark, sf):
    dims = F.posexplode("vec").alias("dim", "value")
    return _svd(spark, sf)[0].select("id", dims).select("id", "dim", rounded("value"))


@query
def svd_rows(spark, sf):
    """Every word of the vocabulary has a row of all dimensions, of zeros if its matrix row is empty."""
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    return _svd(spark, sf)[0].select("id", F.size("vec").alias("dims"), (squares == 0.0).alias("is_zero"))


@query
def svd_singular_values(spark, sf):
    sigma = _svd(spark, sf)[1]
    return spark.createDataFrame([(i, round(s, 6)) for i, s in enumerate(sigma)], "dim int, sigma double")


@query
def svd_residual(spark, sf):
    """How far ``A A' u`` is from ``sigma^2 u``, relative to the largest ``sigma^2``."""
    model = _word_word(spark, sf).ppmi()
    u, sigma = decomposition.svd_truncate(model.cells, model.vocab.count(), SVD_K)
    found = decomposition.residuals(model.cells, u, sigma)
    return found.select("dim", rounded("residual"))


@query
def svd_orthonormality(spark, sf):
    return decomposition.gram(_svd(spark, sf)[0]).select("i", "j", rounded("value"))


# ---- vectors


def _vectors(spark, sf) -> DataFrame:
    found = spark.read.parquet(f"{sf}/embeddings.parquet")
    return found.select(
        F.col("vec_id").cast("int").alias("id"),
        F.col("vec_id").cast("string").alias("tok"),
        F.col("embedding").cast("array<double>").alias("vec"),
        "label",
    )


def _label_heads(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("label").agg(F.min_by("tok", "id").alias("tok"))


def _neighbors(found: DataFrame) -> DataFrame:
    return found.select("word", "neighbor", rounded("similarity"), "rank")


@query
def cosine_pairs(spark, sf):
    vectors = _vectors(spark, sf)
    means = materialize(clustering.group_means(vectors, "label"), "means")
    means = means.withColumnRenamed("vec", "mean")
    pairs = similarity.cosine_pairs(skew_safe_join(vectors, means, "label", "n"), "vec", "mean")
    return pairs.select("id", rounded("similarity"))


def _first_vector(vectors: DataFrame) -> str:
    return vectors.agg(F.min_by("tok", "id")).first()[0]


@query
def most_similar_dense(spark, sf):
    vectors = _vectors(spark, sf)
    return _neighbors(similarity.most_similar(vectors, _first_vector(vectors), TOP_N))


@query
def most_similar_euclidean(spark, sf):
    vectors = _vectors(spark, sf)
    probe = _first_vector(vectors)
    return _neighbors(similarity.most_similar(vectors, probe, TOP_N, vec.negative_euclidean))


@query
def most_similar_batch(spark, sf):
    vectors = _vectors(spark, sf)
    return _neighbors(similarity.most_similar_batch(vectors, _label_heads(vectors), TOP_N))


@query
def vectors_for_words(spark, sf):
    vectors = _vectors(spark, sf)
    found = similarity.vectors_for_words(vectors, _label_heads(vectors))
    total = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x).alias("total")
    return found.select("id", "tok", F.size("vec").alias("dims"), total).withColumn("total", rounded("total"))


@query
def pca_2d(spark, sf):
    found = decomposition.pca(_vectors(spark, sf))
    return found.select("id", F.round(F.col("coords")[0], 6).alias("x"), F.round(F.col("coords")[1], 6).alias("y"))


@query
def pca_variance(spark, sf):
    vectors = _vectors(spark, sf)
    x, y = F.col("coords")[0], F.col("coords")[1]
    total = sum(clustering.dimension_variance(vectors))
    zero = F.lit(0.0)
    return decomposition.pca(vectors).agg(
        F.count("*").alias("n_vectors"),
        (F.round(F.avg(x), 6) + zero).alias("mean_1"),
        (F.round(F.avg(y), 6) + zero).alias("mean_2"),
        (F.round(F.covar_samp(x, y), 6) + zero).alias("covariance"),
        (F.var_samp(x) >= F.var_samp(y)).alias("in_order"),
        (F.var_samp(x) + F.var_samp(y) <= F.lit(total * (1 + 1e-9))).alias("within_total"),
    )


def _label_means(spark, sf) -> DataFrame:
    means = clustering.group_means(_vectors(spark, sf), "label")
    return materialize(means.select(F.col("label").cast("bigint").alias("id"), "vec"), "means")


@query
def seuclidean_distances(spark, sf):
    found = clustering.seuclidean_distances(_label_means(spark, sf))
    return found.select("a", "b", rounded("distance"))


@query
def complete_linkage(spark, sf):
    merges = clustering.complete_linkage(clustering.seuclidean_distances(_label_means(spark, sf)))
    return merges.select("a", "b", rounded("height"), "size")


@query
def complete_linkage_top(spark, sf):
    return complete_linkage(spark, sf).agg(
        F.count("*").alias("merges"),
        F.max("size").alias("root_size"),
        F.max("height").alias("root_height"),
    )


@query
def word_group_cohesion(spark, sf):
    found = clustering.group_cohesion(_vectors(spark, sf), "label")
    return found.select("label", "n", rounded("within"), rounded("between"))


# ---- word2vec


@query
def w2v_vocab(spark, sf):
    sents = _prepared(spark, sf)
    return _vocab(phrases.phrased(sents, phrases.learn_phrases(sents, 1)), W2V_MIN_COUNT)


def _thinned(spark, sf) -> tuple[DataFrame, DataFrame]:
    sents = _prepared(spark, sf)
    vocab = _vocab(sents, W2V_MIN_COUNT)
    return vocab, word2vec.subsample(sents, vocab, SAMPLE, SEED)


def _windows(spark, sf) -> tuple[DataFrame, DataFrame]:
    vocab, kept = _thinned(spark, sf)
    return vocab, word2vec.context_windows(kept, W2V_WINDOW, SEED)


@query
def w2v_subsample(spark, sf):
    return _thinned(spark, sf)[1].select(*KEY, F.inline("kept"))


@query
def skipgram_pairs(spark, sf):
    return word2vec.skipgram_pairs(_windows(spark, sf)[1])


@query
def negative_distribution(spark, sf):
    vocab = _vocab(_sents(spark, sf), W2V_MIN_COUNT)
    return word2vec.negative_distribution(vocab).select("id", rounded("p", 9))


@query
def negative_samples(spark, sf):
    """How often each word is drawn as noise over all pairs."""
    vocab, windows = _windows(spark, sf)
    drawn = word2vec.negative_samples(windows, vocab, NEGATIVE, SEED)
    return drawn.select(F.explode("noise").alias("id")).groupBy("id").agg(F.count("*").alias("drawn"))


def _trained(spark, sf, algorithm):
    sents = _prepared(spark, sf)
    vectors, _ = word2vec.train_word2vec(
        sents, _vocab(sents, W2V_MIN_COUNT), algorithm, vector_size=100, epochs=W2V_EPOCHS, seed=SEED
    )
    return vectors.select("id", "tok", F.round(vec.norm(F.col("vec")), 6).alias("norm"))


@query
def w2v_skipgram(spark, sf):
    return _trained(spark, sf, "skip-gram")


@query
def w2v_cbow(spark, sf):
    return _trained(spark, sf, "cbow")


def _first_step(spark, sf, skipgram):
    """Output vectors after one step over all examples of each chunk, averaged over chunks.

    They start at zero, so every gap is one half and the step is plain arithmetic.
    """
    sents = _prepared(spark, sf)
    vocab = _vocab(sents, W2V_MIN_COUNT)
    weights = materialize(word2vec.start_weights(vocab, 2, SEED), "w2v-weights")
    after, _ = word2vec.epoch_of(
        sents, vocab, weights, skipgram, W2V_WINDOW, NEGATIVE, SAMPLE, SEED, 0, 1, W2V_CHUNK_WORDS, step_examples=1 << 60
    )
    return after.where("side = 1").select(
        "id", F.round(F.col("vec")[0], 6).alias("x0"), F.round(F.col("vec")[1], 6).alias("x1")
    )


@query
def w2v_skipgram_step(spark, sf):
    return _first_step(spark, sf, True)


@query
def w2v_cbow_step(spark, sf):
    return _first_step(spark, sf, False)


# ---- language model


def _network(spark, size, vectors=None, dim=16, hidden=16):
    params = lm.init_params(spark, size, CONTEXT, dim, hidden, SEED, vectors)
    return materialize(params, "lm-init")


@query
def lm_embed_lookup(spark, sf):
    """Concatenated context vectors, with (log count, length) as each word's vector."""
    vocab, examples = _examples(spark, sf)
    pair = F.array(F.ln("n"), F.length("tok").cast("double"))
    vectors = vocab.select("id", pair.alias("vec"), "n")
    found = lm.embed_lookup(examples, vectors, vocab.count(), ["split", "ex_id"])
    x = F.transform("x", lambda v: F.round(v, 6))
    return found.select("split", "ex_id", *[x[i].alias(f"x{i}") for i in range(2 * CONTEXT)])


def _hash_network(spark, vocab) -> DataFrame:
    """A network that SQL can follow: (log count, length) per word, three hidden units, all else drawn by hash."""

    def drawn(name, n, *keys):
        return F.array(*[hash_uniform(SEED, F.lit(name), *keys, F.lit(j)) - 0.5 for j in range(n)])

    def table(rows, layer, name, row, vals):
        return rows.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), row.cast("int").alias("row"), vals.alias("vals"))

    words, units = vocab.select("id", "tok", "n"), spark.range(2 * CONTEXT)
    bias = vocab.agg(F.array_sort(F.collect_list(F.struct("id", drawn("b2", 1, F.col("id"))[0].alias("b")))).alias("b"))
    parts = [
        table(words, 0, "w", F.col("id"), F.array(F.ln("n"), F.length("tok").cast("double"))),
        table(units, 1, "w", F.col("id"), drawn("w1", 3, F.col("id"))),
        table(spark.range(1), 1, "b", F.lit(0), drawn("b1", 3)),
        table(words, 2, "w", F.col("id"), drawn("w2", 3, F.col("id"))),
        table(bias, 2, "b", F.lit(0), F.transform("b", lambda x: x["b"])),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialize(out, "lm-hash")


def _hash_scores(spark, sf) -> DataFrame:
    vocab, batched = _batched(spark, sf)
    return lm.score(batched, _hash_network(spark, vocab), vocab.count(), ["split", "mb_id", "ex_id"])


@query
def lm_score(spark, sf):
    return _hash_scores(spark, sf).select("split", "ex_id", "y", "y_hat", rounded("p_y", 9))


@query
def lm_cost(spark, sf):
    per_batch = lm.cost_and_accuracy(_hash_scores(spark, sf), ["split", "mb_id"])
    return per_batch.agg(F.round(F.avg("cost"), 6).alias("cost"))


@query
def lm_accuracy(spark, sf):
    per_batch = lm.cost_and_accuracy(_hash_scores(spark, sf), ["split", "mb_id"])
    return per_batch.groupBy("split").agg(F.round(F.avg("accuracy"), 6).alias("accuracy"))


@query
def l2_norm(spark, sf):
    """The penalty of a network whose embedding holds (log count, length) per word."""
    vocab = _vocab(_sents(spark, sf), LM_MIN_COUNT)
    pair = F.array(F.ln("n"), F.length("tok").cast("double"))
    params = vocab.select(
        F.lit(0).alias("layer"), F.lit("w").alias("name"), F.col("id").alias("row"), pair.alias("vals")
    )
    return lm.l2_norm(params, 0.01).select(rounded("penalty"))


def _lm_rows(spark, sf):
    vocab, batched = _batched(spark, sf)
    batched = contexts.fixed(batched)
    slots = contexts.shuffle_in_file(batched, SEED, "split")
    rows = lm.batch_rows(contexts.shuffle_in_batch(batched, SEED, "split"), slots)
    return vocab.count(), materialize(rows, "minibatches")


def _lm_trained(spark, sf, **how):
    size, rows = _lm_rows(spark, sf)
    return size, lm.train_language_model(rows, _network(spark, size), size, epochs=1, **how)


def _stats(stats: DataFrame) -> DataFrame:
    return stats.select("epoch", "mb_id", "split", "metric", rounded("value"))


@query
def lm_train(spark, sf):
    return _stats(_lm_trained(spark, sf)[1][1])


@query
def lm_train_sgd(spark, sf):
    return _stats(_lm_trained(spark, sf, optimizer="sgd", rate=0.1, sync="gradient", steps_per_epoch=4)[1][1])


def _first_lm_step(spark, sf, optimizer, rate):
    """All weights after one step of the whole training split on the network drawn by hash."""
    vocab, batched = _batched(spark, sf)
    examples = materialize(batched.where("split = 'train'").select("mb_id", "x_idx", "y"), "lm-train")
    state = blocked_training.start(_hash_network(spark, vocab))
    state, _ = blocked_training.step(examples, state, vocab.count(), blocked_training.Rule(optimizer, rate))
    each = blocked_training.params_of(state).select("layer", "name", "row", F.posexplode("vals").alias("unit", "value"))
    return each.select("layer", "name", "row", "unit", rounded("value"))


@query
def lm_sgd_step(spark, sf):
    """The rate is large so that every word's move shows."""
    return _first_lm_step(spark, sf, "sgd", 100.0)


@query
def lm_adam_step(spark, sf):
    return _first_lm_step(spark, sf, "adam", 0.001)


@query
def lm_predict_topk(spark, sf):
    """The three likeliest next words of every context."""
    vocab, examples = _examples(spark, sf)
    top = lm.predict_topk(examples, _hash_network(spark, vocab), vocab.count(), ["split", "ex_id"], 3)
    return top.select("split", "ex_id", "rank", "word_id", rounded("p", 9))


@query
def lm_init_from_vectors(spark, sf):
    """Initial parameters started from (log count, length) vectors; the random layer left out."""
    vocab = _vocab(_sents(spark, sf), LM_MIN_COUNT)
    pair = F.array(F.ln("n"), F.length("tok").cast("double"))
    vectors = vocab.select("id", pair.alias("vec"))
    params = lm.init_params(spark, vocab.count(), CONTEXT, 2, 16, SEED, vectors)
    total = F.aggregate("vals", F.lit(0.0), lambda acc, x: acc + x)
    return params.where("layer <> 1").select(
        "layer", "name", "row", F.size("vals").alias("width"), F.round(total, 6).alias("total")
    )
