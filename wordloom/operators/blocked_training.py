"""Training the next-word model on weight tables, for vocabularies whose weights fit no single machine.

One step follows the mean gradient over a share of the mini-batches.  A softmax of up to ``SOFTMAX_BYTES`` is gone
through once: a task that sees all logits of an example knows their sum before it needs it, and divides small sums by it
instead of every probability; with few units for its words, sums and gradients come from series (``series.Gradients``).  A larger one is gone through twice in blocks of
words: first for each example's largest logit and sum, then, with those known, for the gradients, so no
task holds more than one block.  The hidden layer's input is a sum of one vector per slot and word; its gradient
goes back the same way, summed per slot and word before it meets the embedding.  Words that no context of the share holds get
no gradient: their rows carry the number of the last step they were brought up to, and the decay of the steps
between is made up for, step by step, when they are next used.  The outcome is that of the dense update.

The driver holds the hidden layer only, whose size follows the layer widths.  Each step writes its tables anew and deletes those of
the step before; after each epoch weights, moments and step number can be kept, to go on from later.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.arrays import stack_vectors, vector_list
from wordloom.operators import language_model as lm
from wordloom.operators import series
from wordloom.sources.scratch import materialize, release

ROWS = "row int, theta array<double>, m array<double>, v array<double>, last bigint"
SUMS = "kind int, id bigint, vec array<double>"
SEEN = f"{SUMS}, y int, y_hat int, p_y double"
_NAMES = ["row", "theta", "m", "v", "last"]
# Examples whose probabilities over one block a task holds at once.
BLOCK_CELLS = lm.SCORE_CELLS
# Weights of a softmax that a task holds whole, with a few sums of the same size.
SOFTMAX_BYTES = 16 << 20


class Rule(NamedTuple):
    """How weights follow their gradients."""

    optimizer: str = "adam"
    rate: float = 0.001
    lmbda: float = 0.0

    def move(self, theta: np.ndarray, m: np.ndarray, v: np.ndarray, g: np.ndarray, t: int) -> None:
        if self.optimizer == "adam":
            lm.adam_step(theta, m, v, g, t, self.rate)
        else:
            lm.sgd_step(theta, g, self.rate)

    def catch_up(self, theta: np.ndarray, m: np.ndarray, v: np.ndarray, last: np.ndarray, to: int) -> None:
        """Make the steps after ``last`` up to ``to`` on rows that had no gradient but the penalty's."""
        if self.optimizer == "sgd" and not self.lmbda:
            return
        for t in range(int(last.min(initial=to)) + 1, to + 1):
            late = np.flatnonzero(last < t)
            parts = [a[late] for a in (theta, m, v)]
            self.move(*parts, self.lmbda * parts[0], t)
            for a, part in zip((theta, m, v), parts):
                a[late] = part


class State(NamedTuple):
    """``words`` and ``softmax`` hold ROWS; a softmax row ends with its word's bias.  ``hidden``: matrix and bias with their moments."""

    words: DataFrame
    softmax: DataFrame
    hidden: list[list[np.ndarray]]
    t: int


def _batch(row, theta, m, v, last) -> pa.RecordBatch:
    cells = [pa.array(row, pa.int32()), vector_list(theta), vector_list(m), vector_list(v), pa.array(last, pa.int64())]
    return pa.RecordBatch.from_arrays(cells, names=_NAMES)


def start(params: DataFrame) -> State:
    """The state of a parameter table, with moments of zero."""
    def rows(weights: DataFrame) -> DataFrame:
        zero = F.transform("vals", lambda x: F.lit(0.0))
        return weights.select("row", F.col("vals").alias("theta"), zero.alias("m"), zero.alias("v"), F.lit(0).cast("bigint").alias("last"))

    bias = params.where("layer = 2 and name = 'b'").select(F.posexplode("vals").alias("row", "b"))
    output = params.where("layer = 2 and name = 'w'").join(bias, "row").select("row", F.concat("vals", F.array("b")).alias("vals"))
    hidden = [lm._small(params, 1, "w"), lm._small(params, 1, "b")[0]]
    return State(
        materialize(rows(params.where("layer = 0 and name = 'w'")), "lm-words"), materialize(rows(output), "lm-softmax"),
        [[a, np.zeros_like(a), np.zeros_like(a)] for a in hidden], 0,
    )


def params_of(state: State) -> DataFrame:
    """The state's weights as a written parameter table."""
    spark = state.words.sparkSession

    def named(rows: DataFrame, layer: int, name: str, vals) -> DataFrame:
        return rows.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), "row", vals.alias("vals"))

    width = F.size("theta")
    biases = state.softmax.agg(F.array_sort(F.collect_list(F.struct("row", F.get("theta", width - 1).alias("b")))).alias("b"))
    (w1, _, _), (b1, _, _) = state.hidden
    small = pa.table({
        "layer": pa.array([1] * (len(w1) + 1), pa.int32()), "name": ["w"] * len(w1) + ["b"], "row": pa.array([*range(len(w1)), 0], pa.int32()),
        "vals": vector_list(np.concatenate([w1, b1[None]])),
    })
    tables = [
        named(state.words, 0, "w", F.col("theta")), spark.createDataFrame(small, lm.PARAMS), named(state.softmax, 2, "w", F.slice("theta", F.lit(1), width - 1)),
        named(biases.withColumn("row", F.lit(0)), 2, "b", F.transform("b", lambda x: x["b"])),
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return materialize(out, "lm-params")


def _caught_up(words: DataFrame, used: DataFrame | None, rule: Rule, to: int) -> DataFrame:
    """``words`` with the rows of ``used`` (all, if None) brought up to step ``to``."""
    if used is None:
        flagged = words.withColumn("now", F.lit(True))
    else:
        flagged = words.join(used.withColumn("now", F.lit(True)), "row", "left").fillna(False, ["now"])

    def run(batches):
        for batch in batches:
            theta, m, v = (stack_vectors(batch.column(c)).copy() for c in ("theta", "m", "v"))
            last = batch.column("last").to_numpy().copy()
            now = np.flatnonzero(batch.column("now").to_numpy(zero_copy_only=False) & (last < to))
            if len(now):
                parts = [a[now] for a in (theta, m, v)]
                rule.catch_up(*parts, last[now], to)
                for a, part in zip((theta, m, v), parts):
                    a[now] = part
                last[now] = to
            yield _batch(batch.column("row"), theta, m, v, last)

    return materialize(flagged.select(*_NAMES, "now").mapInArrow(run, ROWS), "lm-words")


def _moved(rows: DataFrame, grads: DataFrame, rule: Rule, t: int, free: int = 0) -> DataFrame:
    """``rows`` after step ``t``.  Rows without a gradient stay as they are.  The last ``free`` weights of a row carry no penalty."""

    def run(batches):
        for batch in batches:
            theta, m, v = (stack_vectors(batch.column(c)).copy() for c in ("theta", "m", "v"))
            last = batch.column("last").to_numpy().copy()
            got = np.flatnonzero(batch.column("g").is_valid().to_numpy(zero_copy_only=False))
            if len(got):
                parts = [a[got] for a in (theta, m, v)]
                g = stack_vectors(batch.column("g").drop_null())
                g = g + rule.lmbda * parts[0] * (np.arange(g.shape[1]) < g.shape[1] - free)
                rule.move(*parts, g, t)
                for a, part in zip((theta, m, v), parts):
                    a[got] = part
                last[got] = t
            yield _batch(batch.column("row"), theta, m, v, last)

    return rows.join(grads, "row", "left").select(*_NAMES, "g").mapInArrow(run, ROWS)


def _summed(rows: DataFrame, key: str, vec: str = "vec") -> DataFrame:
    return rows.groupBy(key).agg(vector_to_array(Summarizer.sum(array_to_vector(F.col(vec)))).alias(vec))


def _sum_rows(kind: int, ids: np.ndarray, vec: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array(np.full(len(ids), kind), pa.int32()), pa.array(ids, pa.int64()), vector_list(vec)]
    return pa.RecordBatch.from_arrays(cells, names=["kind", "id", "vec"])


def _block(softmax: DataFrame, first: int, block_words: int):
    """The sent rows of a block of words, the bias last."""
    found = softmax.where(f"row >= {first} and row < {first + block_words}").select("row", "theta").toArrow()
    block = stack_vectors(found.column("theta"))[np.argsort(found.column("row").to_numpy())]
    return softmax.sparkSession.sparkContext.broadcast(block)


def _with_one(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors, np.ones(len(vectors))])


def _tile(h: np.ndarray, y: np.ndarray, block: np.ndarray, by_unit: np.ndarray, weights: np.ndarray, space: np.ndarray):
    """Of examples that see the whole softmax: the best word, probability of the true one, share of the hidden layer's
    gradient, and the sums over the examples that are each word's gradient, transposed, but for the true words' part.

    ``by_unit`` is ``block`` transposed, ``weights`` has ones in the place of its bias."""
    rows, h1 = np.arange(len(h)), _with_one(h)
    cells = np.matmul(h1, by_unit, out=space[: len(h)])
    best = cells.argmax(axis=1)
    top, own = cells[rows, best], cells[rows, y]
    factor = lm._powers(cells, top)
    weighted = cells @ weights
    total = weighted[:, -1]
    back = weighted[:, :-1] / total[:, None] - block[y, :-1]
    return best, np.exp(own - top) / (total * factor), back, (h1 / total[:, None]).T @ cells


def _best_of(h: np.ndarray, block: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best word of each example and its logit; only the words ``few`` are compared."""
    best, top = np.empty(len(h), np.int32), np.empty(len(h))
    by_unit, step = np.ascontiguousarray(block[few].T), max(1, BLOCK_CELLS // len(few))
    for lo in range(0, len(h), step):
        cells = _with_one(h[lo : lo + step]) @ by_unit
        at = cells.argmax(axis=1)
        best[lo : lo + step], top[lo : lo + step] = few[at], cells[np.arange(len(cells)), at]
    return best, top


def _whole_softmax_gradients(hidden: DataFrame, softmax: DataFrame, size: int, n: int) -> DataFrame:
    """Written, from one pass: of each example how it was scored (kind 0, id is its mini-batch), and a task's sums: of each word
    its row's gradient (kind 1), of each slot and word the hidden layer's gradient (kind 2), and that of all examples (kind 3)."""
    shared = _block(softmax, 0, size)
    w, b = shared.value[:, :-1], shared.value[:, -1]
    # None unless the sums over so many words come cheaper from series
    few = series.best_words(w, b, 1) if series.pays(w.shape[1], len(b)) else None

    def run(batches):
        block = shared.value
        grads = None if few is None else series.Gradients(series.Series(np.ascontiguousarray(block[:, :-1]), block[:, -1].copy()))
        step, total, by_slot = max(1, BLOCK_CELLS // len(block)), np.zeros_like(block), None
        by_unit, weights, space = np.ascontiguousarray(block.T), _with_one(block[:, :-1]), np.empty((step, len(block)))

        def rows(kind, ids, vec=None, seen=None):
            some = len(ids)
            vectors = pa.nulls(some, pa.list_(pa.float64())) if vec is None else vector_list(vec)
            rest = seen or [pa.nulls(some, pa.int32()), pa.nulls(some, pa.int32()), pa.nulls(some, pa.float64())]
            cells = [pa.array(np.full(some, kind), pa.int32()), pa.array(ids, pa.int64()), vectors, *rest]
            return pa.RecordBatch.from_arrays(cells, names=["kind", "id", "vec", "y", "y_hat", "p_y"])

        into = np.zeros_like(by_unit)
        for batch in batches:
            h, y = stack_vectors(batch.column("h")), batch.column("y").to_numpy()
            slots = stack_vectors(batch.column("slots"), np.int64)
            if not len(h):
                continue
            if by_slot is None:
                by_slot = np.zeros((slots.shape[1] * size, h.shape[1]))
                used = np.zeros(len(by_slot), bool)
            best, p_y, back = np.empty(len(h), np.int32), np.empty(len(h)), np.empty_like(h)
            if grads is not None:
                best, top = _best_of(h, block, few)
                sums, mean = grads.add(h, top)
                p_y, back = np.exp((_with_one(h) * block[y]).sum(axis=1) - top) / sums, mean - block[y, :-1]
            for lo in range(0, len(h) if grads is None else 0, step):
                part = slice(lo, lo + step)
                best[part], p_y[part], back[part], more = _tile(h[part], y[part], block, by_unit, weights, space)
                into += more
            np.subtract.at(total, y, _with_one(h))
            np.add.at(by_slot, slots, (back * (h > 0))[:, None, :])
            used[slots] = True
            yield rows(0, batch.column("mb_id"), seen=[pa.array(y, pa.int32()), pa.array(best), pa.array(p_y)])
        if by_slot is not None:
            total += into.T if grads is None else grads.by_word()
            yield rows(1, np.arange(len(block)), total / n)
            yield rows(2, np.flatnonzero(used), by_slot[used] / n)
            yield rows(3, np.zeros(1, np.int64), by_slot[:size].sum(axis=0)[None] / n)

    found = materialize(hidden.select("mb_id", "slots", "y", "h").mapInArrow(run, SEEN), "lm-block")
    shared.unpersist()
    return found


def _softmax_gradients(told: DataFrame, softmax: DataFrame, size: int, n: int, block_words: int) -> list[DataFrame]:
    """Per block, written: of each example its share of the hidden layer's gradient (kind 0), of each word its row's (kind 1)."""
    parts = []
    for first in range(0, size, block_words):
        shared = _block(softmax, first, block_words)

        def run(batches, first=first, shared=shared):
            block = shared.value
            step, total = max(1, BLOCK_CELLS // max(len(block), 1)), np.zeros_like(block)
            for whole in batches:
                for lo in range(0, whole.num_rows, step):
                    batch = whole.slice(lo, step)
                    h1 = _with_one(stack_vectors(batch.column("h")))
                    top = batch.column("top").to_numpy()
                    cells = h1 @ block.T
                    share = (lm._powers(cells, top) / (batch.column("total").to_numpy() * n))[:, None]
                    back = (cells @ block[:, :-1]) * share
                    total += ((h1 * share).T @ cells).T
                    y = batch.column("y").to_numpy() - first
                    inside = np.flatnonzero((y >= 0) & (y < len(block)))
                    back[inside] -= block[y[inside], :-1] / n
                    np.subtract.at(total, y[inside], h1[inside] / n)
                    yield _sum_rows(0, batch.column("ex").to_numpy(), back)
            yield _sum_rows(1, first + np.arange(len(block)), total)

        parts.append(materialize(told.select("ex", "y", "h", "top", "total").mapInArrow(run, SUMS), "lm-block"))
        shared.unpersist()
    return parts


def _input_gradients(by_slot: DataFrame, words: DataFrame, w1: np.ndarray, size: int) -> DataFrame:
    """Written: of each word its embedding row's gradient by slot (kind 0), of each input unit its row of the hidden matrix (kind 1)."""

    def run(batches):
        total = np.zeros_like(w1)
        for batch in batches:
            x, back, theta = batch.column("x").to_numpy(), stack_vectors(batch.column("vec")), stack_vectors(batch.column("theta"))
            dim = theta.shape[1]
            for slot in np.unique(x // size).tolist():
                mine = np.flatnonzero(x // size == slot)
                place = slice(slot * dim, (slot + 1) * dim)
                total[place] += theta[mine].T @ back[mine]
                yield _sum_rows(0, x[mine] % size, back[mine] @ w1[place].T)
        yield _sum_rows(1, np.arange(len(w1)), total)

    met = by_slot.withColumn("row", (F.col("x") % size).cast("int")).join(words.select("row", "theta"), "row")
    return materialize(met.select("x", "vec", "theta").mapInArrow(run, SUMS), "lm-input")


def _penalty(params: DataFrame, lmbda: float) -> float:
    return (lm.l2_norm(params, lmbda).first()[0] or 0.0) if lmbda else 0.0


def _by_blocks(hidden: DataFrame, params: DataFrame, softmax: DataFrame, size: int, block_words: int):
    """Two passes over the softmax: examples as scored, and the gradients of words, of slots and words, and of the hidden layer's input."""
    soft = lm._softmax(hidden, params, size, 1, block_words)
    told = materialize(hidden.join(soft.select("ex", "own", "best", "top", "total"), "ex"), "lm-told")
    scored = told.select("mb_id", "y", F.col("best")[0]["id"].alias("y_hat"), (F.exp(F.col("own") - F.col("top")) / F.col("total")).alias("p_y"))
    blocks = _softmax_gradients(told, softmax, size, told.count(), block_words)
    sums = blocks[0]
    for block in blocks[1:]:
        sums = sums.unionByName(block)
    back = _summed(sums.where("kind = 0"), "id").withColumnRenamed("id", "ex").join(told.select("ex", "slots", "h"), "ex")
    active = F.zip_with("vec", "h", lambda g, h: F.when(h > 0, g).otherwise(0.0))
    back = materialize(back.select("slots", active.alias("vec")), "lm-back")
    by_slot = back.select(F.explode(F.col("slots").cast("array<bigint>")).alias("x"), "vec")
    return scored, sums.where("kind = 1"), by_slot, back.select("vec"), [told, back, *blocks]


def _at_once(hidden: DataFrame, softmax: DataFrame, size: int):
    """The same from one pass, of a softmax that a task holds whole."""
    found = _whole_softmax_gradients(hidden, softmax, size, hidden.count())
    scored = found.where("kind = 0").select(F.col("id").alias("mb_id"), "y", "y_hat", "p_y")
    by_slot = found.where("kind = 2").select(F.col("id").alias("x"), "vec")
    return scored, found.where("kind = 1"), by_slot, found.where("kind = 3").select("vec"), [found]


def step(examples: DataFrame, state: State, size: int, rule: Rule, learn_embeddings: bool = True, block_words: int | None = None) -> tuple[State, DataFrame]:
    """One step on ``examples(mb_id, x_idx, y)``: the new state, and cost and accuracy per mini-batch before it.

    ``block_words`` defaults to as many words as ``SOFTMAX_BYTES`` hold."""
    t = state.t + 1
    used = examples.select(F.explode("x_idx").alias("x")).select((F.col("x") % size).cast("int").alias("row")).distinct()
    # a penalty is summed over all rows, so none may lag behind
    words = _caught_up(state.words, None if rule.lmbda else used, rule, t - 1) if learn_embeddings else state.words
    params = params_of(state._replace(words=words))
    hidden = lm.hidden_vectors(examples.withColumn("slots", F.col("x_idx")), params, size, ["mb_id", "slots"])
    if block_words is None:
        block_words = max(1, SOFTMAX_BYTES // (8 * (len(state.hidden[1][0]) + 1)))
    if size <= block_words:
        scored, out_sums, by_slot, back, made = _at_once(hidden, state.softmax, size)
    else:
        scored, out_sums, by_slot, back, made = _by_blocks(hidden, params, state.softmax, size, block_words)
    stats = materialize(lm.cost_and_accuracy(scored, ["mb_id"], _penalty(params, rule.lmbda)), "lm-stats")

    out_grads = _summed(out_sums, "id").select(F.col("id").cast("int").alias("row"), F.col("vec").alias("g"))
    softmax = materialize(_moved(state.softmax, out_grads, rule, t, free=1), "lm-softmax")
    by_slot = _summed(by_slot, "x")
    (w1, m1, v1), (b1, mb, vb) = state.hidden
    inputs = _input_gradients(by_slot, words, w1, size)
    g_b1 = np.array(back.agg(vector_to_array(Summarizer.sum(array_to_vector("vec"))).alias("g")).first()["g"])
    found = _summed(inputs.where("kind = 1"), "id").toArrow()
    g_w1 = stack_vectors(found.column("vec"))[np.argsort(found.column("id").to_numpy())] + rule.lmbda * w1
    hidden_state = [[a.copy() for a in part] for part in ((w1, m1, v1), (b1, mb, vb))]
    for part, g in zip(hidden_state, (g_w1, g_b1)):
        rule.move(*part, g, t)
    if learn_embeddings:
        grads = _summed(inputs.where("kind = 0"), "id").select(F.col("id").cast("int").alias("row"), F.col("vec").alias("g"))
        moved = materialize(_moved(words, grads, rule, t), "lm-words")
        for old in {id(state.words): state.words, id(words): words}.values():
            release(old)
        words = moved
    for old in (params, hidden, inputs, state.softmax, *made):
        release(old)
    return State(words, softmax, hidden_state, t), stats


def save(state: State, path: str) -> None:
    """Weights, moments and step number, to go on from."""
    spark = state.words.sparkSession
    (w1, m1, v1), (b1, mb, vb) = state.hidden
    rows = np.arange(len(w1) + 1)
    hidden = _batch(rows, *(np.concatenate([a, b[None]]) for a, b in ((w1, b1), (m1, mb), (v1, vb))), np.full(len(rows), state.t))
    parts = {"words": state.words, "softmax": state.softmax, "hidden": spark.createDataFrame(pa.Table.from_batches([hidden]), ROWS)}
    out = None
    for name, table in parts.items():
        part = table.select(F.lit(name).alias("part"), *_NAMES, F.lit(state.t).cast("bigint").alias("t"))
        out = part if out is None else out.unionByName(part)
    out.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> State:
    """What ``save`` wrote."""
    table = spark.read.parquet(path)
    found = table.where("part = 'hidden'").select(*_NAMES, "t").toArrow()
    order = np.argsort(found.column("row").to_numpy())
    w, m, v = (stack_vectors(found.column(c))[order] for c in ("theta", "m", "v"))
    words, softmax = (materialize(table.where(F.col("part") == p).select(*_NAMES), f"lm-{p}") for p in ("words", "softmax"))
    return State(words, softmax, [[a[:-1] for a in (w, m, v)], [a[-1] for a in (w, m, v)]], int(found.column("t")[0].as_py()))


def train(
    rows: DataFrame, params: DataFrame | None, vocab_size: int, epochs: int = 10, lmbda: float = 0.0, optimizer: str = "adam", rate: float = 0.001,
    steps_per_epoch: int = 1, learn_embeddings: bool = True, path_to_save: str | None = None, block_words: int | None = None,
    resume: str | None = None, first_epoch: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Train on ``batch_rows`` and return ``(params, stats)``, with the results of ``sync='gradient'`` at any vocabulary size.

    With ``path_to_save`` each epoch leaves its weights in ``epoch=<n>`` and all it takes to go on in ``state-<n>``; ``resume`` names
    such a state and ``first_epoch`` the number of the next epoch.
    """
    if optimizer not in ("adam", "sgd"):
        raise ValueError("optimizer is 'adam' or 'sgd'")
    spark, rule = rows.sparkSession, Rule(optimizer, rate, lmbda)
    state = load(spark, resume) if resume else start(params)
    width = (F.size("x_idx") / F.size("ys")).cast("int")
    flat = rows.where(F.col("split") == "train").withColumn("ys", F.col("y")).select("mb_id", "x_idx", width.alias("w"), F.posexplode("ys").alias("i", "y"))
    examples = materialize(flat.select("mb_id", F.slice("x_idx", F.col("i") * F.col("w") + 1, F.col("w")).alias("x_idx"), "y"), "lm-train")
    history, current = [], params
    for epoch in range(first_epoch, first_epoch + epochs):
        for share in range(steps_per_epoch):
            mine = examples if steps_per_epoch == 1 else examples.where(F.pmod("mb_id", F.lit(steps_per_epoch)) == share)
            if mine.isEmpty():
                continue
            state, stats = step(mine, state, vocab_size, rule, learn_embeddings, block_words)
            history.append(lm._train_stats(stats, epoch))
        if learn_embeddings:
            whole = _caught_up(state.words, None, rule, state.t)
            release(state.words)
            state = state._replace(words=whole)
        current = params_of(state)
        if path_to_save is not None:
            current.write.mode("overwrite").parquet(f"{path_to_save}/epoch={epoch}")
            save(state, f"{path_to_save}/state-{epoch}")
        history.append(lm._held_out_stats(rows, current, vocab_size, epoch, lmbda))
    if not history:
        return (params if params is not None else params_of(state)), spark.createDataFrame([], lm.STATS)
    stats = history[0]
    for part in history[1:]:
        stats = stats.unionByName(part)
    return current, stats
