"""Documents to lines, sentences and tokens; document order; train/test/validate split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.functions.hashing import hash32
from wordloom.operators.ordering import dense_index

SENTENCE_KEY = ["doc_id", "line_no", "sent_no"]


def read_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lines(doc_id, line_no, line)``: stripped, non-blank lines of each document."""
    raw = documents.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"),
    )
    return raw.withColumn("line", tx.strip("line")).where(F.col("line") != "")


def sentences(
    lines: DataFrame,
    mode: str = "treebank",
    preprocessor: tx.TokenFilter | None = None,
    abbreviations: Sequence[str] = (),
) -> DataFrame:
    """``sentences(.., sent_no, toks)``: cleaned, never empty, never crossing a line.

    ``preprocessor`` maps the raw token array to the final one; the default lower-cases
    and keeps letters, and runs on the whole line at once.  Other columns pass through.
    """
    line = F.col("line")
    plain = preprocessor is None
    ended = tx.mark_sentences(line, abbreviations)
    marked = tx.mark_words(ended, mode, letters_only_of=line if plain else None)
    if plain:
        marked = tx.clean_marked(marked)
    keep = [c for c in lines.columns if c != "line"]
    # a projection of its own: below a generator shared parts would be computed anew for each use
    split = lines.select(*keep, marked.alias("__marked")).select(
        *keep, F.posexplode(F.split("__marked", "\n")).alias("sent_no", "sentence")
    )
    # tested before splitting, so the filter below the projection does not tokenise again
    some = split.where(F.trim("sentence") != "")
    toks = tx.split_tokens(F.col("sentence"))
    if plain:
        return some.select(*keep, "sent_no", toks.alias("toks"))
    made = some.select(*keep, "sent_no", F.explode(F.array(preprocessor(toks))).alias("toks"))
    return made.where(F.size("toks") > 0)


def tokens(sents: DataFrame, col: str = "toks", name: str = "tok") -> DataFrame:
    """``tokens(.., pos, tok)``: one row per token, positions counted after cleaning."""
    keep = [c for c in sents.columns if c != col]
    return sents.select(*keep, F.posexplode(col).alias("pos", name))


def document_index(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_index(doc_id, doc_ix)``: position of each document in sorted order."""
    ids = documents.select(F.col(id_col).alias("doc_id"))
    return dense_index(ids, [F.col("doc_id")], "doc_ix").select(
        "doc_id", "doc_ix"
    )


def shuffled_document_order(index: DataFrame, seed: int, epoch: int = 0) -> DataFrame:
    """A different, repeatable permutation of the documents for each pass."""
    mixed = index.select("doc_id", hash32(seed, F.lit(epoch), F.col("doc_id")).alias("h"))
    placed = dense_index(mixed, [F.col("h"), F.col("doc_id")], "shuffle_ix")
    return placed.select("doc_id", "shuffle_ix")


def split_lines(
    lines: DataFrame, fraction_train: float = 0.8, fraction_test: float = 0.1, seed: int = 0
) -> DataFrame:
    """Add ``split`` to each line: one of 101 equally likely buckets decides.

    Bucket ``b`` stands for ``b / 100``, both ends included, so the nominal 80/10/10 split
    has odds 80, 10 and 11 in 101.
    """
    if fraction_train < 0 or fraction_test < 0 or fraction_train + fraction_test > 1.0:
        raise ValueError("fraction_train + fraction_test must lie within [0, 1]")
    bucket = F.pmod(hash32(seed, F.col("doc_id"), F.col("line_no")), F.lit(101))
    return lines.withColumn("split", split_name(bucket, fraction_train, fraction_test))


def split_name(bucket, fraction_train: float, fraction_test: float):
    draw = bucket / F.lit(100.0)
    return (
        F.when(draw < F.lit(fraction_train), "train")
        .when(draw < F.lit(fraction_train + fraction_test), "test")
        .otherwise("validate")
    )
