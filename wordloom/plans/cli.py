"""Command lines of the four jobs.

    spark-submit -m wordloom term-document --input 'books/*.txt' --save models/td
    python -m wordloom word2vec --table documents.parquet --phrases 1 --save models/w2v
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wordloom.operators.corpus import read_lines
from wordloom.plans import jobs
from wordloom.sources.tables import documents_table
from wordloom.sources.text_files import list_documents, read_text_lines


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wordloom", description="Build word and document representations.")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text, description=text)
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--input", nargs="+", help="text files or folders, one document per file")
        source.add_argument("--table", help="Parquet table with doc_id and text")
        p.add_argument("--glob", default="*", help="file name pattern within --input")
        p.add_argument("--save", required=True, help="folder for the model")
        return p

    p = job("term-document", "Count words per document.")
    p.add_argument("--min_count", type=int, default=20)
    p = job("word-word", "Count words within a window of each other.")
    p.add_argument("--window", type=int, default=5)
    p.add_argument("--min_count", type=int, default=20)
    p = job("word2vec", "Train skip-gram or CBOW embeddings.")
    p.add_argument("--algorithm", default="skip-gram", help="'skip-gram' or 'cbow'")
    p.add_argument("--window", type=int, default=5)
    p.add_argument("--iter", type=int, default=20)
    p.add_argument("--min_count", type=int, default=5)
    p.add_argument("--dim", type=int, default=100)
    p.add_argument("--phrases", type=int, default=0)
    p.add_argument("--negative", type=int, default=5)
    p.add_argument("--threads", type=int, default=4, help="partitions trained side by side")
    p = job("language-model", "Train a feed-forward next-word model.")
    p.add_argument("--epochs", type=int, default=10)
    p.add_argument("--regularization", type=float, default=0.0)
    p.add_argument("--context_size", type=int, default=4)
    p.add_argument("--min_count", type=int, default=25)
    p.add_argument("--hidden_units", type=int, default=50)
    p.add_argument("--mini_batch_size", type=int, default=64)
    p.add_argument("--dimensions", type=int, default=100)
    p.add_argument("--data", help="folder to keep prepared mini-batches in")
    return top


def _corpus(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    if args.table:
        documents = documents_table(spark, args.table)
        return read_lines(documents), documents.select("doc_id")
    return read_text_lines(spark, args.input, args.glob), list_documents(spark, args.input, args.glob)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"wordloom {args.job}").getOrCreate()
    lines, documents = _corpus(spark, args)
    if args.job == "term-document":
        model = jobs.build_term_document(lines, documents, args.min_count)
    elif args.job == "word-word":
        model = jobs.build_word_word(lines, args.window, args.min_count)
    elif args.job == "word2vec":
        model = jobs.train_embeddings(
            lines, args.algorithm, args.window, args.iter, args.min_count, args.dim, args.phrases,
            args.negative, args.threads,
        )
    else:
        model = jobs.train_language_model(
            lines, args.epochs, args.regularization, args.context_size, args.min_count,
            args.hidden_units, args.mini_batch_size, args.dimensions,
            path_to_save=f"{args.save}/epochs", keep_in=args.data,
        )
    model.save(args.save)
