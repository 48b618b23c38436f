"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    collocations, decontaminate, jaccard, licenses, line_dedup, packing, pieces, pii, quality_model, quality_rules, runs, substring_dedup,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), near=True)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_units(_table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_column(_table(spark, sf_dir, "documents"), pieces.load_pieces())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "source", "_n_lines AS n_lines", "_n_dropped AS n_dropped", "text")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", runs.repeat_tail(docs["doc_id"], docs["text"]).alias("text"))
    return runs.run_digests(runs.periodic_runs(planted))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pii": op3_pii,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_line_dedup": op7_line_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_periodic_runs": op13_periodic_runs,
}
