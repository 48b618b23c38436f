"""Models at rest: Parquet tables plus one JSON document, under a path named by the settings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wordloom.functions.text import DEFAULT_CLEAN_REGEX, TokenFilter, regex_preprocessor


def config_path(base: str, settings: dict) -> str:
    """A folder per combination of settings, so changed settings never reuse old results."""
    text = json.dumps(settings, sort_keys=True)
    return f"{base.rstrip('/')}/config={hashlib.md5(text.encode()).hexdigest()[:12]}"


def save_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame], settings: dict) -> None:
    """Write every table, then the settings: their presence marks a complete model."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    text = json.dumps({**settings, "tables": sorted(tables)}, sort_keys=True)
    row = spark.createDataFrame([(text,)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load_settings(spark: SparkSession, path: str) -> dict | None:
    """The saved settings, or None if no complete model lies at ``path``."""
    try:
        found = spark.read.text(f"{path}/settings").first()
    except AnalysisException:
        return None
    return json.loads(found["value"]) if found else None


def load_tables(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    settings = load_settings(spark, path)
    if settings is None:
        raise FileNotFoundError(path)
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in settings["tables"]}
    return tables, settings


def build_once(
    spark: SparkSession, path: str, build: Callable[[], dict[str, DataFrame]], settings: dict
) -> tuple[dict[str, DataFrame], dict]:
    """Load the tables at ``path`` if complete, else build and save them first."""
    if load_settings(spark, path) is None:
        save_tables(spark, path, build(), settings)
    return load_tables(spark, path)


def preprocessor_settings(clean_regex: str = DEFAULT_CLEAN_REGEX) -> dict:
    return {"version": "V1", "clean_regex": clean_regex}


def preprocessor_from(settings: dict) -> TokenFilter | None:
    """The token preprocessor a saved configuration stands for; None is the default one."""
    versions = {"V1": _version_1}
    return versions[settings["version"]](settings)


def _version_1(settings: dict) -> TokenFilter | None:
    regex = settings["clean_regex"]
    return None if regex == DEFAULT_CLEAN_REGEX else regex_preprocessor(regex)
