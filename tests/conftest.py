import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def micro(spark):
    """Two documents worked through by hand."""
    rows = [
        ("a", "Cats chase mice. Cats like cheese!"),
        ("b", "Mice like cheese.\nDogs chase cats. Dogs can't fly."),
    ]
    return spark.createDataFrame(rows, "doc_id string, text string")


@pytest.fixture(scope="session")
def micro_sents(spark, micro):
    from wordloom.operators import corpus
    from wordloom.sources.scratch import materialize

    return materialize(corpus.sentences(corpus.read_lines(micro)), "micro")


@pytest.fixture(scope="session")
def micro_vocab(micro_sents):
    from wordloom.operators import vocabulary

    return vocabulary.vocabulary(vocabulary.token_counts(micro_sents), 2)


@pytest.fixture(scope="session")
def random_sents(spark):
    """Sentences over a small skewed alphabet, so that repeats and phrases are common."""
    import random

    rng = random.Random(5)
    words = list("aaaabbbcdefgh")
    rows = [
        (d, l, 0, [rng.choice(words) for _ in range(rng.randint(1, 14))])
        for d in range(40)
        for l in range(5)
    ]
    schema = "doc_id int, line_no int, sent_no int, toks array<string>"
    return spark.createDataFrame(rows, schema).repartition(4)


def rows_of(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
