"""The stages of the pipeline, each against a plain version over its own input."""

import re
import string
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_learned import brute_components
from wordloom.llm import line_dedup, pieces
from wordloom.sources.scratch import materialize

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def written(spark):
    """The documents and what each stage made of its predecessor's result."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF), name))
    return docs


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(written):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    assert all(df.columns == written[0].columns for df in written[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, written):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = texts(written[1])
    gone = [i for i in texts(written[0]) if i not in left and i in labels]
    assert all(labels[i] for i in gone) and len(left) > 0.8 * written[0].count()


def test_boilerplate_lines_go(written):
    before, after = written[1].collect(), texts(written[2])
    pages, holds, kinds = Counter(r["source"] for r in before), Counter(), Counter(s for s, _ in {(r["source"], r["text"]) for r in before})
    strip = lambda line: line.strip(" \t\n\x0b\x0c\r")
    for r in before:
        holds.update({(r["source"], strip(x)) for x in r["text"].split("\n") if strip(x)})

    def bad(host, line):
        n, all_pages = holds[host, strip(line)], pages[host]
        small = all_pages < line_dedup.MIN_PAGES and n == all_pages > 1 and kinds[host] > 1
        return n > line_dedup.RATIO * all_pages and (n >= line_dedup.MIN_PAGES or small)

    for r in before:
        assert after[r["doc_id"]] == "\n".join(x for x in r["text"].split("\n") if not bad(r["source"], x))
    assert all(r["n_chars"] == len(r["text"]) for r in written[2].collect())


def test_one_of_each_group_stays(written):
    before, after = texts(written[2]), texts(written[3])
    ids = sorted(before)
    _, root = brute_components([before[i] for i in ids], 5, 80, 100)
    assert sorted(after) == sorted({ids[r] for r in root})


def test_contaminated_documents_go(spark, written):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))

    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {" ".join(w[s : s + 10]) for w in items for s in range(max(len(w) - 9, 1)) if w}
    bad = re.compile("|".join(f"(?: {re.escape(w)} )" for w in windows))
    before = texts(written[3])
    assert sorted(texts(written[4])) == sorted(i for i, t in before.items() if not bad.search(f" {' '.join(words(t))} "))


def test_ids_decode_to_the_text(written):
    model, before = pieces.load_pieces(), texts(written[4])
    rows = written[5].collect()
    assert len(rows) == len(before)
    assert all(r["round_trip"] and pieces.decode(r["ids"], model) == before[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_applies_all_stages(spark, written):
    found = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).select("doc_id", "ids").collect()}
    assert found == {r["doc_id"]: r["ids"] for r in written[5].collect()}
