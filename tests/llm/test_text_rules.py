"""Decontamination, line and substring dedup, license scan and quality rules on small tables."""

import hashlib
import random
import re
import string

import pytest

import corpus_pipeline
from wordloom.llm import decontaminate, licenses, line_dedup, quality_rules, substring_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, body string"


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def table(spark, texts, sources=None):
    """Documents with columns that clash with names inside the operators, and a row without id."""
    sources = sources or [None] * len(texts)
    rows = [(i, t, None, s, None, "x", None) for i, (t, s) in enumerate(zip(texts, sources))]
    return spark.createDataFrame([*rows, (None, "no id at all", None, None, None, None, None)], SHAPE)


def noise(rng, n, words=6):
    return " ".join(rng.choice(["Alpha", "beta,", "GAMMA", "x", "É1", "d-e"][:words]) for _ in range(n))


@pytest.fixture(scope="module")
def rng():
    return random.Random(11)


def test_contamination_equals_brute_force(spark, rng):
    items = [noise(rng, n) for n in (3, 9, 10, 11, 14)] + ["", None, "!!", "beta"]
    long_text = noise(rng, 30_000) + " " + items[4]
    texts = [noise(rng, rng.randint(0, 60)) for _ in range(40)] + [None, "", "  \n", long_text, items[3] + " " + items[3], "Alpha"]
    benchmark = spark.createDataFrame([*enumerate(items), (10, items[0])], "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(table(spark, texts), benchmark).collect()}
    assert len(got) == len(texts) + 1 and not got[None]["contaminated"]
    windows = {}
    for i, item in [*enumerate(items), (10, items[0])]:
        w = alnum(item)
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(i)
    for i, text in enumerate(texts):
        w, hit, ids = alnum(text), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if found := windows.get(tuple(w[s : s + size])):
                    hit.update(range(s, s + size))
                    ids |= found
        names = ",".join(sorted(map(str, ids)))
        row = got[i]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(w), len(hit), len(ids))
        assert row["items_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert row["contaminated"] == bool(hit)


def test_contamination_of_empty_tables(spark):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert [r["n_hit"] for r in decontaminate.contamination(table(spark, ["a b"]), empty).collect()] == [0, 0]
    none = table(spark, []).where("false")
    assert decontaminate.contamination(none, spark.createDataFrame([(1, "a b")], empty.schema)).count() == 0


def test_repeated_rows_share_their_hits(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "one two")], "item_id bigint, text string")
    assert [(r["n_words"], r["n_hit"]) for r in decontaminate.contamination(docs, items).collect()] == [(2, 2), (2, 2)]
    assert decontaminate.drop_contaminated(docs, items).count() == 0


def test_proximity_finds_near_terms_in_any_order(spark):
    docs = spark.createDataFrame([(1, "red x x blue"), (2, "blue x red"), (3, "red " + "x " * 50 + "blue"), (4, "red")], "doc_id bigint, text string")
    phrases = spark.createDataFrame([(0, ["red", "blue"]), (1, ["x"])], "phrase_id bigint, phrase array<string>")
    terms = spark.createDataFrame([("red",), ("blue",), ("x",)], "term string")
    index = decontaminate.build_index(docs, terms)
    found = decontaminate.proximity_matches(docs, decontaminate.ranked_terms(phrases, index), index, slop=5)
    assert sorted((r["phrase_id"], r["doc_id"]) for r in found.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3)]


def test_near_places_of_one_row_do_not_count_in_another_of_its_id(spark):
    # both rows of id 1 give places of the rarest term; each place is looked up in each row's own words
    docs = spark.createDataFrame([(1, "red a a a a"), (1, "a a a red blue"), (2, "blue blue blue"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "red blue"), (8, None)], "item_id bigint, text string")
    got = decontaminate.contamination(docs, items, near=True).collect()
    assert sorted((r["doc_id"], r["n_near"], r["near_items"]) for r in got) == [(1, 1, "7"), (1, 1, "7"), (2, 0, ""), (3, 0, "")]
    none = decontaminate.contamination(docs, items.where("false"), near=True).collect()
    assert [r["n_near"] for r in none] == [0, 0, 0, 0]


def test_near_contamination_equals_brute_force(spark, tmp_path):
    from wordloom.llm.queries import QUERIES

    rng = random.Random(4)
    pool = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(pool) for _ in range(n)) for n in (1, 2, 4, 5, 9, 10, 14, 25)] + ["", None]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(30)] + [None, ""]
    for item in items[3:8]:
        w = alnum(item)
        for gap in (0, 1, 3, 30):
            texts.append(" ".join(x + " zz" * gap * (k == 4) for k, x in enumerate(w)))
        texts += [" ".join("É" if k % 10 == 3 else x for k, x in enumerate(w)), " ".join(["a"] * 50 + w[::-1])]
        texts.append(" ".join("É" if k % 5 == 3 else x for k, x in enumerate(w)))
    spark.createDataFrame([*enumerate(items)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op1_decontamination"](spark, str(tmp_path)).collect()}
    counts = {}
    for text in [*texts, "no id at all"]:
        for x in alnum(text):
            counts[x] = counts.get(x, 0) + 1
    changed = 0
    for i, text in enumerate(texts):
        w, want = alnum(text), set()
        for k, item in enumerate(items):
            v = alnum(item)
            for s in range(max(len(v) - 9, 1) if v else 0):
                phrase = sorted(set(v[s : s + 10]), key=lambda x: (counts.get(x, 0), x))
                spare = int(len(phrase) >= 5)
                for p, x in enumerate(w):
                    if x in phrase[: 1 + spare] and len(set(phrase) - set(w[max(0, p - 20) : p + 21])) <= spare:
                        want.add(str(k))
        assert got[i]["near_items"] == ",".join(sorted(want)) and got[i]["n_near"] == len(want), text
        changed += got[i]["n_near"] > got[i]["n_items"]
    assert changed > 5 and got[None]["n_near"] == 0


def test_line_dedup_drops_only_boilerplate(spark):
    texts = [f"menu \nbody {i}\n\n{'rare' if i < 2 else i}\nmenu" for i in range(10)] + ["menu", "menu\nother", None, ""]
    sources = ["a"] * 10 + ["b", None, "a", "a"]
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(table(spark, texts, sources), ratio=0.5).collect()}
    assert rows[0]["text"] == "body 0\n\nrare" and (rows[0]["_n_lines"], rows[0]["_n_dropped"]) == (5, 2)
    assert rows[10]["text"] == "menu" and rows[11]["text"] == "menu\nother" and rows[None]["text"] == "no id at all"
    assert rows[12]["text"] is None and rows[12]["_n_lines"] == 0 and rows[13]["text"] == ""
    assert rows[0]["words"] == "x" and len(rows) == 15


def test_boilerplate_reaches_the_gap_and_small_hosts(spark, tmp_path):
    from wordloom.llm.queries import QUERIES

    texts = [f"page {i}" + ("\nmenu" if i < 8 else "\nnews" if i < 14 else "") for i in range(100)]
    texts += ["one\nfoot", "two\nfoot", "same\ncopy", "same\ncopy", "alone", "x\nfoot\npart", "y\nfoot\npart", "z\nfoot", None]
    sources = ["big"] * 100 + ["two"] * 2 + ["copies"] * 2 + ["one"] + ["three"] * 3 + ["null"]
    table(spark, texts, sources).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["text"] for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert [got[0], got[8], got[99]] == ["page 0", "page 8\nnews", "page 99"]
    assert [got[i] for i in range(100, 109)] == ["one", "two", "same\ncopy", "same\ncopy", "alone", "x\npart", "y\npart", "z", None]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.without_boilerplate(spark, docs, "").collect()} == got


def test_line_dedup_of_empty_table(spark):
    assert line_dedup.dedup_lines(table(spark, []).where("false")).count() == 0


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_substring_dedup_equals_brute_force(spark, rng, unit):
    gap = "\n" if unit == "line" else "\n \n"
    pool = [noise(rng, n) for n in (1, 4, 5, 6, 7, 2000)]
    texts = [gap.join(rng.choice(pool) + rng.choice(["", "!"]) for _ in range(rng.randint(1, 6))) for _ in range(30)] + ["", None]
    got = {r["doc_id"]: r for r in substring_dedup.dedup_units(table(spark, texts), unit=unit, min_words=5).collect()}
    seen = set()
    for i, text in enumerate(texts):
        if text is None:
            assert got[i]["text"] is None and got[i]["n_units"] == 0
            continue
        gone, kept, left, at = [], [], "", 0
        parts = text.split(gap)
        for k, part in enumerate(parts):
            words = tuple(re.findall(rb"[0-9a-z\x80-\xff]+", part.encode().lower()))
            span, tail = f"{at}:{at + len(part)}", gap if k + 1 < len(parts) else ""
            if len(words) >= 5 and words in seen:
                gone.append(span)
            else:
                seen.add(words)
                kept.append(span)
                left += part + tail
            at += len(part) + len(gap)
        row = got[i]
        assert (row["removed"], row["kept"], row["text"], row["n_removed"]) == (",".join(gone), ",".join(kept), left, len(gone))
    assert got[None]["text"] == "no id at all"


def test_substring_dedup_keeps_the_best_rank(spark):
    docs = spark.createDataFrame([(1, 9, "a b c"), (2, 3, "A, b c"), (2, 3, "A, b c")], "doc_id bigint, place int, text string")
    got = [(r["doc_id"], r["text"]) for r in substring_dedup.dedup_units(docs, min_words=2, rank="place").orderBy("doc_id").collect()]
    assert got == [(1, ""), (2, "A, b c"), (2, "A, b c")]
    with pytest.raises(ValueError):
        substring_dedup.dedup_units(docs, unit="page")


def test_passages_of_short_lines_go(spark, rng, tmp_path):
    from wordloom.llm.queries import QUERIES

    pool = [noise(rng, n) for n in (1, 2, 3, 4, 30)] + ["--", "  x y"]
    texts = ["".join(rng.choice(pool) + rng.choice(["\n", "\n\n", "\n \n  "]) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts += ["one day\nthe rain came\n\nZ", "new\n\none\nday the rain came\n--\n\nend", "a b\n\n--\na b", ""]
    table(spark, [*texts, None]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op2_substring_dedup"](spark, str(tmp_path)).collect()}
    seen = {}
    words_of = lambda x: tuple(re.findall(rb"[0-9a-z\x80-\xff]+", x.encode().lower()))
    for i, text in enumerate(texts):
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, at + len(line)))
            at += len(line) + 1
        blocks, block = [], []
        for a, b in lines:
            if text[a:b].strip():
                block.append((a, b))
            elif block:
                blocks.append(block)
                block = []
        blocks += [block] if block else []
        pieces = [[s] for s in lines] + [b for b in blocks if sum(bool(words_of(text[x:y])) for x, y in b) > 1]
        gone = set()
        for piece in sorted(pieces, key=lambda p: (p[0][0], len(p))):
            words = words_of(text[piece[0][0] : piece[-1][1]])
            if words and seen.setdefault(words, (i, piece)) != (i, piece):
                gone.update(s for s in piece if s[0] < s[1])
        assert got[i]["removed"] == ",".join(f"{a}:{b}" for a, b in lines if (a, b) in gone), text
        assert got[i]["n_units"] == len(lines)
    assert got[41]["text"] == "new\n\n\nend" and got[42]["text"] == "a b\n\n--\n"
    assert got[None]["text"] == "no id at all" and got[len(texts)]["text"] is None


def test_quality_rules_equal_brute_force(spark, rng):
    texts = [noise(rng, n, w) for n in (0, 5, 19, 20, 60, 300) for w in (2, 6)]
    texts += ["a b c d e f g h " * 4, "line one\nline one\n\n \nline one", "#$ *x*", None, "ab " * 5000, "w " + "x" * 100_000]
    got = {r["doc_id"]: r for r in quality_rules.judge(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        body = text or ""
        words = SPACED.findall(body)
        grams, covered = {}, set()
        for s in range(len(words) - 7):
            grams.setdefault(tuple(words[s : s + 8]), []).append(s)
        for at in grams.values():
            if len(at) > 1:
                covered.update(p for s in at for p in range(s, s + 8))
        lines = [x for x in body.split("\n") if SPACED.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", body)), len(lines) - len(set(lines)), len(covered))
        row = got[i]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_quality_rules_keep_prose_and_refuse_junk(spark):
    prose = "The river runs past the old mill and into the town, where it turns to the sea in a wide and quiet bend below it."
    junk = " ".join(f"w{i}%%% ***" for i in range(30))
    shout = " ".join(f"BUY{chr(65 + i)} NOW" for i in range(26)) + " the and of"
    rows = quality_rules.judge(table(spark, [prose, junk, shout])).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [False, True, False, False]


def test_license_scan_equals_brute_force(spark, rng):
    pool = ["MIT License", "licensed under the Apache License, Version 2.0", "cc by", "CC-BY-NC 4.0", "word", "gnu general public license", "license"]
    pool += ["All rights reserved.", "SPDX-License-Identifier: MIT", "x" * 500, "GNU General Public License, version 3"]
    texts = [". ".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(40)] + [None, "", "cc by " * 300]
    got = {r["doc_id"]: r for r in licenses.scan(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        words = alnum(text)
        base, hits = [], []
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            base += [(s, label) for s in range(len(words)) if words[s : s + len(p)] == p]
        norm = f" {' '.join(words)} "
        for rule in licenses.RULES:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", norm):
                start = norm[: m.start()].count(" ") - 1
                hits.append((start, start + m.group().count(" ") + 1, rule))
        left = [
            h for h in hits
            if not any(o[0] <= h[0] and o[1] >= h[1] and (o[1] - o[0] > h[1] - h[0] or o[2].priority < h[2].priority) for o in hits)
        ]
        row = got[i]
        starts = [s for s, _ in base]
        assert (row["n_words"], row["n_base"]) == (len(words), len(base))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in base}))
        assert row["labels"] == ",".join(sorted({label for _, label in base} | {h[2].label for h in left}))
        assert row["score"] == max((h[2].score for h in left), default=0.0)


def test_license_rules_are_gated_without_loss():
    rules = licenses.RULES
    assert len(rules) > 250
    first = licenses.first_keywords(rules)
    for rule in rules:
        assert any(k in rule.keyword or k in rule.other for k in first)


def test_rows_of_one_id_with_different_texts_are_told_apart(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    docs = spark.createDataFrame([(1, a), (5, b), (5, a), (5, f"{b}\n{a}")], "doc_id bigint, text string")
    got = [(r["doc_id"], r["n_removed"], r["text"]) for r in substring_dedup.dedup_units(docs, unit="line").collect()]
    # of id 5 one of the two rows with the unit b keeps it, and none keeps a
    assert sorted(g for g in got if g[0] == 1) == [(1, 0, a)]
    assert sum(b in text for _, _, text in got) == 1 and sum(a in text for _, _, text in got) == 1


def test_lines_are_cut_on_their_own_host_only(spark):
    rows = [(i, "footer\nx" + str(i), "a") for i in range(10)] + [(i, "footer\ny" + str(i), "b") for i in (3,)] + [(100 + i, f"z{i}", "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {(r["doc_id"], r["source"]): r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got[3, "a"] == "x3" and got[3, "b"] == "footer\ny3" and len(got) == 41
