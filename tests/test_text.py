import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.functions import text as tx
from wordloom.operators import corpus, segmentation

# The published Penn Treebank rules, applied one sentence at a time.
STEPS = [
    (r'^"', r"``"), (r"(``)", r" \1 "), (r'([ (\[{<])"', r"\1 `` "),
    (r"([:,])([^\d])", r" \1 \2"), (r"([:,])$", r" \1 "), (r"\.\.\.", r" ... "), (r"[;@#$%&]", r" \g<0> "),
    (r"""([^.])(\.)([\])}>"']*)\s*$""", r"\1 \2\3 "), (r"[?!]", r" \g<0> "), (r"([^'])' ", r"\1 ' "),
    (r"[\]\[(){}<>]", r" \g<0> "), (r"--", r" -- "),
]
LATER = [
    (r'"', " '' "), (r"(\S)('')", r"\1 \2 "), (r"([^' ])('[sS]|'[mM]|'[dD]|') ", r"\1 \2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"\1 \2 "),
    (r"(?i)\b(can)(not)\b", r" \1 \2 "), (r"(?i)\b(d)('ye)\b", r" \1 \2 "),
    (r"(?i)\b(gim)(me)\b", r" \1 \2 "), (r"(?i)\b(gon)(na)\b", r" \1 \2 "),
    (r"(?i)\b(got)(ta)\b", r" \1 \2 "), (r"(?i)\b(lem)(me)\b", r" \1 \2 "),
    (r"(?i)\b(mor)('n)\b", r" \1 \2 "), (r"(?i)\b(wan)(na)\s", r" \1 \2 "),
    (r"(?i) ('t)(is)\b", r" \1 \2 "), (r"(?i) ('t)(was)\b", r" \1 \2 "),
]


def by_hand(line: str) -> list[list[str]]:
    out = []
    for sentence in re.sub(r"([.!?]) +", "\\1\n", line.strip()).split("\n"):
        for pattern, replacement in STEPS:
            sentence = re.sub(pattern, replacement, sentence, flags=re.ASCII)
        sentence = f" {sentence} "
        for pattern, replacement in LATER:
            sentence = re.sub(pattern, replacement, sentence, flags=re.ASCII)
        toks = [re.sub(r"[^a-zé ]", "", t.lower()) for t in sentence.split()]
        toks = [t for t in toks if t]
        if toks:
            out.append(toks)
    return out


def test_random_lines_split_like_the_published_rules(spark):
    rng = random.Random(11)
    pieces = [
        "he", "can", "not", "cannot", "gonna", "wanna", "gimme", "d'ye", "mor'n", "'tis", "'twas", "n't", "é",
        "'s", "'ll", "'", "''", '"', "``", "-", "--", ".", "..", "...", ",", ":", ";", "!", "?", "(", ")", "[",
        "]", "<", "1", "a", "B", " ", " ", " ", " ", "$", "@",
    ]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    texts += [t.replace("'", "") for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = corpus.sentences(corpus.read_lines(df)).orderBy("doc_id", "sent_no").collect()
    got: dict[int, list] = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append(list(r["toks"]))
    wrong = [(t, got.get(i, []), by_hand(t)) for i, t in enumerate(texts) if got.get(i, []) != by_hand(t)]
    assert wrong[:20] == []


def test_micro_corpus_sentences(micro_sents):
    assert rows_of(micro_sents) == [
        ("a", 0, 0, ["cats", "chase", "mice"]),
        ("a", 0, 1, ["cats", "like", "cheese"]),
        ("b", 0, 0, ["mice", "like", "cheese"]),
        ("b", 1, 0, ["dogs", "chase", "cats"]),
        ("b", 1, 1, ["dogs", "ca", "nt", "fly"]),
    ]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Café", "café"), ("Ⅷ", "ⅷ"), ("हिन", "हिन"), ("ªº", "ªº"), ("İstanbul", "istanbul"),
        ("x_y", "xy"), ("a1b2", "ab"), ("don’t", "dont"), ("a\u00a0b", "a b"),
    ],
)
def test_unicode_cleaning(spark, raw, clean):
    df = spark.createDataFrame([(1, raw)], "doc_id int, text string")
    toks = corpus.sentences(corpus.read_lines(df)).first()["toks"]
    assert toks == clean.split(" ")


def test_blank_and_wordless_lines_vanish(spark):
    df = spark.createDataFrame([(1, "\n  \t \r\n12 34 -- !\n a ")], "doc_id int, text string")
    lines = corpus.read_lines(df)
    assert rows_of(lines) == [(1, 2, "12 34 -- !"), (1, 3, "a")]
    assert rows_of(corpus.sentences(lines)) == [(1, 3, 0, ["a"])]


def test_custom_preprocessor_and_abbreviations(spark):
    df = spark.createDataFrame([(1, "Mr. X1 met Dr. Who. Ok B2!")], "doc_id int, text string")
    lines = corpus.read_lines(df)
    keep_digits = tx.regex_preprocessor(r"[^\p{IsAlphabetic}0-9 ]")
    sents = corpus.sentences(lines, "whitespace", keep_digits, abbreviations=["mr", "Dr"])
    assert rows_of(sents, "sent_no", "toks") == [
        (0, ["mr", "x1", "met", "dr", "who"]), (1, ["ok", "b2"]),
    ]

    @F.pandas_udf("array<string>")
    def shout(toks):
        return toks.map(lambda ts: [t.upper() for t in ts if len(t) > 1])

    loud = corpus.sentences(lines, "whitespace", lambda toks: shout(toks))
    assert rows_of(loud, "toks") == [(["MR."],), (["OK", "B2!"],), (["WHO."],), (["X1", "MET", "DR."],)]


def test_split_boundaries(spark):
    df = spark.createDataFrame([(b,) for b in (0, 79, 80, 89, 90, 100)], "b int")
    got = rows_of(df.select("b", corpus.split_name(F.col("b"), 0.8, 0.1).alias("s")))
    assert [s for _, s in got] == ["train", "train", "test", "test", "validate", "validate"]
    with pytest.raises(ValueError):
        corpus.split_lines(df, 0.8, 0.3)


def test_document_order_and_shuffle(spark, micro):
    assert rows_of(corpus.document_index(micro)) == [("a", 0), ("b", 1)]
    many = spark.range(500).select(F.col("id").alias("doc_id"))
    index = corpus.document_index(many.repartition(7))
    one = rows_of(corpus.shuffled_document_order(index, 1))
    assert one == rows_of(corpus.shuffled_document_order(index.repartition(3), 1))
    assert one != rows_of(corpus.shuffled_document_order(index, 1, epoch=1))
    assert sorted(i for _, i in one) == list(range(500))


def abbreviating_corpus(spark):
    """Invented prose in which 'Dr.' and 'approx.' are abbreviations and other periods end sentences."""
    rng = random.Random(3)
    names, things = ["Weber", "Klein", "Adler"], ["dogs", "cats", "birds", "cows", "goats"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rng.randint(2, 5)):
            a, b = rng.sample(things, 2)
            parts.append(rng.choice([
                f"Dr. {rng.choice(names)} saw the {a} and the {b}.", f"We found approx. forty {a} near some {b}.",
                f"The {a} were like {b}.", f"The {b} ran away!", f"We like {a}, the small {b} and old {a}.",
            ]))
        rows.append((i, 0, " ".join(parts)))
    return spark.createDataFrame(rows, "doc_id bigint, line_no int, line string")


def test_sentence_model_learns_abbreviations(spark):
    lines = abbreviating_corpus(spark)
    model = segmentation.train(lines)
    found = {r["typ"] for r in segmentation.scores(model).where("kind = 'abbreviation'").collect()}
    assert found == {"dr", "approx"}
    for row in segmentation.segment(lines, model).collect():
        want = re.split(r"(?<!Dr\.)(?<!approx\.)(?<=[.!]) ", row["line"])
        assert row["sentences"] == want


def test_segmenting_defines_odd_lines(spark):
    lines = abbreviating_corpus(spark)
    model = segmentation.train(lines)
    odd = spark.createDataFrame(
        [(1, 0, "The dogs ran. The cats too."), (1, 0, "Dr. Weber ran."), (1, 0, "Dr. Weber ran."), (None, 0, "No id. The end."), (2, 0, " "), (3, 0, "unseen. Words! here")],
        "doc_id bigint, line_no int, line string",
    )
    got = sorted((str(r["doc_id"]), r["sentences"]) for r in segmentation.segment(odd, model).collect())
    assert got == sorted([
        ("1", ["The dogs ran.", "The cats too."]), ("1", ["Dr. Weber ran."]), ("1", ["Dr. Weber ran."]), ("None", ["No id.", "The end."]),
        ("2", []), ("3", ["unseen.", "Words!", "here"]),
    ])
    empty = segmentation.train(lines.where("false"))
    assert empty.types.count() == 0 and segmentation.segment(lines.where("false"), empty).count() == 0
    assert segmentation.segment(odd.limit(1), empty).first()["sentences"] == ["The dogs ran.", "The cats too."]


def test_blanks_are_no_matches_of_the_white_space_class(spark):
    """Words are apart by blanks already; replacing each by itself was most of the tokeniser's work."""
    assert not re.search(tx.SPACE_CLASS.replace("\\x{85}", "\x85").split("\\x{A0}")[0] + "]", " ")
    line = "A\tb c d  e.  GoNNa f caNNOT"
    df = spark.createDataFrame([(0, line), (1, "  can't　stop "), (2, "--- 12")], "doc_id int, text string")
    found = corpus.sentences(corpus.read_lines(df)).orderBy("doc_id", "sent_no").collect()
    assert [r["toks"] for r in found] == [
        ["a", "b", "c", "d", "e"], ["gon", "na", "f", "can", "not"], ["ca", "nt", "stop"]
    ]


def test_words_are_described_as_defined_and_with_few_patterns(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("aZéß1(\"'[{«“‘¿¡)]}»”’,;:.!?\\-") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    words += ["word", "Word", "Über", "ǅ", "3.5.", "etc.,", "No.)", "...", "end!\"", "(a)", "…", "x́", "漢字"]
    told = spark.createDataFrame([(w,) for w in words], "w string").select("w", segmentation.describe(F.col("w")).alias("t"))
    for row in told.collect():
        core = re.sub(r"[)\"'\]}»”’,;:]+$", "", re.sub(r"^[(\"'\[{«“‘¿¡]+", "", row["w"]))
        period, paused = core.endswith(".") and not core.endswith(".."), re.search(r"[,;:][)\"'\]}»”’,;:]*$", row["w"])
        end = ("paused" if paused else "period") if period else "mark" if core[-1:] in ("!", "?") and core and not paused else "plain"
        bare = (core[:-1] if period else core).lower()
        case = {"Lu": "upper", "Ll": "lower"}.get(unicodedata.category(core[0]) if core else "", "none")
        assert tuple(row["t"]) == ("#" if re.search("^[0-9][0-9.,]*$", bare) else bare, case, end), row["w"]
    # a word's core was looked for again wherever it was used, and once more for each use of the words
    lines = spark.createDataFrame([("A line.",)], "line string")
    plan = segmentation._described(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("rlike") + plan.lower().count("regexp_replace") <= 8
