"""License scan: ordered signature rules gated by a keyword prefilter.

Signatures are regular expressions over the normalised text, which is the lower-cased words
joined by single spaces; so a rule needs no care for case, punctuation or line breaks, and each
hit has a place in words.  The hundreds of rules are written out from a table of license names and
a few templates (a grant, a title, an identifier line and so on).  Each rule has a priority by its
template.  A rule is tried on a text only if its keyword stands there, and the texts without any
keyword, nearly all, leave after one cheap test.

A hit inside a longer hit, or as long as one of higher priority, is dropped.  All steps are built-in
functions; nothing is grouped, so no license frequent enough can overload a task.  Null texts
count as empty: no words, no hits, score 0.  Only doc_id and text are read.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import alnum_words, let

# The contract's phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Names of licenses in normalised words: label, name, short name, identifier.
FAMILIES = [
    ("agpl-3.0", "gnu affero general public license", "agpl", "agpl 3 0"),
    ("gpl-2.0", "gnu general public license version 2", "gplv2", "gpl 2 0"),
    ("gpl-3.0", "gnu general public license version 3", "gplv3", "gpl 3 0"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1", "lgplv2 1", "lgpl 2 1"),
    ("lgpl-3.0", "gnu lesser general public license version 3", "lgplv3", "lgpl 3 0"),
    ("gfdl", "gnu free documentation license", "gfdl", "gfdl 1 3"),
    ("apache-1.1", "apache software license version 1 1", "asl 1 1", "apache 1 1"),
    ("apache-2.0", "apache license version 2 0", "asl 2 0", "apache 2 0"),
    ("mit", "mit license", "mit licence", "mit"),
    ("x11", "x11 license", "x11 licence", "x11"),
    ("bsd-2-clause", "bsd 2 clause license", "simplified bsd license", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause license", "new bsd license", "bsd 3 clause"),
    ("bsd-4-clause", "bsd 4 clause license", "original bsd license", "bsd 4 clause"),
    ("isc", "isc license", "isc licence", "isc"),
    ("mpl-1.1", "mozilla public license version 1 1", "mpl 1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla public license version 2 0", "mpl 2 0", "mpl 2 0"),
    ("epl-1.0", "eclipse public license version 1 0", "eclipse public license 1 0", "epl 1 0"),
    ("epl-2.0", "eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"),
    ("cddl-1.0", "common development and distribution license", "cddl license", "cddl 1 0"),
    ("cpl-1.0", "common public license version 1 0", "common public license", "cpl 1 0"),
    ("eupl-1.2", "european union public licence", "european union public license", "eupl 1 2"),
    ("artistic-2.0", "artistic license 2 0", "artistic license", "artistic 2 0"),
    ("ms-pl", "microsoft public license", "microsoft public licence", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal licence", "ms rl"),
    ("bsl-1.0", "boost software license version 1 0", "boost software license", "bsl 1 0"),
    ("zlib", "zlib license", "zlib libpng license", "zlib"),
    ("unlicense", "the unlicense", "unlicense org", "unlicense"),
    ("wtfpl", "wtfpl license", "wtfpl version 2", "wtfpl"),
    ("cc0-1.0", "cc0 1 0 universal", "cc0 public domain dedication", "cc0 1 0"),
    ("cc-by-4.0", "cc by 4 0", "creative commons cc by", "cc by 4 0"),
    ("cc-by-3.0", "cc by 3 0", "cc by 3 0 unported", "cc by 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "cc by sa license", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "cc by nc license", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "cc by nd license", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "cc by nc sa license", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "cc by nc nd license", "cc by nc nd 4 0"),
    ("cc-attribution", "creative commons attribution license", "creative commons attribution", "cc attribution"),
    ("cc-sharealike", "creative commons attribution share ?alike", "attribution share ?alike", "cc share ?alike"),
    ("odbl-1.0", "open database license", "open data commons open database license", "odbl 1 0"),
    ("ofl-1.1", "sil open font license version 1 1", "sil open font license", "ofl 1 1"),
    ("python-2.0", "python software foundation license", "psf license", "python 2 0"),
    ("postgresql", "postgresql license", "postgresql licence", "postgresql"),
    ("openssl", "openssl license", "openssl licence", "openssl"),
    ("php-3.01", "php license version 3 01", "php license", "php 3 01"),
    ("ruby", "ruby license", "ruby licence", "ruby"),
    ("vim", "vim license", "vim licence", "vim"),
    ("afl-3.0", "academic free license version 3 0", "academic free license", "afl 3 0"),
    ("osl-3.0", "open software license version 3 0", "open software license", "osl 3 0"),
]

# Templates, the most telling first: score, what every hit contains besides the name, and the
# expression around name ({n}), short name ({s}) or identifier ({i}).
UNDER = "(licensed|released|distributed|published|available|provided) under( the terms of)?( the)? "
TEMPLATES = [
    (1.0, "spdx license identifier", "spdx license identifier {i}( only| or later)?"),
    (0.95, " under ", UNDER + "{n}"),
    (0.9, " under ", UNDER + "{s}"),
    (0.85, "licen", "(license|licence) (is |type |name )?{i}"),
    (0.8, "", "{n}"),
    (0.7, "", "{s}"),
]

# Signatures that no single license owns: label, score, keyword, expression.
OTHERS = [
    ("copyright", 0.5, "copyright", "copyright( c)? [0-9]{4}"),
    ("all-rights-reserved", 0.6, "all rights reserved", "all rights reserved"),
    ("public-domain", 0.6, "public domain", "(released into|dedicated to|placed in)( the)? public domain"),
    ("warranty-disclaimer", 0.5, "without warranty", "without warranty of any kind"),
    ("proprietary", 0.6, "proprietary and confidential", "proprietary and confidential"),
]
BASE_PRIORITY = len(TEMPLATES)


@dataclass(frozen=True)
class Rule:
    """An expression to search for where both keywords stand; the least ``priority`` goes first."""

    label: str
    priority: int
    score: float
    keyword: str
    other: str
    pattern: str
    base: bool = False


def signature_rules() -> list[Rule]:
    """All rules, the highest priority (the least number) first."""
    rules = []
    for priority, (score, other, shape) in enumerate(TEMPLATES):
        for label, name, short, number in FAMILIES:
            spelled = name if "{n}" in shape else short if "{s}" in shape else number
            rules.append(Rule(label, priority, score, spelled.split(" ?")[0], other, shape.format(n=name, s=short, i=number)))
    rules += [Rule(phrase_label, BASE_PRIORITY, 0.8, phrase, "", phrase, True) for phrase, phrase_label in BASE.items()]
    return rules + [Rule(label, BASE_PRIORITY + 1, score, word, "", pattern) for label, score, word, pattern in OTHERS]


RULES = signature_rules()


def first_keywords(rules: list[Rule]) -> list[str]:
    """Few strings of which every text with a hit has one."""
    needed = {next((k for k in (r.keyword, r.other) if "licen" in k), r.keyword) for r in rules}
    needed = {"licen" if "licen" in k else k for k in needed}
    return sorted(k for k in needed if not any(o != k and o in k for o in needed))


def _places(text: Column, pattern: Column) -> Column:
    """start and end, in words, of the hits of ``pattern`` in ``text``, whose words each have a space at both sides."""
    # a hit starts behind a space and ends before one, so it is whole words
    bounded = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    words = lambda x: F.length(x) - F.length(F.translate(x, " ", ""))
    pieces = F.transform(F.split(text, bounded), words)
    hits = F.transform(F.regexp_extract_all(text, bounded, F.lit(0)), words)
    step = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def add(done: Column, s: Column) -> Column:
        # the first space stands before word 0; a hit of k spaces has k + 1 words
        first = done["at"] + s["gap"] - 1
        span = F.struct(first.alias("start"), (first + s["hit"] + 1).alias("end"))
        return F.struct((done["at"] + s["gap"] + s["hit"]).alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    return F.aggregate(step, start, add, lambda done: done["out"])


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per document: n_words, the contract's base columns, labels (base ones and the rules' left after suppression), score, n_hits."""
    words = docs.select("doc_id", alnum_words(F.col("text")).alias("words"))
    norm = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    texts = words.select("doc_id", F.size("words").cast("bigint").alias("n_words"), norm.alias("norm"))
    any_keyword = F.lit(False)
    for keyword in first_keywords(rules):
        any_keyword = any_keyword | F.contains(F.col("norm"), F.lit(keyword))
    fields = "struct<label:string,priority:int,score:double,keyword:string,other:string,pattern:string,base:boolean>"
    table = F.from_json(F.lit(json.dumps([asdict(r) for r in rules])), f"array<{fields}>")
    tried = F.filter(table, lambda r: F.contains(F.col("norm"), r["keyword"]) & F.contains(F.col("norm"), r["other"]))
    gated = texts.select("doc_id", "n_words", "norm", F.when(any_keyword, tried).otherwise(F.array().cast(f"array<{fields}>")).alias("rules"))

    def of_rule(r: Column) -> Column:
        return F.transform(
            _places(F.col("norm"), r["pattern"]),
            lambda p: F.struct(
                p["start"].alias("start"), p["end"].alias("end"), r["priority"].alias("priority"),
                r["label"].alias("label"), r["score"].alias("score"), r["base"].alias("base"),
            ),
        )

    hits = gated.select("doc_id", "n_words", F.flatten(F.transform("rules", of_rule)).alias("hits"))
    base = F.filter("hits", lambda h: h["base"])

    def stays(all_hits: Column) -> Column:
        def beaten(h: Column) -> Column:
            size = h["end"] - h["start"]

            def over(o: Column) -> Column:
                inside = (o["start"] <= h["start"]) & (o["end"] >= h["end"])
                longer = (o["end"] - o["start"]) > size
                return inside & (longer | (o["priority"] < h["priority"]))

            return F.exists(all_hits, over)

        return F.filter(all_hits, lambda h: ~beaten(h))

    found = hits.select("doc_id", "n_words", base.alias("base"), let(F.col("hits"), stays).alias("left"))
    base_labels = F.transform("base", lambda h: h["label"])
    labels = F.concat(base_labels, F.transform("left", lambda h: h["label"]))
    listed_labels = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda h: h["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h["start"])).cast("bigint").alias("last_word"),
        listed_labels(base_labels).alias("base_labels"),
        listed_labels(labels).alias("labels"),
        F.coalesce(F.array_max(F.transform("left", lambda h: h["score"])), F.lit(0.0)).alias("score"),
        F.size("left").cast("bigint").alias("n_hits"),
    )
