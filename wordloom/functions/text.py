"""Column expressions for cleaning, segmenting and tokenising text.

All of them are built-in string functions on whole lines, so they stay in generated
code; nothing here aggregates, so they work on batch and streaming frames alike.
Inside a prepared line, ``\\n`` separates sentences and a blank separates tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space (of the class, all but the blank itself), and the default token-cleaning pattern.
ASCII_SPACE = " \t\n\r\x0b\x0c"
SPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
DEFAULT_CLEAN_REGEX = r"[^\p{IsAlphabetic} ]"

# The published Penn Treebank word-splitting rules, in their order.
TREEBANK_RULES: list[tuple[str, str]] = [
    (r'(?m)^"', "``"),
    (r"``", " `` "),
    (r'([ (\[{<])"', "$1 `` "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"(?m)([:,])$", " $1 "),
    (r"\.\.\.|[;@#$%&]", " $0 "),
    (r"""(?m)([^.\n])(\.)([\])}>"']*)[ \t]*$""", "$1 $2$3 "),
    (r"[?!]", " $0 "),
    (r"([^'\n])' ", "$1 ' "),
    (r"[\]\[(){}<>]|--", " $0 "),
    (r"(?m)^|$", " "),
    (r'"', " '' "),
    (r"(\S)('')", "$1 $2 "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    (
        r"(?i)(?<![A-Za-z0-9_])(can(?=not(?!\w))|d(?='ye(?!\w))|gim(?=me(?!\w))|gon(?=na(?!\w))"
        r"|got(?=ta(?!\w))|lem(?=me(?!\w))|mor(?='n(?!\w))|wan(?=na\s))(not|'ye|me|na|ta|'n)",
        " $1 $2 ",
    ),
    (r"(?i) ('t)(is)(?!\w)", " $1 $2 "),
    (r"(?i) ('t)(was)(?!\w)", " $1 $2 "),
]

# The same boundaries for a line without apostrophes.  Every mark that the rules set off by
# blanks can be replaced by one blank, because marks are deleted from the tokens anyway.
PLAIN_RULES: list[tuple[str, str]] = [
    (
        r"(?i)(?<![A-Za-z0-9_])(can(?=not(?!\w))|gim(?=me(?!\w))|gon(?=na(?!\w))|got(?=ta(?!\w))"
        r"|lem(?=me(?!\w))|wan(?=na(?:\s|$|[;@#$%&?!\[\](){}<>\"]|``|--|\.\.\.|[:,](?![0-9])"
        r"|\.[\])}>\"]*[ \t]*(?:\n|$))))(not|me|na|ta)",
        " $1 $2 ",
    ),
    (r"[\[\](){}<>;@#$%&?!\"]|``|--|\.\.\.|[:,](?![0-9])", " "),
]

# The first of these rules does nothing to a line without one of these, whatever their case.
PLAIN_WORDS = ["cannot", "gimme", "gonna", "gotta", "lemme", "wanna"]

TokenFilter = Callable[[Column], Column]


def strip(line: Column) -> Column:
    return F.btrim(line, F.lit(ASCII_SPACE))


def mark_sentences(line: Column, abbreviations: Sequence[str] = ()) -> Column:
    """End a sentence after ``.``, ``!`` or ``?`` followed by white space.

    ``abbreviations`` (without their final period) do not end one.
    """
    blanked = F.regexp_replace(line, SPACE_CLASS, " ")
    keep = ""
    if abbreviations:
        words = "|".join(f"\\Q{a}\\E" for a in abbreviations)
        keep = f"(?<!(?i:\\b(?:{words}))\\.)"
    return F.regexp_replace(blanked, f"([.!?]){keep} +", "$1\n")


def _rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def mark_words(
    sentences: Column, mode: str = "treebank", letters_only_of: Column | None = None
) -> Column:
    """Put blanks at token boundaries of newline-separated sentences.

    ``letters_only_of`` is the original line, given when marks will be deleted anyway: a
    line without apostrophes then takes a path of two rules instead of all of them.
    """
    if mode == "whitespace":
        return sentences
    if mode != "treebank":
        raise ValueError(f"unknown tokenizer mode {mode!r}")
    full = _rewrite(sentences, TREEBANK_RULES)
    if letters_only_of is None:
        return full
    has_apostrophe = F.contains(letters_only_of, F.lit("'"))
    lowered = F.lower(letters_only_of)
    contracted = reduce(Column.__or__, [F.contains(lowered, F.lit(word)) for word in PLAIN_WORDS])
    apart = F.when(contracted, _rewrite(sentences, PLAIN_RULES[:1])).otherwise(sentences)
    return F.when(has_apostrophe, full).otherwise(_rewrite(apart, PLAIN_RULES[1:]))


def clean_marked(marked: Column) -> Column:
    """Lower-case, and keep only letters and the two separators."""
    return F.regexp_replace(F.lower(marked), r"[^a-z \n\p{IsAlphabetic}]+", "")


def split_tokens(sentence: Column) -> Column:
    """The blank-separated tokens of a sentence that has at least one."""
    # split at one blank needs no pattern
    return F.array_remove(F.split(sentence, " "), "")


def regex_preprocessor(clean_regex: str) -> TokenFilter:
    """Token-array preprocessor: lower-case, delete matches, strip, drop empties."""

    def apply(toks: Column) -> Column:
        cleaned = F.transform(toks, lambda t: strip(F.regexp_replace(F.lower(t), clean_regex, "")))
        return F.filter(cleaned, lambda t: t != "")

    return apply
