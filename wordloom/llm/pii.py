"""Personal data: candidate spans judged by gradient-boosted trees, beside fixed base rules.

Base rules (email, ip, card, phone) find leftmost, non-overlapping spans; those that fail their
check are dropped.  They always stay.

The method adds spans.  Generators of high recall propose overlapping candidates (digit groups,
long tokens, assigned values, looser phone, card and mail forms).  Boosted trees look at the format of a
candidate and the words around it; a logistic curve fitted on held-out documents turns their sum
into a probability, and the threshold is chosen there, too.  Of overlapping candidates above it the
likeliest stays, and none that overlaps a base span.

There are no labelled spans, so the trees learn from a bounded sample of documents in which rules
of high precision speak: validated base spans and values assigned to a secret's name are
personal, candidates that fail their form's check or have neither context nor form are not.

Null texts count as empty.  Whole texts are searched; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The contract's kinds in their order, and its patterns.  Where a match cannot begin
# behind a digit the pattern says so, which keeps long runs linear without changing what is found.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2]) % 10 == -sum(2 * v - 9 * (v > 4) for v in values[1::2]) % 10


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_END.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def _ip_ok(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _card_ok(found: str) -> bool:
    digits = NOT_DIGIT.sub("", found)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 9 <= len(NOT_DIGIT.sub("", found)) <= 15


RULES = (("ip", IP, _ip_ok), ("card", CARD, _card_ok), ("phone", PHONE, _phone_ok))


def in_order(spans: list[Span]) -> list[Span]:
    place = {k: i for i, k in enumerate((*KINDS, *EXTRA_KINDS))}
    return sorted(spans, key=lambda s: (s[1], place[s[0]], s[2]))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base rules' spans, and the matches that they drop."""
    good, bad = list(_emails(text)) if "@" in text else [], []
    for kind, pattern, ok in RULES:
        if kind == "phone" and "+" not in text:
            continue
        for m in pattern.finditer(text):
            (good if ok(m.group()) else bad).append((kind, m.start(), m.end()))
    return in_order(good), bad


class Cover:
    """Tells whether a span overlaps one of a list, by bisection."""

    def __init__(self, spans: list[Span]) -> None:
        ordered = sorted((a, b) for _, a, b in spans)
        self.exact = set(ordered)
        self.starts = [a for a, _ in ordered]
        self.ends = list(accumulate((b for _, b in ordered), max))

    def meets(self, a: int, b: int) -> bool:
        before = bisect_left(self.starts, b)
        return before > 0 and self.ends[before - 1] > a


# What the method may add: values that grant access, numbers that name a person, other contacts.
EXTRA_KINDS = ("secret", "number", "contact")
GENERATORS = (
    ("secret", re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}(?![A-Za-z0-9_-])")),
    ("secret", re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth)\b[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"']{6,})")),
    ("number", re.compile(r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")),
    ("number", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("contact", re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("contact", re.compile(r"(?i)(?<![A-Za-z0-9._%+-])[A-Z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Z0-9-]{1,64} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Z]{2,10}\b")),
    ("contact", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:])")),
)
OF_BASE = {"email": "contact", "ip": "contact", "card": "number", "phone": "contact"}
CUES = (
    re.compile(r"(?i)token|secret|passw|pwd|key|auth|credential"),
    re.compile(r"(?i)phone|tel\b|mobile|call|fax|whatsapp"),
    re.compile(r"(?i)card|visa|iban|account|konto|payment"),
    re.compile(r"(?i)mail|contact|write to"),
    re.compile(r"(?i)ssn|social|passport|born|birth|id\b"),
)
BEFORE = 32
SAMPLE_DOCS = 20_000


def candidates(text: str, base: list[Span], dropped: list[Span]) -> list[Span]:
    """All proposals, base spans included as examples of their kinds; they may overlap."""
    found = {(OF_BASE[k], a, b) for k, a, b in (*base, *dropped) if b - a > 3}
    for kind, pattern in GENERATORS:
        for m in pattern.finditer(text):
            a, b = m.span(m.lastindex or 0)
            # a long word of letters only is a word, not a value
            if kind != "secret" or m.lastindex or not text[a:b].replace("-", "").replace("_", "").isalpha():
                found.add((kind, a, b))
    return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, a, b = span
    body, ahead = text[a:b], text[max(0, a - BEFORE) : a]
    n = len(body)
    digits = sum(c.isdigit() for c in body)
    letters = sum(c.isalpha() for c in body)
    upper = sum(c.isupper() for c in body)
    hexes = sum(c in "0123456789abcdefABCDEF" for c in body)
    changes = sum(x.isdigit() != y.isdigit() for x, y in zip(body, body[1:]))
    only = NOT_DIGIT.sub("", body)
    quoted = ahead[-1:] in ("'", '"') and ahead[-1:] == text[b : b + 1]
    return [
        float(EXTRA_KINDS.index(kind)), n, digits, digits / n, letters / n, upper / n, hexes / n, len(set(body)) / n,
        changes / n, n - digits - letters, float(12 <= len(only) <= 19 and luhn(only)), float("@" in body),
        float(body[0] == "+"), body.count("."), body.count("-"), body.count(" "), float(quoted),
        float(ahead.rstrip(" \"'")[-1:] in ("=", ":")), float(text[b : b + 1].isalnum()),
        *(float(c.search(ahead) is not None) for c in CUES),
    ]


def taught(text: str, span: Span, base: Cover, dropped: Cover) -> int | None:
    """What the rules of high precision say of a candidate: 1, 0 or nothing."""
    kind, a, b = span
    if (a, b) in base.exact:
        return 1
    if base.meets(a, b):
        return None
    if (a, b) in dropped.exact:
        return 0
    body, ahead = text[a:b], text[max(0, a - BEFORE) : a]
    if kind == "secret":
        mixed = any(c.isdigit() for c in body) and any(c.isalpha() for c in body)
        named = CUES[0].search(ahead) is not None and ahead.rstrip(" \"'")[-1:] in ("=", ":")
        return int(mixed and named) if mixed == named else None
    return None


@dataclass
class Trees:
    """Boosted trees of one depth as arrays (tree, node), their bins, the calibration and the threshold."""

    edges: list[list[float]]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    slope: float
    shift: float
    threshold: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        bins = binned(rows, self.edges)
        total, inner = np.zeros(len(rows)), self.feature.shape[1]
        every = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(rows), np.intp)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (bins[every, feature[node]] > cut[node])
            total += value[node - inner]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(rows) + self.shift).clip(-30, 30)))

    def to_json(self) -> str:
        return json.dumps({k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in self.__dict__.items()})

    @staticmethod
    def from_json(found: str) -> Trees:
        x = json.loads(found)
        return Trees(x["edges"], np.array(x["feature"]), np.array(x["cut"]), np.array(x["value"]), x["slope"], x["shift"], x["threshold"])


def binned(rows: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], axis=1)


def boost(rows: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, most_bins: int = 32, l2: float = 1.0) -> Trees:
    """Fit boosted trees to the logistic loss on quantile bins, level by level."""
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, most_bins))).tolist() for j in range(rows.shape[1])]
    bins, n, inner = binned(rows, edges), len(y), 2**depth - 1
    feature, cut = np.zeros((trees, inner), int), np.full((trees, inner), most_bins)
    value, total = np.zeros((trees, inner + 1)), np.zeros(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.intp)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            local = node - first
            whole_g, whole_h = np.bincount(local, g, width), np.bincount(local, h, width)
            for j in range(rows.shape[1]):
                at = local * (most_bins + 1) + bins[:, j]
                left_g = np.bincount(at, g, width * (most_bins + 1)).reshape(width, -1).cumsum(axis=1)
                left_h = np.bincount(at, h, width * (most_bins + 1)).reshape(width, -1).cumsum(axis=1)
                right_g, right_h = whole_g[:, None] - left_g, whole_h[:, None] - left_h
                gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - (whole_g**2 / (whole_h + l2))[:, None]
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                feature[t, first : first + width][better] = j
                cut[t, first : first + width][better] = top[better]
            node = 2 * node + 1 + (bins[np.arange(n), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        total += value[t][leaf]
    return Trees(edges, feature, cut, value, 1.0, 0.0, 2.0)


def calibrate(model: Trees, rows: np.ndarray, y: np.ndarray, precision: float) -> Trees:
    """Fit the logistic curve on rows the trees have not seen and pick the least threshold of that precision there."""
    margin = model.margin(rows)
    # targets drawn in a little, so that separable rows keep a finite slope
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones(len(y))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ at).clip(-30, 30)))
        at = at + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (goal - p))
    model.slope, model.shift = float(at[0]), float(at[1])
    p = model.probability(rows)
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    fine = np.flatnonzero(right >= precision)
    model.threshold = max(0.5, float(p[order][fine[-1]])) if len(fine) else 2.0
    return model


def fit(rows: np.ndarray, y: np.ndarray, held: np.ndarray, precision: float = 0.98) -> Trees:
    """Trees from described candidates; with one class only they add nothing."""
    if len(y) < 20 or y[~held].min(initial=1) == y[~held].max(initial=0) or y[held].min(initial=1) == y[held].max(initial=0):
        return Trees([[0.0]] * rows.shape[1], np.zeros((0, 1), int), np.zeros((0, 1), int), np.zeros((0, 2)), 1.0, -30.0, 2.0)
    return calibrate(boost(rows[~held], y[~held]), rows[held], y[held], precision)


def train(docs: DataFrame, rows: int = SAMPLE_DOCS) -> Trees:
    """Learn from the candidates of about ``rows`` documents, chosen by a hash of the id."""

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for order, text in zip(batch["order"], batch["text"]):
                base, dropped = base_spans(text or "")
                good, bad = Cover(base), Cover(dropped)
                for i, span in enumerate(candidates(text or "", base, dropped)):
                    label = taught(text, span, good, bad)
                    if label is not None:
                        out.append((order, i, label, describe(text, span)))
            yield pd.DataFrame(out, columns=["order", "place", "label", "x"])

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            x = np.stack([r for b in parts for r in b["x"]])
            y, order = (np.concatenate([b[c].to_numpy() for b in parts]) for c in ("label", "order"))
        else:
            x, y, order = np.zeros((0, WIDTH)), np.zeros(0), np.zeros(0, int)
        yield pd.DataFrame({"model": [fit(x, y.astype(float), order % 4 == 0).to_json()]})

    grain = 1 << 20
    keep = int(min(1.0, rows / max(docs.count(), 1)) * grain)
    order = F.xxhash64("doc_id")
    sample = docs.where(F.pmod(order, F.lit(grain)) < keep).select(F.shiftrightunsigned(order, 20).alias("order"), "text")
    found = sample.mapInPandas(described, "order bigint, place int, label int, x array<double>")
    model = found.repartition(1).sortWithinPartitions("order", "place").mapInPandas(learned, "model string").first()
    return Trees.from_json(model["model"]) if model else fit(np.zeros((0, WIDTH)), np.zeros(0), np.zeros(0, bool))


WIDTH = len(describe("x" * 4, ("secret", 0, 4)))


def added(text: str, base: list[Span], dropped: list[Span], model: Trees) -> list[Span]:
    """Candidates beyond the base spans that the model selects."""
    fixed = Cover(base)
    free = [s for s in candidates(text, base, dropped) if not fixed.meets(s[1], s[2])]
    if not free or model.threshold > 1:
        return []
    p = model.probability(np.array([describe(text, s) for s in free]))
    taken: list[tuple[int, int, str]] = []  # by place; they do not overlap
    for i in sorted(np.flatnonzero(p >= model.threshold), key=lambda i: (-p[i], free[i][1], -free[i][2])):
        kind, a, b = free[i]
        at = bisect_left(taken, (b,))
        if not at or taken[at - 1][1] <= a:
            taken.insert(at, (a, b, kind))
    return [(kind, a, b) for a, b, kind in taken]


def find(docs: DataFrame, model: Trees) -> DataFrame:
    """Per row of ``docs``: doc_id, counts and digest of the base spans, and all spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        show = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        for batch in batches:
            out = []
            for row, text in zip(batch["doc_id"], batch["text"]):
                base, dropped = base_spans(text or "")
                every = in_order(base + added(text or "", base, dropped, model))
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                out.append((row, *counts, hashlib.sha256(show(base).encode()).hexdigest(), show(every), len(every) - len(base)))
            yield pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first is shown."""
    out, done = [], 0
    for kind, a, b in in_order(spans):
        if b > done:
            out += [text[done:a], f"[{kind}]"] if a >= done else []
            done = b
    return "".join([*out, text[done:]])


def personal_data(docs: DataFrame) -> DataFrame:
    """Train on a sample of ``docs`` and search them all."""
    return find(docs, train(docs))
