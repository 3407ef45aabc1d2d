"""Personal data by candidate gradient boosting.

Four kinds have fixed base patterns (email, ip, card, phone); their spans are always found.
Beyond them, generators with high recall propose spans that may overlap: anything that looks
like an address with a spelled-out or bracketed @, any run of digits and separators, any
dotted run of numbers. Boosted trees score each proposal by its format and context, and a
threshold per kind, calibrated on proposals the trees have not seen, selects what is added.

No table has spans marked, so the trees learn from the corpus itself: base spans in their
places, also rewritten as people disguise them (no plus sign, other separators, ``name at
host dot org``), against proposals that are no base span and numbers of other uses (dates,
prices, counts, versions) put in the same places. The sample is about ``SAMPLE_DOCS``
documents with a digit or an @, chosen by a hash of their text, and at most
``SAMPLE_SPANS`` places of each.

Defined cases: null counts as empty; an empty text has no span; overlapping spans of
different kinds are all reported; added spans never overlap a base span; with no base span
in the sample nothing is added; repeated rows give one row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from random import Random

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .base import change_text, over_texts, ship
from .samples import turn

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_SPANS = 4000, 20
#: Added spans must be right this often among held-out proposals of the sample.
PRECISION, LEAST_HELD = 0.99, 20
NEAR = 40

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ADDRESS_LIKE = re.compile(r"[\w.%+-]{1,64}(?:\s?[\[({]\s?(?:at|@)\s?[\])}]\s?|\s?@\s?|\sat\s)[\w-]{1,63}(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\.|\sdot\s)[\w-]{1,63}){1,5}", re.I)
#: What an address without @ holds: every match of ADDRESS_LIKE has a match of this one, or an @.
AT_SIGN = re.compile(r"[\[({]\s?at\s?[\])}]|\sat\s[\w-]{1,63}(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]|\.|\sdot\s)", re.I)
NUMBER_LIKE = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20().\-/]{0,3}[0-9]){6,22}(?![0-9A-Za-z])")
DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[\[(]?\.[\])]?\s?[0-9]{1,3}){3}(?![0-9.])")
CUE = re.compile(r"\b(?:tel|phone|call|fax|mobile|cell|mail|e-?mail|contact|write|card|visa|account|iban|ip|host|server|address)\b", re.I)


def email_spans(text: str) -> list[tuple[int, int]]:
    """What leftmost matches of the pattern give, found from each @, so that long runs of
    letters cost no more than their length."""
    spans, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            spans.append((start, last))
        at = text.find("@", max(at + 1, last))
        last = max(last, 0)
    return spans


def luhn(digits: str) -> bool:
    values = np.frombuffer(digits.encode(), np.uint8)[::-1].astype(np.int64) - 48
    doubled = values[1::2] * 2
    return int(values[::2].sum() + (doubled - 9 * (doubled > 9)).sum()) % 10 == 0


def is_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if not text:
        return found
    found["email"] = email_spans(text)
    if not DIGIT.search(text):
        return found
    found["ip"] = [m.span() for m in IP.finditer(text) if all(map(is_octet, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    if "+" in text:
        found["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdecimal, m.group())) <= 15]
    return found


def proposals(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything that might be personal data; kinds may overlap."""
    out = []
    if "@" in text or AT_SIGN.search(text):
        out += [("email", *m.span()) for m in ADDRESS_LIKE.finditer(text) if " at " not in m.group().lower() or re.search(r"dot|[\[({]", m.group(), re.I)]
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in DOTTED.finditer(text)]
        for m in NUMBER_LIKE.finditer(text):
            n = sum(c.isdecimal() for c in m.group())
            if n >= 13:
                out.append(("card", *m.span()))
            if 7 <= n <= 15:
                out.append(("phone", *m.span()))
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, as numbers."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    groups = re.findall(r"[0-9]+", span)
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    around = text[max(0, start - NEAR):start]
    kind_of = lambda c: 0 if not c else 1 if c.isalpha() else 2 if c.isdecimal() else 3 if c.isspace() else 4
    letters = sum(c.isalpha() for c in span)
    return [
        KINDS.index(kind), len(span), len(digits), letters, len(groups), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        max(map(len, groups), default=0), min(map(len, groups), default=0), span.count("."), span.count("-"), span.count(" "), span.count("/"),
        span.count("(") + span.count("["), span.startswith("+"), "@" in span, len(digits) in range(13, 20) and luhn(digits) if digits else 0,
        all(map(is_octet, groups)) and len(groups) == 4, digits[:2] in ("19", "20"), len(set(digits)), kind_of(before), kind_of(after),
        bool(CUE.search(around)), sum(c.isdecimal() for c in around), sum(c.isalpha() for c in around),
    ]


class BoostedTrees:
    """Logistic boosting of small trees over quantile bins of the features."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 10):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees: list[list[tuple]] = []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(edges, x[:, k], "right") for k, edges in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T]
        binned, prior = self._binned(x), np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(prior / (1 - prior)))
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree: list[tuple] = []
            score += self._grow(tree, binned, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
        return self

    def _grow(self, tree: list, binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """Adds nodes (feature, bin, left, right) or leaves (value,); the change per row."""
        at = len(tree)
        tree.append(())
        g, h, best = gradient[rows].sum(), weight[rows].sum(), (1e-6, None, None)
        change = np.zeros(len(gradient))
        if depth:
            for feature in range(binned.shape[1]):
                column = binned[rows, feature]
                size = len(self.edges[feature]) + 1
                gs, hs, ns = (np.bincount(column, w, size).cumsum()[:-1] for w in (gradient[rows], weight[rows], np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), feature, int(gain.argmax()))
        _, feature, cut = best
        if feature is None:
            tree[at] = (self.rate * g / (h + 1),)
            change[rows] = tree[at][0]
            return change
        left = binned[rows, feature] <= cut
        first = len(tree)
        change += self._grow(tree, binned, gradient, weight, rows[left], depth - 1)
        second = len(tree)
        change += self._grow(tree, binned, gradient, weight, rows[~left], depth - 1)
        tree[at] = (feature, cut, first, second)
        return change

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned, score = self._binned(x), np.full(len(x), self.start)
        for tree in self.trees:
            node = np.zeros(len(x), np.int64)
            for number, entry in enumerate(tree):
                here = node == number
                if len(entry) == 1:
                    score[here] += entry[0]
                elif here.any():
                    feature, cut, first, second = entry
                    node[here] = np.where(binned[here, feature] <= cut, first, second)
        return 1 / (1 + np.exp(-score))


def disguises(kind: str, span: str, random: Random) -> list[str]:
    """Other ways to write a base span that its pattern may miss."""
    if kind == "email":
        name, _, host = span.partition("@")
        return [f"{name} at {host.replace('.', ' dot ')}", f"{name} [at] {host}", f"{name}(at){host.replace('.', '(dot)')}", f"{name} @ {host}"]
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "phone":
        return [span[1:], f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}.{digits[-7:-4]}.{digits[-4:]}", f"00{digits}"]
    if kind == "card":
        return [random.choice((".", "/", "  ")).join(digits[k:k + 4] for k in range(0, len(digits), 4)), digits]
    return [span.replace(".", "[.]"), span.replace(".", " . ")]


def other_numbers(random: Random) -> list[str]:
    """Numbers that are no personal data: dates, counts, prices, versions, ranges, serials."""
    n = lambda low, high: random.randint(low, high)
    return [
        f"{n(1900, 2060)}-{n(1, 12):02d}-{n(1, 28):02d}", f"{n(1, 28):02d}/{n(1, 12):02d}/{n(1900, 2060)}", f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2060)}", f"{n(1900, 2060)}{n(1, 12):02d}{n(1, 28):02d}{n(0, 235959):06d}",
        str(n(10**6, 10**12)), f"{n(1, 999)}.{n(0, 999):03d}.{n(0, 999):03d}", f"{n(0, 9)}.{n(0, 30)}.{n(0, 999)}.{n(256, 999)}", f"{n(1000, 9999)}-{n(1000, 9999)}", str(n(10**12, 10**18)), f"{n(1900, 2060)}-{n(1900, 2060)} {n(1, 99)}",
    ]


def examples(places: list[tuple[str, int, int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and halves from places (surrounding text, start, end, kind or "")."""
    rows, labels, halves = [], [], []
    for around, start, end, kind in places:
        digest = hashlib.md5(around.encode()).digest()
        random, half = Random(digest), digest[0] % 2
        written = [(around[start:end], kind)] + [(other, kind) for other in (disguises(kind, around[start:end], random) if kind else ())]
        written += [(number, "") for number in random.sample(other_numbers(random), 3)]
        for span, truth in written:
            text = around[:start] + span + around[end:]
            for own, a, b in proposals(text):
                overlap = min(b, start + len(span)) - max(a, start)
                if overlap <= 0 or truth and overlap < 0.8 * max(b - a, len(span)):
                    continue
                rows.append(features(text, own, a, b))
                labels.append(float(own == truth))
                halves.append(half)
    return np.array(rows, float), np.array(labels), np.array(halves)


def fit(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION) -> dict | None:
    """Trees and a threshold per kind; None where the sample has nothing to learn from."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    total = texts.count()
    # copies share a hash, so they are chosen together; they collapse before anything is taken from them
    sample = texts.where(turn(F.col("text")) < F.lit(sample_docs / max(1, total))).distinct().select(F.lit(0).alias("id"), "text")

    def make() -> Callable[[list], dict]:
        def take(texts: list) -> dict:
            out: list[list[str]] = []
            for text in texts:
                base = [(a, b, kind) for kind, spans in base_spans(text).items() for a, b in spans]
                taken = {(a, b) for a, b, _ in base}
                other = [(a, b, "") for _, a, b in proposals(text) if not any(a < d and c < b for c, d in taken)]
                chosen = sorted(base + other, key=lambda s: hashlib.md5(text[s[0]:s[1]].encode()).digest())[:SAMPLE_SPANS]
                out.append([json.dumps({"around": text[max(0, a - NEAR):b + NEAR], "start": min(a, NEAR), "length": b - a, "kind": kind}) for a, b, kind in chosen if b - a < 200])
            return {"places": out}

        return take

    taken = over_texts(sample, "id", "text", make, "places array<string>").select(F.explode("places").alias("place"))
    taken = taken.select(F.from_json("place", "around string, start int, length int, kind string").alias("p")).select("p.*").distinct()
    places = sorted({(r["around"], r["start"], r["start"] + r["length"], r["kind"]) for r in taken.collect()})
    x, y, half = examples(places)
    if not len(y) or not 0 < y[half == 0].sum() < (half == 0).sum():
        return None
    trees = BoostedTrees().fit(x[half == 0], y[half == 0])
    p, truth, kind = trees.probability(x[half == 1]), y[half == 1], x[half == 1][:, 0]
    return {"trees": trees, "thresholds": {name: threshold(p[kind == k], truth[kind == k], precision) for k, name in enumerate(KINDS)}}


def threshold(p: np.ndarray, truth: np.ndarray, precision: float) -> float:
    """The lowest score from which on held-out proposals are right often enough; above 1 if
    there is none, or too few to tell."""
    order = np.argsort(-p, kind="stable")
    right, count = np.cumsum(truth[order]), np.arange(1, len(p) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)  # a threshold takes all equal scores
    good = np.flatnonzero((right >= precision * count) & (count >= LEAST_HELD) & last)
    return float(p[order][good[-1]]) if len(good) else 2.0


def added_spans(text: str, base: dict, model: dict | None) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if not model:
        return found
    taken = sorted(span for spans in base.values() for span in spans)
    offered = [s for s in proposals(text) if not any(s[1] < b and a < s[2] for a, b in taken)]
    if not offered:
        return found
    p = model["trees"].probability(np.array([features(text, *s) for s in offered], float))
    for k in np.argsort(-p, kind="stable"):
        kind, start, end = offered[k]
        if p[k] >= model["thresholds"][kind] and not any(start < b and a < end for a, b in taken):
            found[kind].append((start, end))
            taken.append((start, end))
    return found


def written(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def find_personal_data(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base spans per kind as arrays of (start, end), and added ones."""
    schema = ", ".join(f"{part}_{kind} array<array<int>>" for part in ("base", "added") for kind in KINDS)

    def make() -> Callable[[list], dict]:
        def run(texts: list) -> dict:
            out: dict[str, list] = {f"{part}_{kind}": [] for part in ("base", "added") for kind in KINDS}
            for text in texts:
                base = base_spans(text)
                added = added_spans(text, base, model) if text else {kind: [] for kind in KINDS}
                for kind in KINDS:
                    out[f"base_{kind}"].append([list(s) for s in base[kind]])
                    out[f"added_{kind}"].append([list(s) for s in sorted(added[kind])])
            return out

        return run

    return over_texts(docs, id_col, text_col, make, schema)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans: n_email to n_phone, base_sha256, spans."""
    def of_kind(kind: str, parts: tuple[str, ...]) -> Column:
        spans = F.array_sort(F.concat(*(F.col(f"{part}_{kind}") for part in parts)))
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s[0].cast("string"), s[1].cast("string")))

    def listed(*parts: str) -> Column:
        return F.concat_ws(",", F.concat(*(of_kind(kind, parts) for kind in KINDS)))

    counts = [F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(id_col, *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("base", "added").alias("spans"))


def redact(text: str | None, model: dict | None) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    if not text:
        return text
    base = base_spans(text)
    added = added_spans(text, base, model)
    spans = sorted((a, -b, kind) for found in (base, added) for kind in KINDS for a, b in found[kind])
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, -end)
    return "".join([*out, text[at:]]) if spans else text


def redact_documents(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    return change_text(docs, text_col, lambda: lambda texts: [redact(text, model) for text in texts])
