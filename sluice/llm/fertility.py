"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback reads every word of a text. Three measures follow:
characters per token, the share of tokens that are single fallback bytes, and the entropy of
the text's tokens. Each has a band per language (per script where the language is unknown)
and length, taken from the whole corpus: the middle half of the documents that pass the
plain rules, widened by ``WIDTH`` times its own breadth, and never narrower than
``LEAST_BREADTH``. A document outside a band is rejected. A group of fewer than ``LEAST_DOCS``
documents takes the bands of its language or script at all lengths, then those of the corpus.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. The plain rules reject texts of under 50 words and texts more than half of
whose words lie in repeated three-word windows.

Defined cases: null and empty texts have no words, null measures, and fail the plain rules;
an empty table gives no rows; repeated rows give one row each and count in the bands each;
words are tokenised one by one, so the measures do not depend on the text's length limits;
other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable

import numpy as np
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .base import over_texts, ship

ship(__name__)

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
LEAST_WORDS, REPEAT_SHARE, WINDOW = 50, 50, 3
MEASURES = ("chars_per_token", "fallback_share", "entropy")
WIDTH, LEAST_DOCS = 3.0, 30
#: Bands are at least this far to either side of the middle half.
LEAST_BREADTH = {"chars_per_token": 0.25, "fallback_share": 0.02, "entropy": 0.25}
#: Words that are remembered, and the longest of them.
MEMO_WORDS, MEMO_BYTES = 300_000, 64
#: Bands (a row per language and length class) are broadcast up to this many rows.
BROADCAST_BANDS = 20_000


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """Ids of words, packed as unsigned 16-bit numbers and remembered."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.model, self.limit = sentencepiece.SentencePieceProcessor(model_file=path), memo_words
        size = self.model.get_piece_size()
        if size > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 pieces are not supported")
        self.is_fallback = np.array([self.model.is_byte(k) for k in range(size)])
        self.memo: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.memo.get, words))
        if None in found:
            unknown = list({words[at] for at, value in enumerate(found) if value is None})
            encoded = self.model.encode([w.decode() for w in unknown], num_threads=1)
            learned = {w: np.array(e, np.uint16).tobytes() for w, e in zip(unknown, encoded)}
            if len(self.memo) + len(learned) > self.limit:
                self.memo = {}
            self.memo.update((w, value) for w, value in learned.items() if len(w) <= MEMO_BYTES)
            found = [learned[w] if value is None else value for w, value in zip(words, found)]
        return np.frombuffer(b"".join(found), np.uint16)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    code = ids[:count]
    for k in range(1, window):
        _, code = np.unique(code * len(number) + ids[k:k + count], return_inverse=True)
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:k + count] |= again
    return int(covered.sum())


def script_of(text: str) -> str:
    """The script that most of the text's letters are named after."""
    names: Counter = Counter()
    for c, n in Counter(text).items():
        if c.isalpha():
            names[unicodedata.name(c, "?").split()[0]] += n
    return names.most_common(1)[0][0] if names else "NONE"


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the ids' own distribution."""
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(counts * np.log2(counts)).sum())


def measure(text: str | None, tokens: WordTokens) -> tuple:
    text = text or ""
    words = text.encode().split()
    if not words:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0, None, None, None, 0, None
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    ids = tokens.ids(words)
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
        chars / len(ids), float(tokens.is_fallback[ids].mean()), entropy(ids), len(ids), script_of(text),
    )


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars_per_token double, fallback_share double, entropy double, n_tokens long, script string"


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = None, path: str | None = None) -> DataFrame:
    """Per row: its id, the plain counts, the three measures, and the group of its bands."""
    path = path or model_path()
    names = [part.split()[0] for part in COLUMNS.split(", ")]

    def make() -> Callable[..., dict]:
        tokens = WordTokens(path)

        def run(texts: list, groups: list | None = None) -> dict:
            columns = list(zip(*(measure(text, tokens) for text in texts)))
            return dict(zip(names, map(list, columns))) | {"grp": groups or [None] * len(texts)}

        return run

    more = (group_col,) if group_col else ()
    found = over_texts(docs, id_col, text_col, make, f"{COLUMNS}, grp string", *more)
    return found.withColumn("grp", F.coalesce("grp", "script")).withColumn("size_class", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int"))


def bands(measured: DataFrame, width: float = WIDTH) -> DataFrame:
    """(grp, size_class, measure bands) for groups, groups at all lengths (size_class null)
    and the corpus (both null)."""
    usable = measured.where(~F.col("base_failed"))
    thirds = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.75)), 1000).alias(m) for m in MEASURES]
    levels = usable.rollup("grp", "size_class").agg(F.count("*").alias("docs"), *thirds)
    columns = []
    for m in MEASURES:
        reach = F.greatest((F.col(m)[1] - F.col(m)[0]) * width, F.lit(LEAST_BREADTH[m]))
        columns += [(F.col(m)[0] - reach).alias(f"{m}_low"), (F.col(m)[1] + reach).alias(f"{m}_high")]
    return levels.where((F.col("docs") >= LEAST_DOCS) | F.col("grp").isNull()).select("grp", "size_class", *columns)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = None, path: str | None = None, width: float = WIDTH) -> DataFrame:
    """All measures per row, base_failed, outside (measures beyond their bands) and kept."""
    measured = measures(docs, id_col, text_col, group_col, path)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    measured = cut_lineage(measured.withColumn("base_failed", failed))
    limits = cut_lineage(bands(measured, width))
    sent = F.broadcast if limits.count() <= BROADCAST_BANDS else lambda df: df
    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    level = lambda name, where: sent(limits.where(where).select("grp", "size_class", F.struct(*sides).alias(name)))
    joined = measured.join(level("own", "size_class IS NOT NULL"), ["grp", "size_class"], "left")
    joined = joined.join(level("wider", "grp IS NOT NULL AND size_class IS NULL").drop("size_class"), "grp", "left")
    widest = limits.where("grp IS NULL AND size_class IS NULL").select(F.struct(*sides).alias("widest")).first()  # one row
    joined = joined.withColumn("widest", F.struct(*(F.lit(widest["widest"][s] if widest else None).cast("double").alias(s) for s in sides)))
    band = F.coalesce("own", "wider", "widest")

    def beyond(m: str) -> Column:
        return F.coalesce((F.col(m) < band[f"{m}_low"]) | (F.col(m) > band[f"{m}_high"]), F.lit(False))

    outside = F.array_compact(F.array(*(F.when(beyond(m), F.lit(m)) for m in MEASURES)))
    return joined.withColumn("outside", outside).withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0)).drop("own", "wider", "widest")
