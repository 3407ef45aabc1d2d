"""Token counts with a whole-token shortcut.

The vocabulary is encoded once, offline, with the tokenizer's own library: the strings
that come out as a single id are *proven* whole tokens. A text is cut at spaces that stand
before a non-space, where the pre-tokenizer always cuts too; a unit (the space and what
follows it) that is a proven token counts one without any merging, and only other units
are merged, each distinct one once per memo. Their ids come from the rank form of the same
merges, and only where that is shown to be equal: the merges are numbered in the order of
their ids, and the unit has no character whose class could differ between Unicode versions.
Everything else, and a text with a special token's string, goes to the library as it is.

Defined cases: a null text counts as empty; empty text has 0 bytes and 0 tokens; every
input row gives one output row (repeated ids and null ids too); texts of any length are cut
into segments at unit borders, so memory stays bounded; other columns are not touched.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .base import kept_by_worker, over_texts, ship

ship(__name__)

#: Units that a task remembers before it starts again from the proven tokens.
MEMO_UNITS = 150_000
#: Longer units are merged each time they occur, so that the memo's bytes are bounded too.
MEMO_CHARS = 64
#: A text above this many characters is handled in segments of about this length.
SEGMENT_CHARS = 1_000_000
LIMIT = 1024
#: Characters that some Unicode versions call white space and others do not.
UNSETTLED = ("᠎", "​")
SPACE_IN_UNIT = re.compile(r" \s")
UNIT_BORDER = re.compile(r" (?=\S)")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand
    for themselves, the others take the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def as_counts(ids: np.ndarray, cuts: np.ndarray) -> list[int]:
    """The number of ids of each unit; ``cuts`` are the places where units begin."""
    return (np.append(cuts[1:], len(ids)) - cuts).tolist()


def as_packed(ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The ids of each unit as little-endian unsigned 32-bit numbers."""
    raw, ends = ids.astype("<u4").tobytes(), np.append(cuts[1:], len(ids)).tolist()
    return [raw[4 * a:4 * b] for a, b in zip(cuts.tolist(), ends)]


class UnitEncoder:
    """Reads texts by units for a byte-level BPE file. ``form`` says what is kept of each
    unit: ``as_counts`` or ``as_packed``."""

    def __init__(self, path: str, form: Callable[[np.ndarray, np.ndarray], list], memo_units: int = MEMO_UNITS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library, self.form, self.limit = Tokenizer.from_file(path), form, memo_units
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.whole_text = (*special, *UNSETTLED)
        letters = byte_letters()
        self.ranks = {bytes(letters[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special}
        self.rank_form = self._merges_follow_ids(spec)
        self.fast = tiktoken.Encoding("merges", pat_str=self._pattern(), mergeable_ranks=self.ranks, special_tokens={}) if self.rank_form else None
        self.begins_unit = np.zeros(max(self.ranks.values()) + 1, bool)
        self.begins_unit[[rank for token, rank in self.ranks.items() if token[:1] == b" "]] = True
        self.settled = {chr(c) for c in range(128)}
        self.unsettled: set[str] = set()
        self.proven = self._prove()
        self.shortcut = {unit[1:]: self._one([rank]) for unit, rank in self.proven.items() if unit[0] == " " and unit[1:2].strip() and not SPACE_IN_UNIT.search(unit)}
        self.shortcut[""] = self._one(self._by_library(" "))
        self.memo = dict(self.shortcut)

    @staticmethod
    def _pattern() -> str:
        import public_tokenizers

        return public_tokenizers.PATTERN

    @staticmethod
    def _merges_follow_ids(spec: dict) -> bool:
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        vocabulary = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [vocabulary["".join(pair)] for pair in pairs]
        return (
            made == list(range(made[0], made[0] + len(made))) and made[0] == 256 and spec["normalizer"] is None
            and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        )

    def _prove(self) -> dict[str, int]:
        """Vocabulary strings that the library encodes alone as the one token they name."""
        strings = {}
        for token, rank in self.ranks.items():
            try:
                strings[token.decode()] = rank
            except UnicodeDecodeError:
                pass
        encoded = self.library.encode_batch_fast(list(strings), add_special_tokens=False)
        return {s: rank for (s, rank), e in zip(strings.items(), encoded) if e.ids == [rank]}

    def _settle(self, char: str) -> bool:
        """Whether the character has had one class (letter, number, other) in all Unicode
        versions, is no space, and the library sees that class."""
        group = lambda category: category[0] if category[0] in "LNZC" else "S"
        now, then = group(unicodedata.category(char)), group(unicodedata.ucd_3_2_0.category(char))
        seen = {before: len(self.library.pre_tokenizer.pre_tokenize_str(before + char)) == 1 for before in "a1!"}
        known = now == then and now in "LNS" and seen == {"a": now == "L", "1": now == "N", "!": now == "S"}
        (self.settled if known else self.unsettled).add(char)
        return known

    def _plain(self, text: str) -> bool:
        if not self.rank_form or text.isascii() or self.settled.issuperset(text):
            return self.rank_form
        return self.unsettled.isdisjoint(text) and all([self._settle(c) for c in set(text) - self.settled])

    def _by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _ids(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text) if self._plain(text) else self._by_library(text)

    def _one(self, ids: list[int]) -> object:
        return self.form(np.array(ids, np.uint32), np.zeros(1, np.int64))[0]

    def _learn(self, units: list[str], simple: bool) -> list:
        """Merge the units and remember them; ``simple`` units hold no space."""
        values = None
        if simple and self._plain(joined := " " + " ".join(units)):
            ids = np.array(self.fast.encode_ordinary(joined), np.uint32)
            cuts = np.flatnonzero(self.begins_unit[ids])
            values = self.form(ids, cuts) if len(cuts) == len(units) else None
        if values is None:
            values = [self._one(self._ids(" " + unit)) for unit in units]
        if len(self.memo) + len(units) > self.limit:
            self.memo = dict(self.shortcut)
        self.memo.update((unit, value) for unit, value in zip(units, values) if len(unit) <= MEMO_CHARS)
        return values

    def _segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """Pieces of the text, cut where a unit begins; whether the cut took a space away."""
        at, cut = 0, False
        while len(text) - at > SEGMENT_CHARS:
            border = UNIT_BORDER.search(text, at + SEGMENT_CHARS)
            if not border:
                break
            yield cut, text[at:border.start()]
            at, cut = border.end(), True
        yield cut, text[at:] if at else text

    def values(self, text: str | None) -> Iterator[object]:
        """What is kept of the text's units, in order."""
        if not text:
            return iter(())
        if any(s in text for s in self.whole_text):
            return iter((self._one(self._by_library(text)),))
        return chain.from_iterable(self._segment(cut, segment) for cut, segment in self._segments(text))

    def _segment(self, cut: bool, segment: str) -> Iterator[object]:
        simple = not SPACE_IN_UNIT.search(segment)
        units = segment.split(" ") if simple else UNIT_BORDER.split(segment)
        first = () if cut else self._first(units.pop(0))
        found = list(map(self.memo.get, units))
        if None in found:
            unknown = [at for at, value in enumerate(found) if value is None]
            for at, value in zip(unknown, self._learn([units[at] for at in unknown], simple)):
                found[at] = value
        return chain(first, found)

    def _first(self, unit: str) -> tuple:
        if not unit:
            return ()
        rank = self.proven.get(unit)
        return (self._one([rank] if rank is not None else self._ids(unit)),)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and whether they exceed ``limit``, for every row."""
    path = path or tokenizer_path()

    def make() -> Callable[[list], dict]:
        encoder = kept_by_worker(("token counts", path), lambda: UnitEncoder(path, as_counts))

        def count(texts: list) -> dict:
            tokens = [sum(encoder.values(text)) for text in texts]
            return {
                "n_bytes": [len(text.encode()) if text else 0 for text in texts],
                "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

        return count

    return over_texts(docs, id_col, text_col, make, "n_bytes long, n_tokens long, over_limit boolean")
