"""Token counts and packing against the tokeniser's own library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing, tokens

LETTERS = "ab Z1²½\n\t \r\x0b\x1c\x85\xa0 ​᠎é中文字ß'sre!?.<|endoftext|>😀٣́﻿ \n'"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.tokenizer_path())


@pytest.mark.parametrize("segment", [3, 1_000_000])
def test_units_give_the_librarys_ids(library, segment, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_CHARS", segment)
    encoder, dealt = tokens.UnitEncoder(tokens.tokenizer_path(), tokens.as_packed, memo_units=34_000), random.Random(segment)
    for k in range(4000):
        text = "".join(dealt.choice(LETTERS) for _ in range(dealt.randint(0, 16))) + ("<|endoftext|>" if k % 40 == 0 else "")
        got = np.frombuffer(b"".join(encoder.values(text)), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_proven_tokens_encode_alone(library):
    encoder = tokens.UnitEncoder(tokens.tokenizer_path(), tokens.as_counts)
    assert len(encoder.proven) > 40_000
    assert all(library.encode(s, add_special_tokens=False).ids == [rank] for s, rank in list(encoder.proven.items())[::97])


def test_counts_of_odd_rows(odd, none, library):
    rows = tokens.count_tokens(odd).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert tokens.count_tokens(none).count() == 0


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_pieces_and_places(odd, none, library):
    rows = packing.pack_documents(odd, group_pieces=5).collect()
    assert packing.pack_documents(none).count() == 0
    texts: dict = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for key, several in texts.items():
        want = []
        for text in several:
            ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
            want += [(k, a, n, zlib.crc32(ids[a:a + n].tobytes())) for k, (a, n) in enumerate(packing.cut(len(ids)))]
        assert sorted(pieces[key]) == sorted(want)
    places: dict = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_local_search_packs_what_best_fit_does_not():
    # decreasing best fit puts 6 and 4 together and then needs a third bin
    lengths = np.array([6, 5, 5, 4, 4, 6])
    start = [[0, 3], [1, 2], [4], [5]]
    search = packing.LocalSearch(lengths, start, 10)
    before = (search.fill**2).sum()
    bins = search.run()
    assert len(bins) == 3 and (search.fill**2).sum() > before
    assert sorted(p for b in bins for p in b) == list(range(6))
    two_for_one = packing.LocalSearch(np.array([5, 3, 2, 4]), [[0], [1, 2, 3]], 9)
    assert sorted(p for b in two_for_one.run() for p in b) == [0, 1, 2, 3]


@pytest.mark.parametrize("low,high", [(1, 2048), (700, 1000), (500, 1400), (1, 30), (2047, 2048)])
def test_packings_are_whole_and_near_the_bound(low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 400)
    bins = packing.pack(lengths, 2048)
    assert sorted(p for b in bins for p in b) == list(range(400))
    assert all(lengths[b].sum() <= 2048 for b in bins)
    assert packing.least_bins(lengths, 2048) <= len(bins) <= len(packing.best_fit(lengths, 2048))


def test_memos_hold_no_long_units(library):
    encoder = tokens.UnitEncoder(tokens.tokenizer_path(), tokens.as_counts)
    text = " ".join(random.Random(k).choice("漢字仮名") * (50 + k) for k in range(60))
    assert sum(encoder.values(text)) == len(library.encode(text, add_special_tokens=False).ids)
    assert max(map(len, encoder.memo)) <= max(tokens.MEMO_CHARS, max(map(len, encoder.shortcut)))
