"""Packed ids: round trips, random access, and the tokeniser's own library."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluice.llm import bitpacking
from sluice.llm.tokens import tokenizer_path
from sluice.session import scratch_path

LETTERS = "ab Z1²½\n\t \r\x0b\x1c\x85\xa0 ​᠎é中文字ß'sre!?._<|endoftext|>😀٣́﻿ \n'ΣσİŻ가ᄀ”—"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
@pytest.mark.parametrize("count", [0, 1, 63, 64, 65, 1000])
def test_bits_come_back(bits, count):
    ids = np.random.default_rng(count).integers(0, 1 << bits, count, dtype=np.uint64)
    words = bitpacking.pack_bits(ids, bits)
    assert len(words) == -(-count // 64) * bits
    assert (bitpacking.unpack_bits(words, bits, count) == ids).all()


def test_bits_for():
    assert [bitpacking.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


def packed(documents, bits, block_ids):
    stream = io.BytesIO()
    stream.close, keep = lambda: None, stream
    writer = bitpacking.PackedWriter(stream, bits, block_ids)
    for name, ids in documents:
        writer.add(name, iter(np.array_split(ids, 3)))
    writer.close()
    return bitpacking.PackedFile(pa.BufferReader(keep.getvalue()))


@pytest.mark.parametrize("block_ids", [64, 4096])
def test_random_access_reads_its_blocks_only(block_ids):
    dealt = np.random.default_rng(3)
    documents = [(k if k % 7 else None, dealt.integers(0, 50_000, n).astype("<u4")) for k, n in enumerate([0, 1, 63, 64, 65, 10_000, 3, 0, 700])]
    file = packed(documents, 17, block_ids)
    every = np.concatenate([ids for _, ids in documents])
    assert file.n_ids == len(every) and file.null.tolist() == [d is None for d, _ in documents]
    for number, (_, ids) in enumerate(documents):
        assert (file.document(number) == ids).all()
    for start, count in ((0, 5), (63, 2), (4095, 3), (9_000, 1200), (len(every) - 1, 1)):
        assert (file.ids(start, count) == every[start:start + count]).all()
    reads = []
    plain = file._read
    file._read = lambda at, count: reads.append(count) or plain(at, count)
    file.ids(4097, 1)
    assert reads == [block_ids * 17 // 8]
    assert list(file.checksums(128)) == [zlib.crc32(ids.tobytes()) for _, ids in documents]


@pytest.mark.parametrize("segment,memo", [(3, 50), (1_000_000, 200_000)])
def test_words_give_the_librarys_ids(library, segment, memo, monkeypatch):
    monkeypatch.setattr(bitpacking, "SEGMENT_CHARS", segment)
    encoder, dealt = bitpacking.WordEncoder(tokenizer_path("word_bpe_49k.json"), memo), random.Random(segment)
    assert encoder.rank_form
    for k in range(4000):
        text = "".join(dealt.choice(LETTERS) for _ in range(dealt.randint(0, 16))) + ("<|endoftext|>x" if k % 40 == 0 else "")
        got = np.frombuffer(b"".join(encoder.ids(text)), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(encoder.memo) <= memo + 20
    assert max(map(len, encoder.memo)) <= bitpacking.MEMO_CHARS


def test_a_file_of_another_form_goes_to_the_library():
    path = tokenizer_path("byte_bpe_50k.json")
    encoder, other = bitpacking.WordEncoder(path), Tokenizer.from_file(path)
    assert not encoder.rank_form
    text = "Some  text\n with  spaces "
    assert np.frombuffer(b"".join(encoder.ids(text)), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    want, start = [], 0
    for name, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return want


def test_documents_in_order_of_ids(spark, make, library):
    dealt = random.Random(5)
    texts = ["".join(dealt.choice(LETTERS) for _ in range(dealt.randint(0, 90))) for _ in range(300)]
    rows = list(enumerate(texts, 1))
    path = scratch_path(spark, "packed")
    manifest = bitpacking.write_packed(make(texts).repartition(5), path, block_ids=64, file_text_bytes=2000)
    assert manifest.count() > 3
    got = sorted(tuple(r) for r in bitpacking.read_digests(spark, path).collect())
    assert got == expected(rows, library)
    ids = {r["doc_id"]: r["ids"] for r in bitpacking.read_ids(spark, path).collect()}
    assert ids[7] == library.encode(texts[6], add_special_tokens=False).ids + [1]


def test_odd_rows(spark, odd, none, library):
    path = scratch_path(spark, "packed")
    bitpacking.write_packed(odd, path)
    got = sorted((tuple(r) for r in bitpacking.read_digests(spark, path).collect()), key=lambda r: r[1])
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert [r[0] for r in got] == sorted((n for n, _ in rows), key=lambda n: (n is not None, n or 0))
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
    assert sorted((str(n), length, crc) for n, _, length, crc in got) == sorted((str(n), length, crc) for n, _, length, crc in expected(rows, library))
    path = scratch_path(spark, "packed")
    assert bitpacking.write_packed(none, path).count() == 0
    assert bitpacking.read_digests(spark, path).count() == 0
