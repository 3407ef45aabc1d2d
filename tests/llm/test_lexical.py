"""Ranked search against scoring everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=50):
    docs = [(name, Counter(terms(text))) for name, text in rows]
    docs = [(name, found, sum(found.values())) for name, found in docs if found]
    count, total = len(docs), sum(n for _, _, n in docs)
    held = Counter(t for _, found, _ in docs for t in found)
    out = []
    for item, text in items:
        scored = []
        for name, found, n in docs:
            m = 50 + (50 * n * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * held[t] + 1))) * ((10**9 * found[t]) // (1000 * found[t] + 20 * m)) for t in set(terms(text)) if t in found)
            if score > 0:
                scored.append((name, score))
        scored.sort(key=lambda r: (-r[1], r[0] is not None, r[0] or 0))
        out += [(item, k, name, score) for k, (name, score) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def words(seed, count, low=0, high=60):
    dealt = random.Random(seed)
    return [" ".join(f"W{int(dealt.paretovariate(0.7)) % 500}" for _ in range(dealt.randint(low, high))) for _ in range(count)]


def ranked(docs, items, **more):
    return sorted((tuple(r) for r in lexical.rank_documents(docs, items, **more).collect()), key=str)


def items_of(spark, texts):
    return spark.createDataFrame([(k, t, 1, 2, "x") for k, t in enumerate(texts)], "item_id long, text string, query int, rank int, id string")


@pytest.mark.parametrize("rows,first,block_bytes", [(16, 8, 4_000_000), (4096, 4096, 300), (16, 200, 300)])
def test_equal_to_scoring_everything(spark, make, monkeypatch, rows, first, block_bytes):
    monkeypatch.setattr(lexical, "BLOCK_ROWS", rows)
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 4)
    monkeypatch.setattr(lexical, "FIRST_ROWS", first)
    found, asked = words(1, 500), words(2, 12, 3, 12) + ["", None, "w1 W1 w2", "nowhere at all"]
    found += [found[3]] * 70  # more equal scores than there are places
    got = ranked(make(found), items_of(spark, asked), block_bytes=block_bytes, top=20)
    assert got == brute(list(enumerate(found, 1)), list(enumerate(asked)), 20)


def test_odd_rows(spark, odd, none):
    asked = ["Word of SEVEN words", "ünïcode 漢字 ok", "x", "plain one", None]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert ranked(odd, items_of(spark, asked)) == brute(rows, list(enumerate(asked)))
    assert ranked(none, items_of(spark, asked)) == []
    assert ranked(odd, items_of(spark, asked).limit(0)) == []


@pytest.mark.parametrize("segment", [7, 4_000_000])
def test_terms(monkeypatch, segment):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
    dealt = random.Random(3)
    for _ in range(500):
        text = "".join(dealt.choice("aZ09 _-.é漢\x00\x7f\n/:@[`{~ \xa0") for _ in range(dealt.randint(0, 40)))
        assert [t.decode() for part in lexical.terms_of(text) for t in part] == terms(text)


def test_buckets_and_bounds_leave_out_most_and_lose_none(monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 32)
    import pyarrow as pa
    dealt = np.random.default_rng(4)
    weights = dealt.integers(1, 9000, 300)
    vectors = []
    for k in range(4000):
        own = np.sort(dealt.choice(300, dealt.integers(1, 12), replace=False))
        vectors.append((k, own, dealt.integers(1, 1000, len(own)) * int(10 ** dealt.uniform(0, 3))))
    norm = [math.sqrt(float((v.astype(float) ** 2).sum())) for _, _, v in vectors]
    block = pa.RecordBatch.from_arrays(
        [pa.array(range(4000), pa.int64()), pa.array(norm), pa.array([t.astype("<u4").tobytes() for _, t, _ in vectors]), pa.array([v.astype("<u4").tobytes() for _, _, v in vectors])],
        names=["id", "norm", "terms", "impacts"])
    queries = [np.sort(dealt.choice(300, 8, replace=False)) for _ in range(20)]
    search = lexical.Search(queries, weights, np.zeros(20, np.int64), 10)
    search.add_block(block)
    for q, own in enumerate(queries):
        want = sorted(((-sum(int(weights[t]) * int(v) for t, v in zip(terms, values) if t in set(own.tolist())), k) for k, terms, values in vectors))[:10]
        assert [(-s, k) for s, k in zip(search.found[q][0].tolist(), search.found[q][1].tolist())] == want
    assert search.bounded < 0.5 * 20 * 4000 and search.scored < 0.8 * search.bounded
