"""Spaced-seed decontamination against every alignment compared."""

import math
import random
import time
from itertools import combinations

import numpy as np
import pytest

from sluice.llm import decontaminate as d

VOCABULARY = [f"w{k}" for k in range(300)]


def brute(text, item):
    """Whether some alignment of item and text agrees in enough places of a span."""
    own, other = d.words(text), d.words(item)
    if len(other) < d.LEAST_WORDS:
        return False
    span = min(d.SPAN, len(other))
    need = span if span < 8 else math.ceil(d.AGREE * span)
    for shift in range(-len(other), len(own)):
        equal = [0 <= shift + k < len(own) and own[shift + k] == w for k, w in enumerate(other)]
        inside = [0 <= shift + k < len(own) for k in range(len(other))]
        if any(sum(equal[k:k + span]) >= need and all(inside[k:k + span]) for k in range(len(other) - span + 1)):
            return True
    return False


def test_against_every_alignment(spark, make):
    dealt = random.Random(4)
    items = [" ".join(dealt.choice(VOCABULARY) for _ in range(n)) for n in (6, 9, 13, 20, 40, 40, 600)] + ["too short item", None, ""]
    texts = []
    for item in items[:7] * 6:
        words = item.split()
        begin = dealt.randrange(max(1, len(words) - 15))
        part = words[begin:begin + dealt.randint(5, 60)]
        for _ in range(dealt.randint(0, 4)):
            part[dealt.randrange(len(part))] = dealt.choice(VOCABULARY)
        texts.append(" ".join(dealt.choice(VOCABULARY) for _ in range(30)) + ", " + " ".join(part).title() + "! " + " ".join(dealt.choice(VOCABULARY) for _ in range(30)))
    benchmark = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)] + [(99, items[4], "x")], "item_id long, text string, doc_id string")
    docs = make(texts)
    got = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, benchmark).collect()}
    want = {(k, i) for k, text in enumerate(texts, 1) for i, item in enumerate(items) if brute(text, item)}
    assert got == want | {(k, 99) for k, i in want if i == 4}
    assert {r["doc_id"] for r in d.drop_leaking(docs, benchmark).collect()} == set(range(1, len(texts) + 1)) - {k for k, _ in got}
    several = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, benchmark, block_words=60).collect()}
    assert several == got


def test_every_overlap_meets_a_mask():
    """All ways to change the allowed number of words of a span of 5 to 13."""
    places = d.mask_places()
    for span in range(d.LEAST_WORDS, d.SPAN + 1):
        changes = 0 if span < 8 else span - math.ceil(d.AGREE * span)
        for changed in combinations(range(span), changes):
            assert any(not set((start + own).tolist()) & set(changed) for own in places for start in range(span - int(own[-1]))), (span, changed)


@pytest.mark.parametrize("block_words", [3, 200_000])
def test_all_items_with_the_same_words_are_named(spark, make, block_words):
    text = "some words that are in the benchmark as they stand here"
    benchmark = spark.createDataFrame([(10, text), (11, text.upper()), (12, text), (12, text), (None, text), (13, "quite other words that nobody wrote so far")], "item_id long, text string")
    rows = d.find_leaks(make([f"before {text} behind", "nothing"]), benchmark, block_words=block_words).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(1, 10), (1, 11), (1, 12)]


def test_repeated_words_cost_little():
    index = d.SeedIndex([(1, ["word"] * 300), (2, ["other", "word"] * 150)])
    begin = time.process_time()
    found = index.leaks("word " * 20_000)
    assert found[1] == (0, 300, 300) and time.process_time() - begin < 10
    assert len(index._aligned(np.array([index.vocabulary["word"]] * 5000, np.int32))) <= 2 * 5300


def test_up_to_two_substitutions_are_always_found():
    dealt = random.Random(6)
    for _ in range(300):
        item = [dealt.choice(VOCABULARY) for _ in range(15)]
        index = d.SeedIndex([(1, item)])
        text = list(item)
        for k in dealt.sample(range(15), 2):
            text[k] = "changed"
        assert 1 in index.leaks(" ".join(text)), text


def test_odd_rows(spark, odd, none):
    benchmark = spark.createDataFrame([(1, "a plain little text of seven words"), (2, None)], "item_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = d.find_leaks(odd, benchmark).collect()
    assert sorted(((r["doc_id"] or 0), r["item_id"], r["n_equal"]) for r in rows) == [(0, 1, 7), (5, 1, 7), (5, 1, 7), (5, 1, 7)]
    assert d.find_leaks(odd, empty).count() == 0 and d.find_leaks(none, benchmark).count() == 0
    kept = d.drop_leaking(odd, benchmark)
    assert kept.schema == odd.schema and kept.count() == odd.count() - 4
    assert d.drop_leaking(odd, empty).count() == odd.count()


def test_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(d, "TEXT_WORDS", 1500)
    item = [f"i{k}" for k in range(30)]
    index = d.SeedIndex([(1, item)])
    for place in (0, 1480, 1490, 3000, 4970):
        text = [f"t{k}" for k in range(5000)]
        text[place:place + 30] = item
        assert index.leaks(" ".join(text))[1] == (place, 30, 30)
