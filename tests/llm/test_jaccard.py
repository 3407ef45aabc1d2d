"""The Jaccard join against every pair compared."""

import random

import pytest

from sluice.llm import jaccard
from sluice.llm.components import components


def run_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Per row (id, text) as the operator returns it."""
    sets = [run_set(text) for _, text in rows]
    groups = list(range(len(rows)))
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                links[a].append(b)
                old, new = sorted((groups[a], groups[b]))[::-1]
                groups = [new if g == old else g for g in groups]
    out = []
    for a, (name, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if groups[b] == groups[a] and rows[b][0] is not None]
        out.append((name, min(ids, default=None), len(links[a]), len({sets[b] for b in links[a]} - {sets[a]}), 1 + sum(sets[b] == sets[a] for b in links[a])))
    return sorted(out, key=str)


def texts(seed, families, copies, words=60):
    dealt = random.Random(seed)
    found = []
    for _ in range(families):
        base = [f"w{dealt.randint(0, 400)}" for _ in range(words)]
        for _ in range(copies):
            other = list(base)
            for _ in range(dealt.choice([0, 0, 1, 1, 2, 3])):
                other[dealt.randrange(words)] = f"n{dealt.randint(0, 10**6)}"
            found.append(" ".join(other))
    return found


@pytest.mark.parametrize("pair_bucket,block_texts", [(16, 512), (2, 4)])
def test_links_and_classes(make, pair_bucket, block_texts):
    found = texts(1, 6, 9) + texts(2, 12, 2) + ["three short words"] * 3 + ["three short words more"]
    docs = make(found)
    got = jaccard.join_similar(docs, pair_bucket=pair_bucket, block_texts=block_texts).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(enumerate(found, 1)))


def test_odd_rows(odd, none):
    got = jaccard.join_similar(odd).collect()
    words = [r for r in odd.collect()]
    blank = [r["doc_id"] for r in words if not run_set(r["text"])]
    assert sorted((tuple(r) for r in got if r["doc_id"] in blank and r["n_copies"] != 4), key=str) == sorted(((name, name, 0, 0, 1) for name in blank), key=str)
    plain = [r for r in got if r["doc_id"] == 5 or r["doc_id"] is None and r["n_copies"] == 4]
    assert len(plain) == 4 and all((r["class_id"], r["n_links"], r["n_copies"]) == (5, 3, 4) for r in plain)
    assert jaccard.join_similar(none).count() == 0


def test_one_of_each_stays(odd, none, make):
    kept = jaccard.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    before, after = odd.collect(), kept.collect()
    assert sum(r["text"] is None or not r["text"].split() for r in after) == sum(r["text"] is None or not r["text"].split() for r in before)
    assert [r["doc_id"] for r in after if r["text"] == "a plain little text of seven words"] == [5]
    assert jaccard.keep_one_of_each(none).count() == 0
    found = texts(3, 5, 6) + texts(4, 20, 1)
    classes = {row[0]: row[1] for row in brute(list(enumerate(found, 1)))}
    assert sorted(r["doc_id"] for r in jaccard.keep_one_of_each(make(found)).collect()) == sorted(set(classes.values()))


def test_pruning_keeps_what_may_reach_the_threshold():
    steps = jaccard.least_matches()
    assert [n for n, _ in steps] == [16, 32, 48, 64, 80]
    assert all(m < 0.8 * n for n, m in steps) and steps[-1][1] > 40


def test_components(spark):
    dealt = random.Random(5)
    links = [(k, k + 1) for k in range(1, 300)] + [(1000, k) for k in range(1001, 1100)] + [(dealt.randint(2000, 2400), dealt.randint(2000, 2400)) for _ in range(150)]
    root = {n: n for pair in links for n in pair}
    for _ in range(len(root)):
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not changed:
            break
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in root.items() if n in got} and all(root[n] == n and list(root.values()).count(n) == 1 for n in set(root) - set(got))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_texts", [4, 7])
def test_classes_of_large_cells_without_all_links(make, block_texts):
    """Chains and families over many blocks: members outside the largest class meet all others."""
    dealt = random.Random(block_texts)
    chain, found = [f"c{dealt.randint(0, 300)}" for _ in range(80)], texts(7, 3, 14)
    for k in range(40):  # each is near the one before, far from most
        chain[(3 * k) % 80] = f"x{k}"
        found.append(" ".join(chain))
    found += [found[5]] * 6
    want = {row[0]: row[1] for row in brute(list(enumerate(found, 1)))}
    kept = jaccard.keep_one_of_each(make(found), block_texts=block_texts)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_relative_forms_count_common_runs():
    found = texts(9, 2, 12) + ["short", "word " * 30]
    import numpy as np
    import pandas as pd
    held, added = jaccard.relative(found, found[0])
    frame = pd.DataFrame({"held": held, "added": added})
    sets = [jaccard.runs(t) for t in found]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard.common_runs(frame, frame).astype(int).tolist() == want
    assert len(added[0]) == 0


def test_any_column_names(spark, make):
    found = texts(3, 4, 5)
    docs = make(found).selectExpr("doc_id AS id", "text AS own_key", "lang AS chosen_id", "n AS `row.a`", "n AS blank")
    kept = jaccard.keep_one_of_each(docs, "id", "own_key")
    want = {row[0]: row[1] for row in brute(list(enumerate(found, 1)))}
    assert kept.columns == docs.columns and sorted(r["id"] for r in kept.collect()) == sorted(set(want.values()))
