"""Toxicity, quality and language: held-out accuracy; fertility rules against brute force."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from sluice.llm import fertility, langid, neighbours, queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    read = lambda name: connection.execute(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()
    return {r[0]: r for r in read("documents")}, {r[0]: r for r in read("labels")}


def test_toxicity_held_out(spark, tables):
    """On labels that the fit has not seen. About a third of the few toxic labels here mark
    documents without any toxic word, which nothing in the text tells."""
    documents, labels = tables
    rows = queries.QUERIES["op9_toxicity"](spark, SF).collect()
    assert len(rows) == len(documents)
    held = [(r["score"], r["predicted"], labels[r["doc_id"]][2]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert auc >= 0.75 and sum(p and not y for _, p, y in held) <= 0.02 * len(held)
    assert sum(p for _, p, y in held if y) >= 0.6 * len(toxic)
    insults = re.compile(r"\b(idiot|stupid|moron|loser|pathetic|clown|trash|scum|worthless|disgusting)\b")
    said = {name for name, row in documents.items() if insults.search(row[1].lower())}
    predicted = {r["doc_id"] for r in rows if r["predicted"]}
    assert len(predicted & said) >= 0.8 * len(said) and len(predicted - said) <= 0.03 * len(documents)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_scores_by_hand(spark, make, tables):
    """The score of each text from compressed lengths of each of its windows; two fits agree."""
    documents, labels = tables
    texts = [row[1] for row in list(documents.values())[:400]]
    labelled = spark.createDataFrame([(k, labels[name][2]) for k, name in enumerate(list(documents)[:400], 1) if name in labels], "doc_id long, toxic int")
    docs = make(texts)
    model = toxicity.fit(docs, labelled)
    assert model == toxicity.fit(docs.repartition(5), labelled.repartition(3))
    pack = [toxicity.compressor(model[k]) for k in ("ordinary", "toxic")]
    *weights, intercept = model["weights"]
    for r in toxicity.score_toxicity(docs, model).collect():
        margins = [len(pack[0].compress(w)) - len(pack[1].compress(w)) for w in toxicity.windows(texts[r["doc_id"] - 1])]
        values = [math.log1p(sum(m >= least for m in margins)) for least in toxicity.MARGINS] + [max([0, *margins]), math.log1p(len(margins))]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, values)) - intercept)), abs=1e-9)


def test_toxicity_words_of_uneven_frequency(spark):
    dealt = random.Random(4)
    plain = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    name = lambda k: "bad" + "".join(chr(97 + k // 26 ** j % 26) for j in range(8))
    rare = [name(k) for k in range(250)]
    has = [{"hot"} for _ in range(300)] + [set() for _ in range(1200)]
    for word in rare:
        for k in dealt.sample(range(300), 14):
            has[k].add(word)
    rows = [(int(k < 300), k, w) for k, words in enumerate(has) for w in {*dealt.sample(plain, 20), *words}]
    assert toxicity.toxic_words(spark.createDataFrame(rows, "label int, near_group long, word string")) == sorted(["hot", *rare])


def test_toxicity_dictionaries_are_trained_on_text():
    dealt = random.Random(7)
    bad, plain = [f"bad{k}word" for k in range(30)], [f"plain{k}" for k in range(200)]
    excerpts = [f" {' '.join(dealt.sample(bad, 4))} ".encode() for _ in range(300)]
    ordinary, toxic = toxicity.dictionaries([f" {' '.join(dealt.sample(plain, 5))} ".encode() for _ in range(500)], excerpts)
    assert toxic.endswith(ordinary) and sum(w.encode() in toxic for w in bad) >= 27 and not any(w.encode() in ordinary for w in bad)


def test_toxicity_dictionaries_hold_the_last_excerpts():
    """Excerpts come in order, so words of one beginning (another language's) can all be at the end."""
    dealt = random.Random(8)
    bad, late = [f"bad{k}word" for k in range(30)], [f"vequ{k}rie" for k in range(10)]
    excerpts = sorted(f" {' '.join(dealt.sample(bad if k % 6 else late, 4))} ".encode() for k in range(300))
    plain = [f" {' '.join(f'plain{dealt.randrange(200)}' for _ in range(5))} ".encode() for _ in range(500)]
    ordinary, toxic = toxicity.dictionaries(plain, excerpts)
    assert sum(w.encode() in toxic for w in late) >= 9 and not any(w.encode() in ordinary for w in late)
    measure = toxicity.Margins(ordinary, toxic)
    assert all(measure(f"plain1 plain2 {late[k]} {late[k - 1]} plain3")[0] > 0 for k in range(10))


def test_toxicity_near_copies_count_once(spark):
    dealt = random.Random(5)
    base = [f"w{dealt.randrange(10**6)}" for _ in range(200)]
    copies = [" ".join(w if dealt.random() > 0.01 else f"x{dealt.randrange(10**6)}" for w in base) for _ in range(40)]
    others = [" ".join(f"w{dealt.randrange(10**6)}" for _ in range(200)) for _ in range(40)]
    groups = toxicity.copy_groups([toxicity.bands(text) for text in copies + others])
    assert len(set(groups[:40])) == 1 and len(set(groups[40:])) == 40
    rows = [(1, g, w) for g in groups[:40] for w in ("copied", "word")] + [(0, 1000 + k, w) for k in range(200) for w in ("other", "word")]
    assert toxicity.toxic_words(spark.createDataFrame(rows, "label int, near_group long, word string")) == []


def test_toxicity_reads_long_documents_whole(spark):
    """A toxic word behind 5,000 words of each toxic document is learnt."""
    dealt = random.Random(6)
    text = lambda n: " ".join(f"word{dealt.randrange(300)}" for _ in range(n))
    rows = [(k, f"{text(5000)} vileword {text(50)}" if k % 2 else text(5050)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, toxic int"))
    assert b"vileword" in model["toxic"] and b"vileword" not in model["ordinary"]


def test_windows_cover_all_words():
    dealt = random.Random(2)
    for n in (0, 1, 5, 60, 500):
        words = ["w" * dealt.randint(1, 70) + str(k) for k in range(n)]
        seen = b" ".join(toxicity.windows(" ".join(words)))
        assert all(f" {w} ".encode() in b" " + seen + b" " for w in words)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for model in (toxicity.fit(odd, labels), toxicity.fit(odd, labels.limit(0)), toxicity.fit(none, labels)):
        rows = toxicity.score_toxicity(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        kept = toxicity.drop_toxic(odd, model)
        assert kept.schema == odd.schema and kept.count() == sum(r["predicted"] == 0 for r in rows)
        assert toxicity.score_toxicity(none, model).count() == 0


def test_quality_held_out(spark, tables):
    _, labels = tables
    rows = [r for r in queries.QUERIES["op7_quality_votes"](spark, SF).collect()]
    held = [(r["predicted"], labels[r["doc_id"]][1]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)] + [(None, 1)], "doc_id long, quality int")
    for model in (neighbours.fit(odd, labels), neighbours.fit(odd, labels.limit(0)), neighbours.fit(none, labels)):
        rows = neighbours.score_quality(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert neighbours.score_quality(none, model).count() == 0


def test_quality_reads_long_tokens_whole():
    terms = neighbours.Terms()
    found = lambda text: {k: v for k, v in zip(*(x.tolist() for x in terms(text)))}
    words = lambda text: {k for k in found(text) if k < neighbours.WORD_BUCKETS}
    shapes = lambda text: {k for k in found(text) if neighbours.WORD_BUCKETS <= k < neighbours.WORD_BUCKETS + neighbours.SHAPE_BUCKETS}
    start = "ab" * 5_000
    assert words(start + "kiwi") != words(start + "plum") and shapes(start + "kiwi") != shapes(start + "4-5-6")
    assert len(words(start + "kiwi") & words(start + "plum")) == 1
    for at in (8, 20, 63, 300):  # a shape of many runs
        base = "a1" * at
        assert shapes(base + "--") != shapes(base + "++")
    assert len(words("some plain words")) == 3 and len(shapes("some plain words")) == 1


def test_language_held_out(spark, tables):
    documents, _ = tables
    rows = queries.QUERIES["op6_language_id"](spark, SF).collect()
    held = [(r["lang_pred"], documents[r["doc_id"]][2]) for r in rows if r["held_out"]]
    assert sum(p == y for p, y in held) >= 0.98 * len(held)


def test_language_backs_off_to_n_grams():
    model = langid.build([("aa", "haus", 5), ("aa", "maus", 5), ("bb", "casa", 5), ("bb", "masa", 5)])
    identifier = langid.Identifier(model)
    assert identifier.identify("haus")[0] == "aa" and identifier.identify("klaus laus")[0] == "aa" and identifier.identify("pasa")[0] == "bb"
    assert identifier.identify("12 ?!") == ("und", 0.0) and identifier.identify(None) == ("und", 0.0)


def test_language_counts_in_spark_as_without(spark):
    dealt = random.Random(6)
    counts = sorted({(lang, "".join(dealt.choices("abcdeéß漢", k=dealt.randint(1, 9)))): dealt.randint(1, 9) for lang in ("aa", "bb", "cc") for _ in range(300)}.items())
    counts = [(*key, n) for key, n in counts]
    plain, found = langid.build(counts), langid.build_from(spark.createDataFrame(counts, "lang string, word string, n long"))
    assert plain["languages"] == found["languages"]
    for (names, values), (others, same) in zip(plain["tables"], found["tables"], strict=True):
        assert names == others and abs(values - same).max() < 1e-5
    for entries in (60, 600, 3000):
        tables = langid.build_from(spark.createDataFrame(counts, "lang string, word string, n long"), entries)["tables"]
        assert sum(len(names) for names, _ in tables) == min(entries, sum(len(names) for names, _ in plain["tables"]))


def test_language_with_far_longer_documents_leaves_places(spark):
    counts = [("long", f"long{k}", 5_000) for k in range(600)] + [("short", f"short{k}", 3) for k in range(150)]
    for model in (langid.build(counts, 1200), langid.build_from(spark.createDataFrame(counts, "lang string, word string, n long"), 1200)):
        known = set(model["tables"][0][0])
        assert sum(w.startswith("short") for w in known) >= 60 and len(known) >= 200
        assert sum(len(names) for names, _ in model["tables"]) == 1200
        identifier = langid.Identifier(model)
        assert identifier.identify("short7 short19")[0] == "short" and identifier.identify("long7 long19")[0] == "long"


def test_language_odd_rows(odd, none):
    for model in (langid.fit(odd), langid.fit(none)):
        rows = langid.identify_language(odd, model).collect()
        texts = odd.collect()
        assert len(rows) == len(texts)
        undecided = sum(not any(map(str.isalpha, r["text"] or "")) for r in texts)
        assert sum(r["lang_pred"] == "und" for r in rows) == (undecided if model["languages"] else len(texts))
        assert langid.identify_language(none, model).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_fertility_counts_and_verdicts(spark, tables):
    documents, labels = tables
    rows = queries.QUERIES["op5_fertility_rules"](spark, SF).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert len(rows) == len(documents)
    for r in rows:
        assert tuple(r[n] for n in names) == plain_counts(documents[r["doc_id"]][1])
        assert not (r["kept"] and r["base_failed"])
    good = [r["kept"] for r in rows if r["doc_id"] in labels and labels[r["doc_id"]][1] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["doc_id"] in labels and labels[r["doc_id"]][1] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_fertility_odd_rows(odd, none):
    rows = fertility.judge(odd, group_col="lang").collect()
    assert sorted(tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in rows) == sorted(plain_counts(r["text"] or "") for r in odd.collect())
    assert fertility.judge(none).count() == 0
    assert fertility.script_of("abc") == "LATIN" and fertility.script_of("12") == "NONE"


def test_script_counts_the_whole_text():
    assert fertility.script_of(" abcd" * 2_560) == "LATIN"  # every 50th character is a space
    assert fertility.script_of(("я" + "a" * 9) * 256) == "LATIN"
    assert fertility.script_of("12 " * 1_000 + "漢") == "CJK"
