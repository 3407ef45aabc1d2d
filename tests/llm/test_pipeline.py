"""The pipeline's stages against what each alone must do."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sluice.llm import queries


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables with toxic, copied, leaking and private documents among clean ones."""
    dealt, folder = random.Random(9), str(tmp_path_factory.mktemp("sf"))
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "se", "ti", "vo") for c in ("n", "s", "t")]
    text = lambda n: " ".join(dealt.choice(words) for _ in range(n))
    insulting = lambda: " ".join(w if k % 12 else dealt.choice(("gorblax", "zunkfist", "twerbish")) for k, w in enumerate(text(120).split(), 1))
    texts, kinds = [], []
    for _ in range(300):
        texts.append(text(dealt.randint(60, 200)))
        kinds.append("clean")
    for _ in range(120):
        texts.append(insulting())
        kinds.append("toxic")
    items = [text(30) for _ in range(5)]
    for k in range(20):
        changed = items[k % 5].split()
        changed[dealt.randrange(30)] = "changed"
        texts.append(f"{text(40)} {' '.join(changed)} {text(40)}")
        kinds.append("leak")
    for k in range(20):
        base = texts[k].split()
        base[dealt.randrange(len(base))] = "copied"
        texts.append(texts[k] if k % 2 else " ".join(base))
        kinds.append("copy")
    for k in range(20):
        texts.append(f"{text(60)} jo.{k}@mail.example.com {text(30)} +1 (202) 555-01{k:02d}")
        kinds.append("private")
    texts += [None, "", " "]
    kinds += ["blank"] * 3
    documents = [(k, t, "en", "src0", len(t) if t is not None else None) for k, t in enumerate(texts)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, int(kind == "toxic")) for k, kind in enumerate(kinds) if kind in ("clean", "toxic")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(enumerate(kinds)), dict(enumerate(texts))


def test_stages(spark, planted, tmp_path):
    folder, kinds, texts = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [set(kinds)]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, folder)
        assert after.schema == docs.schema, name
        after.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    removed = [{kind: sum(kinds[n] == kind for n in a - b) for kind in set(kinds.values())} for a, b in zip(seen, seen[1:])]
    assert removed[0]["toxic"] >= 0.95 * 120 and sum(removed[0].values()) - removed[0]["toxic"] <= 3
    assert removed[1]["copy"] >= 19 and sum(removed[1].values()) <= 21
    assert removed[2]["leak"] >= 19 and sum(removed[2].values()) - removed[2]["leak"] <= 1
    assert sum(removed[3].values()) == 0
    final = {r["doc_id"]: r for r in docs.collect()}
    private = [final[n]["text"] for n in final if kinds[n] == "private"]
    assert private and all("[EMAIL]" in t and "[PHONE]" in t and "@" not in t for t in private)
    assert all(r["text"] == texts[n] and r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for n, r in final.items() if kinds[n] == "clean")
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in pieces.collect()} == set(final)


def test_run(spark, planted):
    folder, kinds, _ = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    left = {kinds[r["doc_id"]] for r in rows}
    assert "clean" in left and "private" in left and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_empty_documents(spark, planted, none):
    folder = planted[0]
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    from oracle import compare, duck

    folder = "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), folder, name, queries.QUERIES[name], queries.SQL[name]) is None
