"""Personal data and licences."""

import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest

from sluice.llm import licence_texts, licences, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and passes_luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


@pytest.mark.parametrize("seed", range(3))
def test_base_spans(seed):
    dealt = random.Random(seed)
    for _ in range(20_000):
        text = "".join(dealt.choice("a.@-+1 2(9)é٣%0") for _ in range(dealt.randint(0, 40)))
        assert pii.base_spans(text) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "+1 " * 300_000, "a@" * 300_000):
        pii.base_spans(text)


def corpus(make, n=400):
    dealt = random.Random(8)
    number = lambda k: "".join(dealt.choice("0123456789") for _ in range(k))

    def card():
        digits = "4" + number(14)
        return next(digits + c for c in "0123456789" if passes_luhn(digits + c))

    kinds = [lambda: f"{number(2)}.jo@mail{number(1)}.example.com", lambda: ".".join(str(dealt.randint(0, 255)) for _ in range(4)), card, lambda: f"+1 ({number(3)}) 555-{number(4)}", lambda: number(6), lambda: f"{dealt.randint(1900, 2030)}-0{dealt.randint(1, 9)}-11"]
    words = lambda: " ".join(dealt.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(20))
    return [f"{words()} {dealt.choice(kinds)()} {words()}" for _ in range(n)]


def test_added_spans_and_redaction(make):
    texts = corpus(make)
    hidden = ["lorem ipsum write to ann.li at mail.example dot com or so dolor sit", "lorem ipsum 4111.1111.1111.1111 dolor sit amet"]
    docs = make(texts + hidden)
    model = pii.fit(docs)
    assert model and set(model["thresholds"]) == set(pii.KINDS)
    found = {r["doc_id"]: r for r in pii.digest(pii.find_personal_data(docs, model)).collect()}
    for k, text in enumerate(texts, 1):
        base = pii.written(plain(text))
        assert found[k]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(found[k]["spans"].split(","))
        assert [found[k][f"n_{kind}"] for kind in pii.KINDS] == [len(s) for s in plain(text).values()]
    clean = [k for k, text in enumerate(texts, 1) if not any(plain(text).values())]
    assert sum(found[k]["spans"] == "" for k in clean) >= 0.97 * len(clean)
    redacted = {r["doc_id"]: r["text"] for r in pii.redact_documents(docs, model).collect()}
    assert all(not any(plain(redacted[k]).values()) for k in found)


def test_redact_merges_overlaps():
    assert pii.redact("a 1.2.3.4 b x@y.zz", None) == "a [IP] b [EMAIL]"
    assert pii.redact(None, None) is None and pii.redact("", None) == ""


def test_trees_learn_an_interaction():
    x = np.random.default_rng(1).random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    p = pii.BoostedTrees().fit(x[:1000], y[:1000]).probability(x[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.97


def test_pii_of_odd_rows(odd, none):
    assert pii.fit(none) is None
    rows = pii.digest(pii.find_personal_data(odd, pii.fit(odd))).collect()
    assert len(rows) == odd.count() and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in rows)
    assert pii.redact_documents(odd, None).schema == odd.schema


def test_licences(spark, odd, none, make):
    known = licences.known_licences(spark)
    mit = next(text for name, text in licences.LICENCES if name == "MIT")
    other = "MIT Licence\n\nCopyright (c) 2020 Ann\n(c) 2021 Bo\nAll rights reserved.\n\n" + mit.upper().replace(",", " ,").replace("\n", "\r\n")
    docs = make([other, mit + " and more", "text\nreleased under the mit licence!\n", "Copyright 2020 x", "licensed under CC-BY 4.0"])
    got = sorted((r["doc_id"], r["unit"], r["line"], r["licence"]) for r in licences.find_licences(docs, known).collect())
    assert got == [(1, "block", 3, "MIT"), (1, "block", 4, "MIT"), (1, "block", 5, "MIT"), (1, "text", 0, "MIT"), (2, "block", 1, "MIT"), (2, "block", 2, "MIT"), (3, "line", 2, "MIT"), (5, "line", 1, "CC-BY-4.0"), (5, "text", 0, "CC-BY-4.0")]
    assert licences.find_licences(odd, known).count() == 0 and licences.find_licences(none, known).count() == 0
    assert licences.find_licences(docs, known.limit(0)).count() == 0


PUBLISHED = {
    "Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "GFDL-1.3": "GFDL-1.3", "Artistic": "Artistic-1.0-Perl",
}


def test_full_published_texts(spark, make):
    files = {name: Path("/usr/share/common-licenses", file) for file, name in PUBLISHED.items()}
    found = [(name, path.read_text()) for name, path in files.items() if path.exists()]
    if not found:
        pytest.skip("no published texts on this machine")
    docs = make([text.upper().replace("LICENSE", "LICENCE") for _, text in found] + [text + " more" for _, text in found])
    got = {r["doc_id"]: r["licence"] for r in licences.find_licences(docs, licences.known_licences(spark)).where("unit = 'text'").collect()}
    assert got == {k: name for k, (name, _) in enumerate(found, 1)}


def test_notices_inside_other_files(spark, make):
    apache = next(text for name, text in licences.LICENCES if name == "Apache-2.0" and "\n\n" in text)
    commented = "\n".join("# " + line for line in apache.split("\n"))
    code = f"#!/bin/sh\n#\n# Copyright 2020 Ann\n#\n{commented}\n\necho done\n"
    got = [(r["unit"], r["licence"]) for r in licences.find_licences(make([code, "two lines\nof other text\n\n\n\nend"]), licences.known_licences(spark)).collect()]
    assert got and set(got) == {("block", "Apache-2.0")}


def test_shared_blocks_name_no_licence(spark):
    names: dict = {}
    for r in licences.known_digests(licences.known_licences(spark)).where("unit = 'block'").collect():
        names.setdefault(r["digest"], []).append(r["licence"])
    bsd = licences.canonical(licences.F.lit(licence_texts.BSD_DISCLAIMER))
    shared = spark.range(1).select(licences.F.sha2(bsd, 256).alias("d")).first()["d"]
    assert shared not in names and all(len(n) == 1 for n in names.values())


def test_every_known_text_has_its_own_digest(spark):
    rows = licences.known_licences(spark).withColumn("digest", licences.F.coalesce("digest", licences.digest(licences.F.col("text")))).collect()
    names: dict = {}
    for r in rows:
        names.setdefault(r["digest"], set()).add(r["licence"])
    assert None not in names and all(len(n) == 1 for n in names.values())


def test_every_disguise_alone_is_proposed():
    ats = [f"{s}{a}{w}{at}{w}{b}{s}" for a, b in ("[]", "()", "{}") for at in ("at", "AT", "@") for w in ("", " ") for s in ("", " ")] + ["@", " @ "]
    dots = [f"{s}{a}{w}{dot}{w}{b}{s}" for a, b in ("[]", "()", "{}") for dot in ("dot", "DOT", ".") for w in ("", " ") for s in ("", " ")] + [" dot ", "."]
    texts = [f"write to jane.doe{at}example{dot}org" for at in ats for dot in dots] + [f"write to jane.doe at example{dot}org" for dot in dots[:-1]]
    for text in texts:
        assert [kind for kind, *_ in pii.proposals(text)] == ["email"], text
    assert pii.proposals("we met at noon. then home") == [] and pii.proposals("see you at example.org") == []


def test_copies_collapse_before_places_are_taken(spark, monkeypatch):
    """20,000 copies of a page with an address: what reaches the driver is that of one of them."""
    collected = []
    plain = pii.examples
    monkeypatch.setattr(pii, "examples", lambda places: collected.append(len(places)) or plain(places))
    page = "write to ann@example.org or call +1 555 123 4567, invoice 12345678"
    docs = spark.range(20_000).select(pii.F.lit(page).alias("text"))
    pii.fit(docs, sample_docs=10**6)
    pii.fit(docs.limit(1), sample_docs=10**6)
    assert collected[0] == collected[1] <= 10
