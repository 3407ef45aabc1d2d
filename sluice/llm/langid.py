"""Language identification, words first.

Every known word has a log frequency per language. A word that no language knows is scored
by its character n-grams: the longest that are known, from five characters down to one, each
step down at a discount. A text's score per language is the mean over its words; the best
language wins, and the score is its share after a softmax.

Words, n-grams and languages are learned from about ``SAMPLE_DOCS`` documents per language,
chosen by a hash of the id, and read whole; words and the n-grams of all words are counted in
Spark. What is sent to the tasks is at most ``MODEL_ENTRIES`` words and n-grams. Words and
each length of n-grams have a sixth of the places each; what a table leaves free goes to the
larger ones. Within a table, entries are kept by their rank within a language, so that every
language has at least its equal part of the places, however long its documents are, and
places that a language leaves free go to the others. Words seen once and n-grams seen less
than ``LEAST_GRAM`` times in all languages together are not kept. An entry that a language
lacks counts as half seen in a language of mean size, in proportion in others.

Defined cases: a null text and one without a letter are ``und`` with score 0; without
training rows all texts are ``und``; of equal languages the first by name wins; rows with a
null language are not learned from; repeated rows give one row each; other columns are
ignored; long texts are read whole, in bounded pieces.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .base import over_texts, ship
from .samples import per_class

ship(__name__)

SAMPLE_DOCS, MODEL_ENTRIES = 1500, 400_000
LONGEST, DISCOUNT, LEAST_GRAM, LEAST_WORD = 5, 0.4, 3, 2
#: Ranks are counted in steps of this size when places are dealt.
RANK_STEP = 16
SHARPNESS = 8.0
MEMO_WORDS, TEXT_CHARS = 400_000, 2_000_000
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def grams(word: str, n: int) -> list[str]:
    """The word's n-grams, with its edges marked for n above one."""
    padded = f"\x02{word}\x03" if n > 1 else word
    return [padded[k:k + n] for k in range(len(padded) - n + 1)]


def dealt_places(sizes: list[int], entries: int) -> list[int]:
    """Places per table: equal parts, and what small tables leave free goes to larger ones."""
    places, left = [0] * len(sizes), entries
    for done, k in enumerate(sorted(range(len(sizes)), key=lambda k: sizes[k])):
        places[k] = min(sizes[k], left // (len(sizes) - done))
        left -= places[k]
    return places


def model_of(languages: list[str], found: list[tuple[list[str], np.ndarray]], sums: list[np.ndarray]) -> dict:
    """Log frequencies from kept entries and their counts per language, and each table's sums of counts."""
    tables = []
    for (kept, counts), total in zip(found, sums):
        order = sorted(range(len(kept)), key=kept.__getitem__)
        least = 0.5 * np.maximum(total, 1) / max(1.0, total.mean() if len(total) else 0)
        values = counts[order] + least
        tables.append(([kept[k] for k in order], np.log(values / (total + least * len(kept) + 1)).astype(np.float32)))
    return {"languages": languages, "tables": tables}


def build(counts: list[tuple[str, str, int]], entries: int = MODEL_ENTRIES) -> dict:
    """Model from few (language, word, count), without Spark; of equal counts the first entry by name is kept."""
    languages = sorted({lang for lang, _, _ in counts})
    place = {lang: k for k, lang in enumerate(languages)}
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]  # 0: words, n: n-grams
    for lang, word, n in counts:
        for size in range(LONGEST + 1):
            for gram in grams(word, size) if size else [word]:
                tables[size].setdefault(gram, np.zeros(len(languages)))[place[lang]] += n
    tables = [{g: c for g, c in found.items() if c.sum() >= (LEAST_GRAM if size else LEAST_WORD)} for size, found in enumerate(tables)]
    kept = []
    for found, places in zip(tables, dealt_places(list(map(len, tables)), entries)):
        best: dict[str, int] = {}
        for k in range(len(languages)):
            for rank, gram in enumerate(sorted((g for g in found if found[g][k]), key=lambda g: (-found[g][k], g))):
                best[gram] = min(rank, best.get(gram, rank))
        chosen = sorted(best, key=lambda g: (best[g], g))[:places]
        kept.append((chosen, np.array([found[g] for g in chosen]).reshape(len(chosen), len(languages))))
    return model_of(languages, kept, [sum(found.values(), np.zeros(len(languages))) for found in tables])


def build_from(words: DataFrame, entries: int = MODEL_ENTRIES) -> dict:
    """The same from rows of lang, word, n, counted and ranked in Spark; of equal counts a hash decides."""
    rows = words.select(F.lit(0).alias("size"), "lang", F.col("word").alias("gram"), "n")
    for size in range(1, LONGEST + 1):
        padded = F.concat(F.lit("\x02"), "word", F.lit("\x03")) if size > 1 else F.col("word")
        long_enough = words.select("lang", "n", padded.alias("word")).where(F.length("word") >= size)
        starts = F.sequence(F.lit(1), F.length("word") - (size - 1))
        cut = F.explode(F.transform(starts, lambda k: F.substring("word", k, F.lit(size))))
        rows = rows.unionByName(long_enough.select(F.lit(size).alias("size"), "lang", cut.alias("gram"), "n"))
    rows = rows.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    grouped = rows.groupBy("size", "gram").agg(F.collect_list(F.struct("lang", "n")).alias("counts"), F.sum("n").alias("total"))
    grouped = cut_lineage(grouped.where(F.col("total") >= F.when(F.col("size") == 0, LEAST_WORD).otherwise(LEAST_GRAM)).drop("total"))
    flat = grouped.select("size", "gram", F.inline("counts"))
    classes = defaultdict(list)
    for r in flat.groupBy("size", "lang", "n").agg(F.count("*").alias("ties")).collect():
        classes[r["size"], r["lang"]].append((r["n"], r["ties"]))
    languages = sorted({lang for _, lang in classes})
    sums, above = np.zeros((LONGEST + 1, len(languages))), []
    for (size, lang), found in classes.items():
        sums[size, languages.index(lang)] = sum(n * ties for n, ties in found)
        higher = 0
        for n, ties in sorted(found, reverse=True):
            above.append((size, lang, n, higher, ties))
            higher += ties
    above = words.sparkSession.createDataFrame(above, "size int, lang string, n long, higher long, ties long")
    rank = F.floor((F.col("higher") + F.pmod(F.xxhash64("gram"), F.lit(1_000_000)) / 1e6 * F.col("ties")) / RANK_STEP)
    ranked = flat.join(F.broadcast(above), ["size", "lang", "n"]).groupBy("size", "gram").agg(F.min(rank).alias("rank"), F.collect_list(F.struct("lang", "n")).alias("counts"))
    ranked = cut_lineage(ranked)
    steps: list[dict[int, int]] = [{} for _ in range(LONGEST + 1)]
    for r in ranked.groupBy("size", "rank").agg(F.count("*").alias("entries")).collect():
        steps[r["size"]][r["rank"]] = r["entries"]
    places, ends = dealt_places([sum(found.values()) for found in steps], entries), []
    for found, left in zip(steps, places):  # the first rank that does not fit as a whole
        end = 0
        for end in sorted(found):
            left -= found[end]
            if left < 0:
                break
        ends.append(end)
    if not languages:
        return model_of([], [([], np.zeros((0, 0)))] * (LONGEST + 1), list(sums))
    last = F.create_map(*(F.lit(x) for pair in enumerate(ends) for x in pair))
    by_lang = F.map_from_entries("counts")
    wanted = ranked.where(F.col("rank") <= last[F.col("size")]).select("size", "rank", "gram", F.array(*(F.coalesce(by_lang[F.lit(lang)], F.lit(0)) for lang in languages)).alias("counts"))
    got = wanted.toArrow().combine_chunks()
    size, rank, names = got["size"].to_numpy(), got["rank"].to_numpy(), got["gram"].to_pylist()
    counts = got["counts"].combine_chunks().flatten().to_numpy().reshape(len(names), len(languages)).astype(float)
    kept = []
    for k in range(LONGEST + 1):
        chosen = sorted(np.flatnonzero(size == k).tolist(), key=lambda at: (rank[at], names[at]))[:places[k]]
        kept.append(([names[at] for at in chosen], counts[chosen]))
    return model_of(languages, kept, list(sums))


class Identifier:
    def __init__(self, model: dict):
        self.languages = model["languages"]
        self.tables = [({g: k for k, g in enumerate(kept)}, values) for kept, values in model["tables"]]
        self.reset()

    def reset(self) -> None:
        """The memo starts with no word; row 0 is for what has no letter."""
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((MEMO_WORDS + 2, len(self.languages)), np.float32)
        self.size = 1

    def score(self, words: list[str]) -> np.ndarray:
        """Log frequencies per language of each word, from the longest known n-grams on."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        known, values = self.tables[0]
        at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        out[at >= 0] = values[at[at >= 0]]
        left = np.flatnonzero(at < 0).tolist()
        for n in range(LONGEST, 0, -1):
            known, values = self.tables[n]
            found = [[k for g in grams(words[w], n) if (k := known.get(g)) is not None] for w in left]
            hit = [w for w, ks in zip(left, found) if ks]
            if hit:
                sizes = np.array([len(ks) for ks in found if ks])
                flat = values[np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))]
                sums = np.add.reduceat(flat, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
                out[hit] = sums / sizes[:, None] + (LONGEST + 1 - n) * np.float32(np.log(DISCOUNT))
            left = [w for w, ks in zip(left, found) if not ks]
        return out

    def identify(self, text: str | None) -> tuple[str, float]:
        total, count = np.zeros(len(self.languages)), 0
        for at in range(0, len(text or ""), TEXT_CHARS):
            words = WORD.findall(text[at:at + TEXT_CHARS].lower())
            for low in range(0, len(words), MEMO_WORDS // 2):
                part = words[low:low + MEMO_WORDS // 2]
                unknown = list(dict.fromkeys(w for w in part if w not in self.memo))
                if self.size + len(unknown) > MEMO_WORDS:
                    self.reset()
                    unknown = list(dict.fromkeys(part))
                lettered = [w for w in unknown if w.isalpha() or any(map(str.isalpha, w))]
                self.memo.update(dict.fromkeys(unknown, 0))
                self.memo.update(zip(lettered, range(self.size, self.size + len(lettered))))
                if lettered:
                    self.rows[self.size:self.size + len(lettered)] = self.score(lettered)
                    self.size += len(lettered)
                places = np.fromiter(map(self.memo.__getitem__, part), np.int64, len(part))
                total += self.rows[places].sum(axis=0)
                count += int((places > 0).sum())
        if not count or not self.languages:
            return UNKNOWN, 0.0
        mean = total / count
        best = int(mean.argmax())
        return self.languages[best], float(1 / np.exp(SHARPNESS * (mean - mean[best])).sum())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_of: int = 4, held_out: int = 2, sample_docs: int = SAMPLE_DOCS) -> dict:
    """The model from all rows with a language that are not held out (a bounded sample)."""
    key = F.col(id_col).cast("string")
    usable = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(F.col("id").cast("string").cast("binary")) % held_out_of != held_out))
    sample, _ = per_class(usable, "lang", F.col("id").cast("string"), sample_docs)

    def make() -> Callable[[list], dict]:
        def count(texts: list) -> dict:
            found = [Counter(w for w in WORD.findall(text.lower()) if any(map(str.isalpha, w))) for text in texts]
            return {"words": [list(c) for c in found], "counts": [list(c.values()) for c in found]}

        return count

    words = over_texts(sample.select("lang", "text"), "lang", "text", make, "words array<string>, counts array<long>")
    words = words.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n"))
    return build_from(cut_lineage(words))


def identify_language(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list], dict]:
        identifier = Identifier(sent.value)

        def run(texts: list) -> dict:
            found = [identifier.identify(text) for text in texts]
            return {"lang_pred": [lang for lang, _ in found], "score": [score for _, score in found]}

        return run

    return over_texts(docs, id_col, text_col, make, "lang_pred string, score double")
