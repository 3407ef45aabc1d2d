"""Token ids as files of fixed-width bits, with random access.

Every id takes the least number of bits that hold the vocabulary's largest id (16 bits for
49,408 ids). 64 ids make as many 64-bit words as an id has bits, so packing and unpacking
are a few numpy operations for each of the 64 places, whatever the number of ids. A file is

    magic, bits and ids of a block (two little-endian uint32)
    blocks of packed ids; the last one may be shorter
    footer: offsets of the blocks, document ids, which of them are null, first id of each document
    trailer: place of the footer, numbers of blocks, documents and ids, magic

A reader takes trailer and footer, and then only the blocks that hold the ids it wants.

Documents are put into ascending order of their ids by a range partitioning with a sort in
each partition, and each task writes the file of its range while it reads, block by block.
Only the order key decides where a row goes, so a repeated task writes the same file again;
it does so under another name, and a file counts when the manifest (one row per file) names
it. The manifest also has the number of ids before each file.

Defined cases: null and empty texts hold the end id only; null ids come first; rows with
equal ids are ordered by a hash of their texts, and equal rows follow each other; an empty
table gives a manifest without rows; documents of any length are packed block by block from
their ids; other columns are not touched. Document ids must be integers.
"""

from __future__ import annotations

import json
import posixpath
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from .base import kept_by_worker, pieces, ship
from .tokens import byte_letters, tokenizer_path

ship(__name__)

END_ID = 1
#: Ids of a block (a multiple of 64), and bytes of text for each file.
BLOCK_IDS, FILE_TEXT_BYTES = 4096, 128 << 20
#: Words that a task remembers, and how long a remembered word may be.
MEMO_WORDS, MEMO_CHARS = 200_000, 48
#: A text is taken in segments of about this many characters.
SEGMENT_CHARS = 1_000_000
#: Fixed values of the vocabulary's file: the end of a word, and its pattern of pre-tokens.
WORD_END = "</w>"
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for settled characters, with line feeds, which stand between words here.
WORD_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+|\n")
MARK = "\0"
MAGIC = b"bitids01"
TRAILER = np.dtype([("footer", "<u8"), ("blocks", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("magic", "S8")])
MANIFEST = "shard int, name string, n_docs long, n_ids long, bits int"


def bits_for(vocabulary: int) -> int:
    """Bits that hold the ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words of the ids, filled up with zeros to a multiple of 64 ids."""
    groups = -(-len(ids) // 64)
    padded = np.zeros((groups, 64), np.uint64)
    padded.reshape(-1)[:len(ids)] = ids
    words = np.zeros((groups, bits), np.uint64)
    for place in range(64):
        word, shift = divmod(place * bits, 64)
        words[:, word] |= padded[:, place] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= padded[:, place] >> np.uint64(64 - shift)
    return words.astype("<u8", copy=False).reshape(-1)


def unpack_bits(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed words."""
    words = np.asarray(words, np.uint64).reshape(-1, bits)
    mask = np.uint64((1 << bits) - 1)
    ids = np.empty((len(words), 64), np.uint32)
    for place in range(64):
        word, shift = divmod(place * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, place] = value & mask
    return ids.reshape(-1)[:count]


def inner_tokens(pairs: list[tuple[str, str]], vocabulary: dict[str, int]) -> dict[str, int]:
    """Tokens that their own letters give when merged pair by pair in the order of ranks."""
    rank = {pair: k for k, pair in enumerate(pairs)}
    found = {}
    for a, b in pairs:
        parts = list(a + b) if not b.endswith(WORD_END) else []
        while len(parts) > 1:
            best, at = min((rank.get((x, y), len(pairs)), k) for k, (x, y) in enumerate(zip(parts, parts[1:])))
            if best == len(pairs):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 1:
            found[parts[0]] = vocabulary[parts[0]]
    return found


class WordEncoder:
    """Ids of a text, word by word, for a BPE file that lower-cases and drops white space.

    Such a tokenizer never joins what a space or line feed separates, so each word is encoded
    once per memo. New words are merged together, in rank form: a word end is a byte of its
    own that merges with the byte before it first, as ``byte</w>`` does. The rank form gives
    the library's ids where the merges are numbered in the order of their ids and only
    strings count that the library encodes as the one token they name (any two neighbours that
    make such a string are then its own two halves). Words with a character whose class or
    lower case could differ between Unicode versions or in context go to the library as they
    are, and so does everything if the file has another form."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library, self.limit = Tokenizer.from_file(path), memo_words
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.rank_form = self._drops_spaces(spec) and self._merges_follow_ids(spec["model"])
        self.memo: dict[str, bytes] = {"": b""}
        self.missed = 0
        self.settled, self.unsettled = {chr(c) for c in (9, 10, 13, *range(32, 127))}, set()
        if self.rank_form:
            letters = byte_letters()
            as_bytes = lambda token: bytes(letters[c] for c in token)
            ranks = {}
            for token, rank in spec["model"]["vocab"].items():
                own = as_bytes(token.removesuffix(WORD_END)) + bytes(MARK.encode() if token.endswith(WORD_END) else b"")
                if rank < 512 or self._alone(token, rank):
                    ranks[own] = rank
            self.line_end = ranks[b"\n" + MARK.encode()]
            self.merges = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})

    def _alone(self, token: str, rank: int) -> bool:
        """Whether the library's merges make this one token of its bytes."""
        if token.endswith(WORD_END):
            return [t.id for t in self.library.model.tokenize(token.removesuffix(WORD_END))] == [rank]
        # inside a word: the same merges before another word end that joins nothing
        return self._inner.get(token) == rank

    @staticmethod
    def _drops_spaces(spec: dict) -> bool:
        normal, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        kinds = [n.get("type") for n in normal.get("normalizers", [])]
        splits = pre.get("pretokenizers", [])
        return (
            kinds == ["NFC", "Replace", "Lowercase"] and normal["normalizers"][1]["content"] == " " and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and [p.get("type") for p in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": PRE_TOKEN}
            and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[1]["use_regex"] and not splits[1]["add_prefix_space"]
        )

    def _merges_follow_ids(self, model: dict) -> bool:
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._inner = inner_tokens(pairs, vocabulary)
        return (
            end == WORD_END and [vocabulary[a + b] for a, b in pairs] == list(range(512, 512 + len(pairs)))
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "unk_token", "byte_fallback"))
        )

    def _settle(self, char: str) -> bool:
        """Whether the character is a letter, or a sign, in all Unicode versions, is written as
        Python writes it, and composes with no other."""
        group = lambda category: category[0] if category[0] in "LNZCM" else "S"
        now, then = group(unicodedata.category(char)), group(unicodedata.ucd_3_2_0.category(char))
        seen = {before: len(self.library.pre_tokenizer.pre_tokenize_str(before + char)) == 1 for before in "a!"}
        known = (
            now == then and now in "LS" and seen == {"a": now == "L", "!": now == "S"} and (now == "L") == char.isalpha()
            and self.library.normalizer.normalize_str(char) == char.lower() != "" and len(char.lower()) == 1
            and unicodedata.combining(char) == 0 and not "\u1100" <= char <= "\u11ff" and char != "\u03a3"
        )
        (self.settled if known else self.unsettled).add(char)
        return known

    def _plain(self, text: str) -> bool:
        if self.settled.issuperset(text):
            return True
        return self.unsettled.isdisjoint(text) and all([self._settle(c) for c in set(text) - self.settled])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _merge(self, words: list[str]) -> list[bytes]:
        pre_tokens = WORD_PART.findall("\n".join(words).lower())
        ids = np.array(self.merges.encode_ordinary(MARK.join(pre_tokens) + MARK) if pre_tokens else [], "<u4")
        ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
        starts = np.concatenate([[0], ends[:-1] + 1])
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]

    def _learn(self, words: list[str]) -> list[str]:
        """Puts the words into the memo, and returns those that must leave it again. A full memo
        stays as it is, as early words are the frequent ones, until it has missed too often."""
        whole = self._plain("".join(words)) and not any(s in w for w in words for s in self.special if "<" in w)
        plain = words if whole else [w for w in words if self._plain(w) and not any(s in w for s in self.special)]
        full = len(self.memo) >= self.limit
        self.memo.update(zip(plain, self._merge(plain)))
        if not whole:
            self.memo.update((w, self._ids(w).tobytes()) for w in set(words).difference(plain))
        if not full:
            return [w for w in words if len(w) > MEMO_CHARS]
        self.missed += len(words)
        return words

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SEGMENT_CHARS:
            border = text.find(" ", at + SEGMENT_CHARS)
            if border < 0:
                break
            yield text[at:border]
            at = border + 1
        yield text[at:] if at else text

    def ids(self, text: str | None) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids, segment by segment."""
        if not text:
            return
        if not self.rank_form:
            yield self._ids(text).tobytes()
            return
        for segment in self._segments(text):
            words = segment.replace("\n", " ").split(" ")
            unknown = list(set(words).difference(self.memo))
            leaving = self._learn(unknown) if unknown else ()
            yield b"".join(map(self.memo.__getitem__, words))
            for word in leaving:
                del self.memo[word]
            if self.missed > 4 * self.limit:
                self.memo, self.missed = {"": b""}, 0


class PackedWriter:
    """Writes one file; documents are added one after the other."""

    def __init__(self, stream, bits: int, block_ids: int = BLOCK_IDS):
        if block_ids % 64:
            raise ValueError("a block holds a multiple of 64 ids")
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0
        self.offsets, self.doc_ids, self.starts = [], [], [0]
        head = MAGIC + np.array([bits, block_ids], "<u4").tobytes()
        stream.write(head)
        self.at = len(head)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % self.block_ids
        words = pack_bits(ids[:whole], self.bits)
        self.stream.write(words.tobytes())
        step = self.block_ids * self.bits // 8
        self.offsets.extend(range(self.at, self.at + 8 * len(words), step))
        self.at += 8 * len(words)
        self.waiting, self.n_waiting = ([ids[whole:]], len(ids) - whole)

    def add(self, doc_id: int | None, parts: Iterator[np.ndarray]) -> None:
        for part in parts:
            self.waiting.append(part)
            self.n_waiting += len(part)
            self.n_ids += len(part)
            if self.n_waiting >= 64 * self.block_ids:
                self._flush(False)
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)

    def close(self) -> None:
        self._flush(True)
        nulls = np.array([d is None for d in self.doc_ids], np.uint8)
        for part in (np.array(self.offsets, "<u8"), np.array([d or 0 for d in self.doc_ids], "<i8"), nulls, np.array(self.starts, "<u8")):
            self.stream.write(part.tobytes())
        trailer = np.array([(self.at, len(self.offsets), len(self.doc_ids), self.n_ids, MAGIC)], TRAILER)
        self.stream.write(trailer.tobytes())
        self.stream.close()


class PackedFile:
    """Random access to the ids of one file."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        trailer = np.frombuffer(self._read(size - TRAILER.itemsize, TRAILER.itemsize), TRAILER)[0]
        if trailer["magic"] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.bits, self.block_ids = np.frombuffer(self._read(len(MAGIC), 8), "<u4").tolist()
        self.footer, blocks, docs, self.n_ids = (int(trailer[k]) for k in ("footer", "blocks", "docs", "ids"))
        footer = self._read(self.footer, size - TRAILER.itemsize - self.footer)
        self.offsets = np.frombuffer(footer, "<u8", blocks)
        self.doc_ids = np.frombuffer(footer, "<i8", docs, 8 * blocks)
        self.null = np.frombuffer(footer, np.uint8, docs, 8 * (blocks + docs)) > 0
        self.starts = np.frombuffer(footer[8 * (blocks + docs) + docs:], "<u8").astype(np.int64)

    def _read(self, at: int, count: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(count)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` on; only their blocks are read."""
        if count <= 0:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        begin = int(self.offsets[first])
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.footer
        words = np.frombuffer(self._read(begin, end - begin), "<u8")
        skip = start - first * self.block_ids
        return unpack_bits(words, self.bits, skip + count)[skip:]

    def document(self, number: int) -> np.ndarray:
        start, end = self.starts[number:number + 2].tolist()
        return self.ids(start, end - start)

    def runs(self, ids_at_once: int) -> Iterator[np.ndarray]:
        """All ids in order, in whole blocks."""
        step = max(1, ids_at_once // self.block_ids) * self.block_ids
        for start in range(0, self.n_ids, step):
            yield self.ids(start, min(step, self.n_ids - start))

    def checksums(self, ids_at_once: int = 64 * BLOCK_IDS) -> Iterator[int]:
        """crc32 of each document's ids as little-endian unsigned 32-bit numbers."""
        number, crc, at = 0, 0, 0
        for run in self.runs(ids_at_once):
            raw, begin = memoryview(run.astype("<u4", copy=False).tobytes()), at
            at += len(run)
            while number < len(self.doc_ids) and self.starts[number + 1] <= at:
                end = int(self.starts[number + 1])
                yield zlib.crc32(raw[4 * max(0, int(self.starts[number]) - begin):4 * (end - begin)], crc)
                number, crc = number + 1, 0
            if number < len(self.doc_ids):
                crc = zlib.crc32(raw[4 * max(0, int(self.starts[number]) - begin):], crc)


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI that all executors share, and the path within it."""
    return arrow_fs.FileSystem.from_uri(path)


def write_packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS, file_text_bytes: int = FILE_TEXT_BYTES) -> DataFrame:
    """Writes the ids of all documents, in ascending order of ``id_col``, under ``path``, and
    returns the manifest: one row per file with its number, name, documents, ids and bits.

    There are as many files as shuffle partitions, or more if files would hold more than
    ``file_text_bytes`` of text."""
    spark, tokenizer = docs.sparkSession, tokenizer or tokenizer_path("word_bpe_49k.json")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_text_bytes))
    order = (F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = narrow.repartitionByRange(files, *order).sortWithinPartitions(*order)
    names = [part.split()[0] for part in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("packed words", tokenizer), lambda: WordEncoder(tokenizer))
        task, writer, name = TaskContext.get(), None, ""
        end, bits = np.array([end_id], "<u4"), bits_for(max(encoder.vocabulary, end_id + 1))

        def parts(text: str | None) -> Iterator[np.ndarray]:
            for raw in encoder.ids(text):
                yield np.frombuffer(raw, "<u4")
            yield end

        for batch in pieces(batches):
            if writer is None and batch.num_rows:
                name = f"ids-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
                system, folder = file_system(path)
                system.create_dir(folder, recursive=True)
                writer = PackedWriter(system.open_output_stream(posixpath.join(folder, name)), bits, block_ids)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                writer.add(doc_id, parts(text))
        if writer is not None:
            writer.close()
            row = (task.partitionId(), name, len(writer.doc_ids), writer.n_ids, bits)
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    rows = sorted(ordered.mapInArrow(run, MANIFEST).collect())
    start, found = 0, []
    for row in rows:
        found.append((*row, start))
        start += row["n_ids"]
    manifest = spark.createDataFrame(found, f"{MANIFEST}, start long").coalesce(1)
    manifest.write.parquet(posixpath.join(path, "manifest"))
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, start long").parquet(posixpath.join(path, "manifest"))


def _each_file(spark: SparkSession, path: str, rows_of: Callable[[PackedFile, int], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    manifest = read_manifest(spark, path)
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, folder = file_system(path)
                with system.open_input_file(posixpath.join(folder, name)) as stream:
                    yield from rows_of(PackedFile(stream), start)

    return manifest.repartition(files, "shard").select("name", "start").mapInArrow(run, schema)


def read_digests(spark: SparkSession, path: str, rows_at_once: int = 4096) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and ids_crc32."""

    def rows(file: PackedFile, start: int) -> Iterator[pa.RecordBatch]:
        crc = file.checksums()
        for at in range(0, len(file.doc_ids), rows_at_once):
            own = slice(at, at + rows_at_once)
            starts = file.starts[:-1][own]
            yield pa.RecordBatch.from_arrays([
                pa.array(file.doc_ids[own], pa.int64(), mask=file.null[own]), pa.array(starts + start, pa.int64()),
                pa.array(file.starts[1:][own] - starts, pa.int64()), pa.array([next(crc) for _ in starts], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _each_file(spark, path, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start and its ids."""

    def rows(file: PackedFile, start: int) -> Iterator[pa.RecordBatch]:
        for number in range(len(file.doc_ids)):
            own = slice(number, number + 1)
            ids = pa.array([file.document(number).tolist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([
                pa.array(file.doc_ids[own], pa.int64(), mask=file.null[own]), pa.array(file.starts[own] + start, pa.int64()), ids,
            ], names=["doc_id", "start", "ids"])

    return _each_file(spark, path, rows, "doc_id long, start long, ids array<int>")
