"""Token ids of documents in keyed binary files.

A shard is a range of doc_id. Its payload file is nothing but the ids, as
little-endian numbers of two bytes (four if the vocabulary needs them), one
document after the other in ascending doc_id order. Its index file is a
minimal perfect hash over the document keys: a cascade of bit tables, each
half empty; a key that alone hits its bit stays in that table, the others go
on to the next. A key's rank among the set bits is its slot, which has a
32-bit fingerprint of the key (so foreign keys are refused), the document's
first id and its number of ids. A lookup reads a few bits and one slot.

Layout of an index file (little endian): magic ``TKIX0001``, n_keys u64,
n_levels u64, id_bytes u64; per level its size in bits u64; then the levels'
bits packed into u64 words; ranks before each word u64; fingerprints u32;
starts u64; sizes u64; and, in document order, keys i64, null flags u8 and
ordinals u32 (a repeated doc_id's rows are told apart by their ordinal).
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Words
from .common import partitions, range_bounds, range_bucket, run_folder, text_list, text_slices

MAGIC = b"TKIX0002"
SHARD_BYTES = 256 << 20    # of ids, after which a shard ends
RANGE_BYTES = 1 << 30      # of text, in a range of doc_id
PIECES = 4_096             # shard numbers of a range
SEEDS = 16
CACHED_WORDS = 300_000


# hashing of keys ------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers (multiply and fold)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, nulls: np.ndarray, ordinals: np.ndarray, seed: int = 0) -> np.ndarray:
    start = np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return _mix(_mix(keys.astype(np.int64).view(np.uint64) + start) + ordinals.astype(np.uint64) * np.uint64(2) + nulls.astype(np.uint64))


def distinct_hashes(keys: np.ndarray, nulls: np.ndarray, ordinals: np.ndarray) -> tuple[int, np.ndarray]:
    """The first seed under which all keys have hashes of their own, and these."""
    for seed in range(SEEDS):
        hashes = key_hash(keys, nulls, ordinals, seed)
        if len(np.unique(hashes)) == len(hashes):
            return seed, hashes
    raise ValueError(f"two keys have the same 64-bit hash under {SEEDS} seeds")


def _at_level(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    return _mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(bits)


class KeyIndex:
    """Minimal perfect hash over distinct keys, with what is stored by slot."""

    def __init__(self, levels: list[int], words: np.ndarray, before: np.ndarray, marks: np.ndarray,
                 starts: np.ndarray, sizes: np.ndarray):
        self.levels, self.words, self.before = levels, words, before
        self.marks, self.starts, self.sizes = marks, starts, sizes
        self.first_word = np.concatenate([[0], np.cumsum([-(-b // 64) for b in levels])]).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> KeyIndex:
        levels, tables, rest = [], [], hashes
        while len(rest):
            bits = max(64, 2 * len(rest))
            at = _at_level(rest, len(levels), bits).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            tables.append(np.packbits(np.pad(alone, (0, -bits % 64)), bitorder="little").view(np.uint64))
            levels.append(bits)
            rest = rest[~alone[at]]
        words = np.concatenate(tables) if tables else np.zeros(0, np.uint64)
        counts = np.bitwise_count(words).astype(np.uint64)
        before = np.cumsum(counts) - counts
        index = cls(levels, words, before, None, None, None)
        slots = index.slots(hashes)
        order = np.argsort(slots)
        index.marks = (hashes[order] >> np.uint64(32)).astype(np.uint32)
        index.starts, index.sizes = starts[order].astype(np.uint64), sizes[order].astype(np.uint64)
        return index

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 if no level has it."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = _at_level(hashes[todo], level, bits)
            word = self.first_word[level] + (at >> np.uint64(6)).astype(np.int64)
            bit = at & np.uint64(63)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[word] + below.astype(np.uint64)).astype(np.int64)[hit]
            todo = todo[~hit]
        return out

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, first id, number of ids) of each key."""
        slots = self.slots(hashes)
        known = slots >= 0
        known[known] = self.marks[slots[known]] == (hashes[known] >> np.uint64(32)).astype(np.uint32)
        at = np.where(known, slots, 0)
        if not len(self.marks):
            return known, at.astype(np.uint64), at.astype(np.uint64)
        return known, self.starts[at], self.sizes[at]


# files ----------------------------------------------------------------------
def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _put(uri: str, parts: list[bytes]) -> None:
    """Write under a name of this attempt's own, then rename: a task that runs
    twice leaves one whole file."""
    store, path = _open(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        for p in parts:
            f.write(p)
    store.move(own, path)


def _get(uri: str) -> bytes:
    store, path = _open(uri)
    with store.open_input_stream(path) as f:
        return f.read()


class ShardWriter:
    """One shard: ids go to its payload file as they come; what is held is a
    key and a size a document. The file is written under a name of this
    attempt's own and renamed at the end."""

    def __init__(self, folder: str, shard: int, id_bytes: int):
        self.folder, self.shard, self.id_bytes = folder, shard, id_bytes
        self.keys: list[int] = []
        self.nulls: list[bool] = []
        self.sizes: list[int] = []
        self.bytes = 0
        self._store, self._path = _open(f"{folder}/shard-{shard:06d}.ids")
        self._own = f"{self._path}.{uuid.uuid4().hex}"
        self._out = self._store.open_output_stream(self._own)

    def add(self, key: int | None, ids: bytes) -> None:
        """The next document, in document order."""
        self._out.write(ids)
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.sizes.append(len(ids) // self.id_bytes)
        self.bytes += len(ids)

    def close(self) -> tuple[int, int]:
        """Writes the index; documents and ids of the shard."""
        self._out.close()
        self._store.move(self._own, self._path)
        keys, nulls, sizes = np.array(self.keys, np.int64), np.array(self.nulls, bool), np.array(self.sizes, np.uint64)
        same = np.concatenate([[False], (keys[1:] == keys[:-1]) & (nulls[1:] == nulls[:-1])])[:len(keys)]
        run = np.arange(len(keys))
        ordinals = (run - np.maximum.accumulate(np.where(same, 0, run))).astype(np.uint32)
        seed, hashes = distinct_hashes(keys, nulls, ordinals)
        index = KeyIndex.build(hashes, np.cumsum(sizes) - sizes, sizes)
        head = np.array([len(keys), len(index.levels), self.id_bytes, seed, *index.levels], "<u8")
        _put(f"{self.folder}/shard-{self.shard:06d}.idx", [MAGIC, head.tobytes(), *(a.tobytes() for a in (
            index.words, index.before, index.marks, index.starts, index.sizes, keys, nulls.astype(np.uint8), ordinals))])
        return len(keys), int(sizes.sum())


class Shard:
    """A shard opened for keyed reading."""

    def __init__(self, folder: str, shard: int):
        raw = _get(f"{folder}/shard-{shard:06d}.idx")
        if raw[:8] != MAGIC:
            raise ValueError(f"not an index of token ids: {folder}, shard {shard}")
        n, levels, id_bytes, self.seed = map(int, np.frombuffer(raw, "<u8", 4, 8))
        at = 40

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        bits = take("<u8", levels).tolist()
        words = sum(-(-b // 64) for b in bits)
        self.index = KeyIndex(bits, take("<u8", words), take("<u8", words), take("<u4", n), take("<u8", n), take("<u8", n))
        self.keys, self.nulls, self.ordinals = take("<i8", n), take("u1", n).astype(bool), take("<u4", n)
        self.ids = np.frombuffer(_get(f"{folder}/shard-{shard:06d}.ids"), f"<u{id_bytes}")

    def lookup(self, keys: np.ndarray, nulls: np.ndarray, ordinals: np.ndarray) -> tuple[np.ndarray, ...]:
        return self.index.find(key_hash(keys, nulls, ordinals, self.seed))

    def get(self, key: int | None, ordinal: int = 0) -> np.ndarray | None:
        """Ids of one document, or None if the shard hasn't the key."""
        known, start, size = self.lookup(np.array([key or 0]), np.array([key is None]), np.array([ordinal]))
        return self.ids[int(start[0]):int(start[0] + size[0])] if known[0] else None


# encoding -------------------------------------------------------------------
class LibraryEncoder:
    """Ids by the tokenizers library. Where the tokenizer drops white space
    and marks word ends, each word is encoded once and remembered; new words
    go to the library many at a time, with a space between them, and the ids
    are cut after each word's end. Other tokenizers get whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        vocab = self._tokenizer.get_vocab()
        self.kind = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        self._words = Words(spec) if suffix and spec["pre_tokenizer"]["pretokenizers"][0].get("behavior") == "Removed" else None
        if self._words:
            self._ends = np.zeros(max(vocab.values()) + 1, bool)
            self._ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        got = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in got]

    def _learn(self, words: set[str], new: set[str]) -> None:
        """Two halves of memory, the older dropped when the younger is full."""
        if len(self._known) + len(new) > CACHED_WORDS:
            self._known, self._older = {}, self._known
            new = words
        back = new & self._older.keys()
        self._known.update(zip(back, map(self._older.__getitem__, back)))
        fresh = list(new - back)
        runs = [fresh[i:i + 1000] for i in range(0, len(fresh), 1000)]
        for run, ids in zip(runs, self._raw([" ".join(r) for r in runs])):
            cuts = np.flatnonzero(self._ends[ids]) + 1
            if len(cuts) == len(run):
                raw, width = ids.tobytes(), ids.itemsize
                at = [0, *(cuts * width).tolist()]
                self._known.update(zip(run, [raw[a:b] for a, b in zip(at, at[1:])]))
            else:   # a word that the library cuts further
                self._known.update(zip(run, (i.tobytes() for i in self._raw(run))))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self._words:
            return [i.tobytes() for i in self._raw(texts)]
        found = [[(self._words.of(plain), special) for plain, special in self._words.parts(t)] for t in texts]
        words = set().union(*(w for parts in found for w, _ in parts))
        new = words.difference(self._known)
        if new:
            self._learn(words, new)
        one = self._known.__getitem__
        return [b"".join(b"".join(map(one, w)) + (b"" if s is None else np.array(s, self.kind).tobytes())
                         for w, s in parts) for parts in found]


_loaded: dict[str, LibraryEncoder] = {}


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 2,
                      ranges: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode, append ``end_id`` to each document and write one payload and
    one index file a shard. Returns the manifest (shard, n_docs, n_ids) as
    written beside them.

    Ranges of doc_id, about ``RANGE_BYTES`` of text each, are written by a task
    each, which streams the ids and ends a shard after ``shard_bytes`` of them
    (and begins the next), so that neither a task nor a reader holds more,
    whatever a key's share of the rows. A key's copies are numbered in each
    shard anew.

    Null text is empty (just the end id); a null doc_id comes first; rows of
    a repeated doc_id stay in an order fixed by their ids. Ids, not texts,
    are shuffled, once. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    if ranges is None:
        text = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(partitions(spark), -(-text // RANGE_BYTES))
    bounds, _, _ = range_bounds(docs, "doc_id", ranges)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = LibraryEncoder(path)
        encoder = _loaded[path]
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for part in text_slices(batch):
                ids = [i + end for i in encoder.encode(text_list(part))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("shard"), pa.array(ids, pa.binary()),
                     pa.array([len(end)] * len(ids), pa.int32())], names=["doc_id", "shard", "ids", "id_bytes"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, piece = None, None, 0

        def done() -> pa.RecordBatch:
            n_docs, n_ids = out.close()
            return pa.RecordBatch.from_arrays([pa.array([out.shard], pa.int32()), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                                              names=["shard", "n_docs", "n_ids"])

        for batch in batches:
            for key, at, ids, size in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "ids", "id_bytes"))):
                if out is not None and (at != own or out.bytes >= shard_bytes and piece + 1 < PIECES):
                    yield done()
                    out = None
                if out is None:
                    piece = piece + 1 if at == own else 0
                    own = at
                    out = ShardWriter(folder, at * PIECES + piece, size)
                out.add(key, ids)
        if out is not None:
            yield done()

    store, at = _open(folder)
    store.create_dir(at, recursive=True)
    ids = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("shard", range_bucket("doc_id", bounds))
           .mapInArrow(encode, "doc_id bigint, shard int, ids binary, id_bytes int"))
    (ids.repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
        .mapInArrow(write, "shard int, n_docs bigint, n_ids bigint")
        .write.parquet(f"{folder}/manifest"))
    return spark.read.schema("shard int, n_docs bigint, n_ids bigint").parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: key, first id over all shards, number of
    ids, crc32 of the ids as 32-bit numbers. Each key is looked up in its
    shard's index. The manifest has a row a shard; running totals over it are
    all that the driver computes."""
    manifest = spark.read.schema("shard int, n_docs bigint, n_ids bigint").parquet(f"{folder}/manifest")
    total, begins = 0, []
    for m in manifest.orderBy("shard").collect():
        begins.append((m.shard, total))
        total += m.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, begin in zip(batch.column("shard").to_pylist(), batch.column("begin").to_pylist()):
                shard = Shard(folder, number)
                known, start, size = shard.lookup(shard.keys, shard.nulls, shard.ordinals)
                if not known.all():
                    raise ValueError(f"shard {number}: a key that its index hasn't")
                sums = [zlib.crc32(shard.ids[int(a):int(a + n)].astype("<u4").tobytes()) for a, n in zip(start, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, pa.int64(), mask=shard.nulls), pa.array(start.astype(np.int64) + begin),
                     pa.array(size.astype(np.int64)), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = spark.createDataFrame(begins, "shard int, begin bigint").repartition(max(1, len(begins)), "shard")
    return shards.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the files and read them back."""
    folder = folder or run_folder(docs.sparkSession, "tokens")
    write_token_files(docs, folder, path, end_id)
    return read_token_files(docs.sparkSession, folder)
