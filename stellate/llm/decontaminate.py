"""Benchmark decontamination by word windows.

The windows of all benchmark items are hashed and broadcast as sorted arrays
with, for each, where its words lie in the items' text; a document's windows
are looked up by hash and every hit is verified on the bytes. Words are runs
of digits, letters and non-ASCII bytes after lower-casing A-Z, which in UTF-8
can be read off the bytes. An item of fewer words than a window, but not none,
is one window.

The items' words are normalised on Spark, where very long items are cut into
pieces that share the words of a window. If what is to be broadcast, text and
arrays, exceeds ``BROADCAST_BYTES`` (measured) the pieces are taken in groups
below that size, one pass over the documents each; what a pass finds travels
with the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import byte_runs, powers, run_hashes, stored, text_slices, unused_name, utf8

WINDOW = 13
BROADCAST_BYTES = 32 << 20
PIECE_WORDS = 100_000
WORD_BYTES = 32          # arrays for a word, further to its text
SHARE = 20   # contaminated: SHARE times the hit words reach the number of words
_WORD_BASE = 0xD6E8FEB86659FD93

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True


class WordTexts:
    """Words of several texts in one byte array: where each begins and ends,
    its hash, and the first word of each text."""

    def __init__(self, data: np.ndarray, cuts: np.ndarray):
        self.bytes = _LOWER[data]
        self.begin, self.end = byte_runs(_IS_WORD[self.bytes], cuts)
        self.first = np.searchsorted(self.begin, cuts)
        self.hash = run_hashes(self.bytes, self.begin, self.end)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words in a text."""
        n = len(self.begin)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hash * powers(_WORD_BASE, n), out=sums[1:])
        at = np.arange(n - size + 1)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = at[text[at] == text[at + size - 1]]
        return at, (sums[at + size] - sums[at]) * powers(pow(_WORD_BASE, -1, 2**64), n)[at]

    def phrase(self, at: int, size: int) -> bytes:
        """Bytes of ``size`` words from word ``at``, with a space between."""
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.begin[at:at + size], self.end[at:at + size]))


    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The words with a space after each, and where each begins."""
        size = self.end - self.begin + 1
        at = np.cumsum(size) - size
        total = int(size.sum())
        source = np.arange(total) + np.repeat(self.begin - at, size)
        out = np.full(total, 0x20, np.uint8)
        inside = np.ones(total, bool)
        inside[at + size - 1] = False
        out[inside] = self.bytes[source[inside]]
        return out, at


def _normalised(window: int):
    """(item_id, words, n): pieces of items, with a space between words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = WordTexts(*utf8(part))
                text, at = words.joined()
                at = np.append(at, len(text))
                rows = []
                for item, (a, b) in zip(part.column("item_id").to_pylist(), zip(words.first.tolist(), words.first[1:].tolist())):
                    for begin in range(a, max(b - window + 1, a + 1) if b > a else a, PIECE_WORDS):
                        end = min(b, begin + PIECE_WORDS + window - 1)
                        rows.append((item, text[at[begin]:at[end] - 1].tobytes(), end - begin))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                                                  pa.array([r[2] for r in rows], pa.int32())], ["item_id", "words", "n"])

    return run


class Windows:
    """The windows of one size: sorted hashes, the bytes of each, and the
    items (numbers) that have it. Equal hashes of different bytes lie side by
    side. An item without an id is no item, but its windows count."""

    def __init__(self, text: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray):
        order = np.lexsort((item, hashes))
        hashes, begin, end, item = hashes[order], begin[order], end[order], item[order]
        self.text = text
        edges = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(edges, len(hashes)))
        first, owners, at = [], [], [0]
        for e, n in zip(edges.tolist(), sizes.tolist()):
            by_bytes: dict[bytes, list[int]] = {}
            where: dict[bytes, int] = {}
            if n == 1:
                first.append(e)
                owners.append([int(item[e])] if item[e] >= 0 else [])
                continue
            for i in range(e, e + n):
                phrase = text[begin[i]:end[i]].tobytes()
                where.setdefault(phrase, i)
                own = by_bytes.setdefault(phrase, [])
                if item[i] >= 0 and (not own or own[-1] != item[i]):
                    own.append(int(item[i]))
            for phrase, i in where.items():
                first.append(i)
                owners.append(by_bytes[phrase])
        keep = np.array(first, np.int64)
        self.keys, self.begin, self.end = hashes[keep], begin[keep], end[keep]
        at = np.cumsum([0, *map(len, owners)])
        self.at, self.owners = at, np.array([o for own in owners for o in own], np.int32)

    def find(self, hash_at: int, phrase: bytes) -> np.ndarray | None:
        """Items of the window of these bytes, from the first place of its
        hash; None if there is no such window."""
        i = hash_at
        while i < len(self.keys) and self.keys[i] == self.keys[hash_at]:
            if self.text[self.begin[i]:self.end[i]].tobytes() == phrase:
                return self.owners[self.at[i]:self.at[i + 1]]
            i += 1
        return None


def benchmark_windows(rows: list[tuple[str | None, bytes]], window: int) -> tuple[list[str], dict[int, Windows]]:
    """The items' ids, and by size the windows of normalised pieces."""
    names = sorted({r[0] for r in rows if r[0] is not None})
    number = {name: i for i, name in enumerate(names)}
    data = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
    cuts = np.cumsum([0, *(len(r[1]) for r in rows)])
    words = WordTexts(data, cuts)
    item = np.array([number.get(r[0], -1) for r in rows], np.int64)
    sizes = np.minimum(np.diff(words.first), window)
    of_word = np.repeat(np.arange(len(rows)), np.diff(words.first))
    out = {}
    for size in np.unique(sizes[sizes > 0]).tolist():
        at, hashes = words.windows(size)
        own = sizes[of_word[at]] == size
        at, hashes = at[own], hashes[own]
        out[size] = Windows(words.bytes, hashes, words.begin[at], words.end[at + size - 1], item[of_word[at]])
    return names, out


def _search(words: WordTexts, benchmark: tuple[list[str], dict[int, Windows]]) -> tuple[np.ndarray, list[set[str]]]:
    """Which words lie in an occurrence, and the items found in each text."""
    names, windows = benchmark
    hit = np.zeros(len(words.begin) + 1, np.int64)
    items: list[set[int]] = [set() for _ in range(len(words.first) - 1)]
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for size, known in windows.items():
        at, values = words.windows(size)
        place = np.minimum(np.searchsorted(known.keys, values), len(known.keys) - 1)
        for i in np.flatnonzero(known.keys[place] == values).tolist():
            start = int(at[i])
            owners = known.find(int(place[i]), words.phrase(start, size))   # verified on the bytes
            if owners is not None:
                hit[start] += 1
                hit[start + size] -= 1
                items[text[start]].update(owners.tolist())
    return np.cumsum(hit[:-1]) > 0, [{names[i] for i in found} for found in items]


def _marked(docs: DataFrame, windows, names: tuple[str, str, str]) -> DataFrame:
    """The documents with, further to what they carry, the words in an
    occurrence and the items found; a narrow pass."""
    n_words, hits, items = names
    schema = StructType([f for f in docs.schema.fields if f.name not in names]
                        + [StructField(n_words, LongType()), StructField(hits, ArrayType(LongType())),
                           StructField(items, ArrayType(StringType()))])
    carried = [f.name for f in schema.fields[:-3]]
    again = hits in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = WordTexts(*utf8(part))
                hit, found = _search(words, windows.value)
                places = [np.flatnonzero(hit[a:b]).tolist() for a, b in zip(words.first, words.first[1:])]
                if again:
                    places = [sorted({*a, *b}) for a, b in zip(places, part.column(hits).to_pylist())]
                    found = [{*a, *b} for a, b in zip(found, part.column(items).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried]
                    + [pa.array(np.diff(words.first)), pa.array(places, pa.list_(pa.int64())),
                       pa.array([sorted(i) for i in found], pa.list_(pa.string()))], names=[*carried, *names])

    return docs.mapInArrow(run, schema)


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with three more columns, and their names: number of words,
    places of the words that lie in an occurrence of a benchmark window, and
    sorted ids of the items with such an occurrence."""
    spark = docs.sparkSession
    names = tuple(unused_name(docs, n) for n in ("n_words", "hits", "items"))
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    pieces = stored(items.mapInArrow(_normalised(window), "item_id string, words binary, n int").distinct(), "benchmark")
    size = pieces.agg(F.sum(F.octet_length("words") + WORD_BYTES * F.col("n") + 64)).first()[0] or 0
    groups = max(1, -(-size // broadcast_bytes))
    for g in range(groups):
        part = pieces if groups == 1 else pieces.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(groups)) == g)
        found = spark.sparkContext.broadcast(benchmark_windows([(r.item_id, bytes(r.words)) for r in part.collect()], window))
        docs = _marked(docs, found, names)
        if g + 1 < groups:   # one group's windows in memory at a time
            docs = stored(docs, "contamination")
    return docs, names


def _contaminated(names: tuple[str, str, str], share: int) -> Column:
    hits = F.size(names[1])
    return (hits > 0) & (share * hits >= F.col(names[0]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: number of words, of words in an occurrence (``hits``:
    their places) and of items found, a digest of those, and whether it is
    contaminated: some hit, and share * hits >= words.

    Null or wordless texts have no words and are clean; items of a null text
    have no windows, and those of a null id are searched for but not listed;
    each row of a repeated doc_id is judged by itself; an empty benchmark
    leaves every document clean; an empty table gives no rows; extra columns
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked, names = mark_contamination(rows, benchmark, window, broadcast_bytes)
    n_words, hits, items = map(F.col, names)
    return marked.select(
        "doc_id", n_words.alias("n_words"), F.size(hits).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        _contaminated(names, share).alias("contaminated"), hits.alias("hits"), items.alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for contaminated
    ones; those of null texts stay, and an empty table gives no rows."""
    marked, names = mark_contamination(docs, benchmark, window, broadcast_bytes)
    return marked.where(~_contaminated(names, share)).select(*docs.columns)
