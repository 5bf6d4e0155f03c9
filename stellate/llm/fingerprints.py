"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` keeps, for a sequence of code points, the running sums of
``c_j * B^j`` modulo two primes. Any span's hash follows from two entries, so
span equality costs O(1) and the longest common extension of two positions is
found by binary search: so the query tells how many code points a text shares
with its edit and with the next text before they differ. A document's
fingerprint is its length, the hash of the whole text and the smallest hashes
of its spans; the likeness of two fingerprints estimates the Jaccard index of
their span sets from those.

Spans have ``SPAN`` code points, in texts of fewer than four spans the largest
power of two of which there are four (one code point at least). Texts of fewer
than eight spans also keep the smaller powers, and two texts are compared at
the span length of the shorter one, so that an unchanged half of a short text
is seen. Two texts without a common span length (one has fewer than 64, the
other 128 code points or more) have likeness 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, range_bounds, range_bucket

PRIME = np.uint64(2**31 - 1)
BASES = (1_103_515_245, 48_271 * 40_692 % (2**31 - 1))
SPAN = 16
SKETCH = 24
CHUNK_CHARS = 1 << 19

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """``base**j`` modulo the prime for j below ``n``, grown by doubling."""
    got = _powers.get(base)
    if got is None:
        got = np.ones(1, np.uint64)
    while len(got) < n:
        got = np.concatenate([got, got * np.uint64(pow(base, len(got), int(PRIME))) % PRIME])
    _powers[base] = got
    return got[:n]


class PrefixHashes:
    """Prefix hashes of one array of code points (several texts may lie in it
    one after the other; spans inside a text don't depend on the others)."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self._sums, self._inverse = [], []
        values = codes.astype(np.uint64) + np.uint64(1)
        for base in BASES:
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * _power_table(base, self.n) % PRIME, out=sums[1:])
            self._sums.append(sums % PRIME)
            self._inverse.append(_power_table(pow(base, -1, int(PRIME)), self.n + 1))

    def span(self, start, end) -> np.ndarray:
        """62-bit hashes of the spans [start, end); arrays or numbers."""
        start, end = np.asarray(start), np.asarray(end)
        parts = [(sums[end] + PRIME - sums[start]) % PRIME * inverse[start] % PRIME
                 for sums, inverse in zip(self._sums, self._inverse)]
        return parts[0] << np.uint64(31) | parts[1]

    def equal(self, i, j, length) -> np.ndarray:
        """Whether the spans of ``length`` at ``i`` and at ``j`` are the same."""
        i, j, length = map(np.asarray, (i, j, length))
        return self.span(i, i + length) == self.span(j, j + length)

    def common_extension(self, i, j, most) -> np.ndarray:
        """Longest length up to ``most`` at which the spans from ``i`` and
        ``j`` agree: binary search over span equality."""
        i, j, high = (np.array(x, np.int64, ndmin=1) for x in np.broadcast_arrays(i, j, most))
        high = np.minimum(high, self.n - np.maximum(i, j))
        low = np.zeros_like(high)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.equal(i, j, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _smallest(values: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    if len(values) > 8 * k:
        some = np.unique(np.partition(values, 4 * k)[:4 * k])
        if len(some) >= k:
            return some[:k]
    return np.unique(values)[:k]


def spans_of(n: int) -> list[int]:
    """Span lengths that a text of ``n`` code points is sketched at, its own first."""
    if n >= 8 * SPAN:
        return [SPAN]
    own = min(SPAN, 1 << max(0, (n // 4).bit_length() - 1))
    return [1 << k for k in reversed(range(own.bit_length()))]


class Texts:
    """Prefix hashes of several texts, one after the other."""

    def __init__(self, texts: list[str]):
        codes = [_codes(t) for t in texts]
        self.size = np.array([len(c) for c in codes], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.hashes = PrefixHashes(np.concatenate(codes) if codes else np.zeros(0, np.uint32))

    def sketches(self) -> list[tuple[int, int, dict[int, np.ndarray]]]:
        """(code points, hash of the whole text, by span length the smallest
        span hashes) of each."""
        whole = self.hashes.span(self.begin, self.begin + self.size).tolist() if len(self.size) else []
        n = self.hashes.n
        every = self.hashes.span(np.arange(max(0, n - SPAN + 1)), np.arange(SPAN, n + 1)) if n >= SPAN else None
        out = []
        for start, size, value in zip(self.begin.tolist(), self.size.tolist(), whole):
            kept = {}
            for k in spans_of(size) if size else []:
                spans = every[start:start + size - k + 1] if k == SPAN else self.hashes.span(
                    np.arange(start, start + size - k + 1), np.arange(start + k, start + size + 1))
                kept[k] = _smallest(spans, SKETCH)
            out.append((size, value, kept))
        return out

    def common_prefix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Code points that texts ``i`` and ``j`` share before they differ."""
        return self.hashes.common_extension(self.begin[i], self.begin[j], np.minimum(self.size[i], self.size[j]))


def sketches(texts: list[str]) -> list[tuple[int, int, dict[int, np.ndarray]]]:
    return Texts(texts).sketches()


def fingerprint(sketch: tuple[int, int, dict[int, np.ndarray]]) -> str:
    n, whole, kept = sketch
    return f"{n:08x}{whole:016x}" + "".join("".join(f"{v:016x}" for v in kept[k].tolist()) for k in sorted(kept, reverse=True))


def likeness(a: tuple[int, int, dict[int, np.ndarray]], b: tuple[int, int, dict[int, np.ndarray]]) -> float:
    """Estimated Jaccard index of the two texts' spans, 1 for equal texts."""
    if a[:2] == b[:2]:
        return 1.0
    common = a[2].keys() & b[2].keys()
    if not common:
        return 0.0
    k = max(common)
    some = np.union1d(a[2][k], b[2][k])[:SKETCH]
    return float(np.isin(some, np.intersect1d(a[2][k], b[2][k])).mean())


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by the first
    as many of the following text, or by all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, prefix_edited bigint, prefix_next bigint")


def _rows(run: list[tuple[int | None, str, bool]]) -> pa.RecordBatch:
    """Results for a run of neighbours (id, text, is it only a neighbour's
    end); the last entry only serves as the following text."""
    texts = [text for _, text, _ in run]
    at = [i for i, (_, _, end) in enumerate(run[:-1]) if not end]
    changed = [edited(texts[i], texts[i + 1]) for i in at]
    both = Texts(texts + changed)
    found = both.sketches()
    plain, other = found[:len(texts)], found[len(texts):]
    own = np.array(at, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array([run[i][0] for i in at], pa.int64()),
        pa.array([plain[i][0] for i in at], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([fingerprint(plain[i]) for i in at], pa.string()),
        pa.array([fingerprint(s) for s in other], pa.string()),
        pa.array([likeness(plain[i], s) for i, s in zip(at, other)], pa.float64()),
        pa.array([likeness(plain[i], plain[i + 1]) for i in at], pa.float64()),
        pa.array(both.common_prefix(own, len(texts) + np.arange(len(at))), pa.int64()),
        pa.array(both.common_prefix(own, own + 1), pa.int64()),
    ], names=[part.split()[0] for part in SCHEMA.split(", ")])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, size = [], 0
    for batch in batches:
        ids, ends = batch.column("doc_id"), batch.column("_end")
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_py() or ""
            run.append((ids[i].as_py(), text, ends[i].as_py()))
            size += len(text)
            if size >= CHUNK_CHARS and len(run) > 1:
                yield _rows(run)
                run, size = run[-1:], len(text)
    if len(run) > 1:
        yield _rows(run)


def document_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document, their
    likeness, and how many code points the text shares with its edit
    (``prefix_edited``) and with the next text (``prefix_next``) before they
    differ.

    Documents are in ascending doc_id order (null first; repeated ids by
    text), the first follows the last. Null text counts as empty; other
    columns are ignored; an empty table gives no rows. Texts are dealt once,
    into ranges of doc_id; the row that begins a range also goes to the range
    before it, as the end of its last neighbour.
    """
    bounds, low, nulls = range_bounds(docs, "doc_id", buckets or partitions(docs.sparkSession))
    starts = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.lit(None).cast("array<bigint>")
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.withColumn("_own", range_bucket("doc_id", bounds))
    ends = [F.when(F.coalesce(first, F.lit(False)), F.lit(len(bounds)))]
    if bounds:
        ends.append(F.when(F.array_contains(starts, F.col("doc_id")), F.col("_own") - 1))
    places = F.array(F.struct(F.col("_own").alias("_bucket"), F.lit(False).alias("_end")),
                     *[F.struct(e.alias("_bucket"), F.lit(True).alias("_end")) for e in ends])
    dealt = (dealt.select("doc_id", "text", F.explode(F.filter(places, lambda p: p["_bucket"].isNotNull())).alias("_p"))
             .select("doc_id", "text", "_p.*")
             .repartitionById(len(bounds) + 1, "_bucket")
             .sortWithinPartitions("_bucket", "_end", F.col("doc_id").asc_nulls_first(), "text"))
    return dealt.mapInArrow(_neighbours, SCHEMA)
