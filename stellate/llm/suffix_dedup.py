"""Removal of repeated byte strings, by longest previous factors.

A byte goes if it lies in a string of ``length`` bytes that also starts
earlier, that is, if the longest previous factor at some start covering it
reaches ``length``. In suffix order, with equal prefixes by position, a start
has such a factor exactly if the start before it (its previous smaller
position there) shares ``length`` bytes with it; so suffixes need to be in
order only up to that depth, and only where a repeat is possible.

Starts are dealt out by content. The anchor of a start is the ``GRAM`` bytes
of smallest hash in the string that begins there; equal strings have equal
anchors at equal places. Neighbouring starts mostly share theirs, and make a
segment. The steps:

1. each group of documents lists its anchors, once each;
2. anchors that come twice anywhere go back to the groups that have them;
3. the groups send the segments of those anchors, a text once per group;
4. per anchor, equal segments are repeats as a whole; suffix order of the
   starts of the different ones gives the rest. An anchor with very many
   different segments is dealt out again by whole strings, each start on its
   own, where again all but the first are repeats;
5. the groups cut the repeats out of their texts.

Groups hold some MB of text whatever the input; no step holds all segments of
an anchor, and copies inside a group leave it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

LENGTH = 100
GRAM = 32
GROUP_BYTES = 16 << 20
PIECE = 2 << 20            # starts handled at once; below 2^24
SEGMENTS = 4096            # different segments of one anchor held at once
STARTS = 1 << 18           # starts put in suffix order at once
_PLACE = np.uint64((1 << 24) - 1)
_MULTIPLIERS = tuple(int(x) | 1 for x in np.random.default_rng(5).integers(1 << 62, 1 << 63, 8))
_LETTERS = np.random.default_rng(6).integers(0, 1 << 63, 256, dtype=np.uint64)

Piece = tuple[int, int, bytes]   # document's number in its group, offset, bytes


def _pieces(texts: list[bytes], length: int) -> Iterator[list[Piece]]:
    """Texts in runs of about PIECE bytes; a longer text in parts that
    overlap, so that every start is in one part with its whole string."""
    run, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text if len(text) <= PIECE else text[at:at + PIECE + length - 1]
            if run and size + len(part) > PIECE:
                yield run
                run, size = [], 0
            run.append((number, at, part))
            size += len(part)
    if run:
        yield run


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every ``size`` neighbours, by doubling."""
    span = 1
    while 2 * span <= size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = size - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all runs of ``gram`` bytes, a power of two."""
    values, span, level = _LETTERS[data], 1, 0
    while span < gram:
        values = values[:-span] * np.uint64(_MULTIPLIERS[level]) + values[span:]
        values ^= values >> np.uint64(31)
        span, level = 2 * span, level + 1
    return values * np.uint64(_MULTIPLIERS[-1])


def segments(run: list[Piece], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of a run of pieces: (anchor hash, piece, first start, last
    start), starts counted in the run's joined bytes."""
    data = np.frombuffer(b"".join(p for _, _, p in run), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    hashes = _gram_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _window_min(hashes & ~_PLACE | places, length - gram + 1)
    ends = np.cumsum([len(p) for _, _, p in run])
    piece = np.repeat(np.arange(len(run)), [len(p) for _, _, p in run])[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + length <= ends[piece])
    if not len(start):
        return (np.zeros(0, np.int64),) * 4
    anchor = (least[start] & _PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(start) - 1]])
    return hashes[anchor[first]].view(np.int64), piece[start[first]], start[first], start[last]


def repeats_in_suffix_order(texts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """For all starts of the texts in turn (in the order of their positions):
    whether the string of ``length`` bytes there starts earlier, too."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    counts = np.maximum(0, sizes - length + 1)
    starts = np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    if not len(starts):
        return np.zeros(0, bool)
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts]).view(f"S{length}").ravel()
    order = np.argsort(strings, kind="stable")          # suffix array, equal prefixes by position
    shared = strings[order[1:]] == strings[order[:-1]]  # common prefix with the one before reaches length
    out = np.zeros(len(starts), bool)
    out[order[1:][shared]] = True
    return out


def _ordered(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """A group's (doc_id, text) in ascending order; null ids first."""
    least = np.iinfo(np.int64).min
    rows = sorted(zip((least if d is None else d for d in table.column("doc_id").to_pylist()),
                      table.column("text").cast(pa.large_binary()).to_pylist()))
    return np.array([d for d, _ in rows], np.int64), [t for _, t in rows]


def _joined(number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document, overlapping or touching ones as one."""
    if not len(number):
        return number, low, high
    order = np.lexsort((low, number))
    number, low, high = number[order], low[order], high[order]
    base = number.astype(np.int64) << 40
    reach = np.maximum.accumulate(base + high)
    new = np.concatenate([[True], (number[1:] != number[:-1]) | (base[1:] + low[1:] > reach[:-1])])
    at = np.flatnonzero(new)
    return number[at], low[at], reach[np.concatenate([at[1:] - 1, [len(reach) - 1]])] - base[at]


FOUND = "anchor bigint, doc_id bigint, grp int, number int, low bigint, high bigint, text binary"
_FOUND = ["anchor", "doc_id", "grp", "number", "low", "high", "text"]
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, _FOUND_TYPES)], names=_FOUND)


def _anchors(length: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        _, texts = _ordered(table)
        keys = [segments(r, length, gram)[0] for r in _pieces(texts, length)]
        keys, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        return pa.table({"anchor": pa.array(keys, pa.int64()), "grp": pa.array(np.full(len(keys), table.column("grp")[0].as_py()), pa.int32()),
                         "many": pa.array(n > 1, pa.bool_())})

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one partition's (anchor, grp, many): those that come twice."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    keys = np.concatenate([b.column("anchor").to_numpy() for b in table])
    groups = np.concatenate([b.column("grp").to_numpy() for b in table])
    many = np.concatenate([b.column("many").to_numpy(zero_copy_only=False) for b in table])
    order = np.argsort(keys, kind="stable")
    keys, groups, many = keys[order], groups[order], many[order]
    same = keys[1:] == keys[:-1]
    twice = many | np.concatenate([[False], same]) | np.concatenate([same, [False]])
    yield pa.RecordBatch.from_arrays([pa.array(keys[twice]), pa.array(groups[twice], pa.int32())], names=["anchor", "grp"])


def _segments(length: int, gram: int):
    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        if not docs.num_rows or not wanted.num_rows:
            return pa.Table.from_batches([_found([])])
        ids, texts = _ordered(docs)
        group = docs.column("grp")[0].as_py()
        keys = np.sort(wanted.column("anchor").to_numpy())
        seen: set[bytes] = set()
        rows, again = [], []
        for pieces in _pieces(texts, length):
            key, piece, first, last = segments(pieces, length, gram)
            begins = np.cumsum([0, *(len(p) for _, _, p in pieces)])
            at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key)
            for k, i, low, high in zip(key[at].tolist(), piece[at].tolist(), first[at].tolist(), last[at].tolist()):
                number, offset, part = pieces[i]
                low, high = low - int(begins[i]), high - int(begins[i]) + length
                text = part[low:high]
                if text in seen:   # the earlier one stands for both
                    again.append((number, low + offset, high + offset))
                else:
                    seen.add(text)
                    rows.append((k, int(ids[number]), group, number, low + offset, high + offset, text))
        if again:
            number, low, high = _joined(*map(np.array, zip(*again)))
            rows += [(int(n) * 1_000_003 + group, 0, group, int(n), int(a), int(b), None)
                     for n, a, b in zip(number, low, high)]
        return pa.Table.from_batches([_found(rows)])

    return run


WINDOW = "route bigint, mark bigint, doc_id bigint, grp int, number int, low bigint, high bigint"
_WINDOW = ["route", "mark", "doc_id", "grp", "number", "low", "high"]
_WINDOW_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


def _windows(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _WINDOW_TYPES)], names=_WINDOW)


def _resolve(length: int, held_segments: int):
    """Over rows in order of (anchor, text, position): repeats (mark null),
    and single starts (route and mark: two hashes of the string) of anchors
    with more different segments than are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []        # (doc_id, grp, number, low, high) of repeats
        pool: list[tuple] = []       # different segments of whole anchors
        pooled = 0
        held: list[tuple] = []       # of the present anchor
        anchor, text, spread = None, None, False

        def repeats() -> pa.RecordBatch:
            rows = out.copy()
            out.clear()
            _, group, number, low, high = zip(*rows)
            route = [n * 1_000_003 + g for n, g in zip(number, group)]
            return _windows([route, [None] * len(rows), [0] * len(rows), group, number, low, high])

        def order_pool() -> None:
            nonlocal pooled
            flags = repeats_in_suffix_order([s[5] for s in pool], length)
            at = 0
            for doc_id, number, low, group, _, body in pool:
                n = len(body) - length + 1
                own = flags[at:at + n]
                at += n
                if own.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                    out.extend((doc_id, group, number, low + int(a), low + int(b) - 1 + length)
                               for a, b in zip(edge[::2], edge[1::2]))
            pool.clear()
            pooled = 0

        def single_starts(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for doc_id, number, low, group, _, body in rows:
                n = len(body) - length + 1
                digests = b"".join(hashlib.blake2b(body[i:i + length], digest_size=16).digest() for i in range(n))
                route, mark = np.frombuffer(digests, "<i8").reshape(-1, 2).T
                starts = np.arange(low, low + n)
                yield _windows([route, mark, np.full(n, doc_id), np.full(n, group), np.full(n, number), starts, starts + length])

        def end_anchor() -> Iterator[pa.RecordBatch]:
            nonlocal pooled
            if spread:
                yield from single_starts(held)
            elif len(held) > 1:
                pool.extend(sorted(held))
                pooled += sum(len(s[5]) - length + 1 for s in held)
                if pooled >= STARTS:
                    order_pool()
            held.clear()

        for batch in batches:
            for key, doc_id, group, number, low, high, body in zip(*(batch.column(c).to_pylist() for c in _FOUND)):
                if body is None:
                    out.append((doc_id, group, number, low, high))
                    continue
                if key != anchor:
                    yield from end_anchor()
                    anchor, text, spread = key, None, False
                if body == text:   # the first of equal segments is the earliest
                    out.append((doc_id, group, number, low, high))
                    continue
                text = body
                held.append((doc_id, number, low, group, high, body))
                if len(held) >= held_segments:
                    spread = True
                    yield from single_starts(held)
                    held.clear()
            if out:
                yield repeats()
        yield from end_anchor()
        if pool:
            order_pool()
        if out:
            yield repeats()

    return run


def _later_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over single starts in order of (string, position): all but the first
    of each; repeats pass through. Gives (grp, number, low, high)."""
    before = None
    for batch in batches:
        single = batch.column("mark").is_valid().to_numpy(zero_copy_only=False)
        route = batch.column("route").to_numpy()
        mark = batch.column("mark").fill_null(0).to_numpy()
        later = np.concatenate([[False], (route[1:] == route[:-1]) & (mark[1:] == mark[:-1]) & single[:-1]])
        if len(later) and single[0]:
            later[0] = before == (route[0], mark[0])
        keep = pa.array(later & single | ~single)
        if len(route):
            before = (route[-1], mark[-1]) if single[-1] else None
        yield batch.select(["grp", "number", "low", "high"]).filter(keep)


RESULT = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
          "spans array<struct<start:bigint,end:bigint>>, kept binary")


def _cut(with_text: bool):
    def run(docs: pa.Table, intervals: pa.Table) -> pa.Table:
        ids, texts = _ordered(docs)
        number, low, high = _joined(*(intervals.column(c).to_numpy() for c in ("number", "low", "high")))
        bounds = np.searchsorted(number, np.arange(len(texts) + 1))
        n_removed, digests, spans, kept = [], [], [], []
        for i, text in enumerate(texts):
            own = list(zip(low[bounds[i]:bounds[i + 1]].tolist(), high[bounds[i]:bounds[i + 1]].tolist()))
            edges = [0, *(x for span in own for x in span), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if own else text
            n_removed.append(len(text) - len(rest))
            digests.append(hashlib.sha256(rest).hexdigest())
            spans.append([{"start": a, "end": b} for a, b in own])
            kept.append(rest if with_text else None)
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array([len(s) for s in spans], pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary())})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, held_segments: int = SEGMENTS,
                   with_text: bool = False) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs (``spans``), sha256 of
    what is left and, if asked for, that itself (``kept``: bytes, as a cut
    may fall inside a character).

    A null text is empty; a null doc_id comes before all others; rows of a
    repeated doc_id count as different documents in the order of their texts,
    so of equal rows one stays. Texts shorter than ``length`` stay whole. An
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-size // GROUP_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("grp")).repartitionById(n, "grp")
    anchors = rows.groupBy("grp").applyInArrow(_anchors(length, gram), "anchor bigint, grp int, many boolean")
    wanted = anchors.repartition(n, "anchor").mapInArrow(_repeated, "anchor bigint, grp int").repartitionById(n, "grp")
    found = rows.groupBy("grp").cogroup(wanted.groupBy("grp")).applyInArrow(_segments(length, gram), FOUND)
    solved = (found.repartition(n, "anchor").sortWithinPartitions("anchor", "text", "doc_id", "number", "low")
              .mapInArrow(_resolve(length, held_segments), WINDOW))
    repeats = (solved.repartition(n, "route").sortWithinPartitions("route", "mark", "doc_id", "number", "low")
               .mapInArrow(_later_starts, "grp int, number int, low bigint, high bigint").repartitionById(n, "grp"))
    return rows.groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(_cut(with_text), RESULT)
