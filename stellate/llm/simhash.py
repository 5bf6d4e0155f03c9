"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the hashes of a text's word shingles.
To find all pairs within ``radius`` bits, every bit position is given a
nonzero vector of radius + 1 bits; for each nonzero vector v there is a table
whose mask has the positions whose vector has an odd product with v. Any
``radius`` positions leave some v that none of them has an odd product with,
so a pair that differs only there has the same masked value in that table: no
pair is missed. The positions are dealt evenly, so a mask has about half the
bits.

Equal fingerprints are one node. A bucket of more than ``BUCKET`` nodes is not
compared: it is dealt out again by the masks of another dealing, which keep
the guarantee inside the bucket. After the last level so few bits are free
that the number of distinct fingerprints bounds the bucket. Inside a bucket
only the links that join two of its groups leave it, so links are fewer than
nodes per table, and components lose none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import partitions, stored, text_slices, unused_name
from .components import connected_components

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42
BUCKET = 1024
LEVELS = 3


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bitwise majority of the shingles' XXH64, repeats included; zero for a
    text without words."""
    words = text.encode().lower().split()   # bytes: A-Z only; splits at \x20 and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def masks(radius: int, level: int = 0) -> list[int]:
    """The tables' masks; each level deals the positions in another order."""
    vectors = (1 << (radius + 1)) - 1
    order = np.random.default_rng([level, radius]).permutation(BITS)
    vector = {int(p): 1 + i % vectors for i, p in enumerate(order)}
    return [sum(1 << p for p in range(BITS) if (vector[p] & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Of one bucket's distinct fingerprints, links within the radius that
    join its parts (a spanning forest of all links)."""
    parent = list(range(len(values)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i in range(len(values) - 1):
        near = np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius)
        for j in (near + i + 1).tolist():
            a, b = top(i), top(j)
            if a != b:
                parent[b] = a
                out.append((i, j))
    return out


EDGES = "a bigint, b bigint, cell bigint"


def _compare(radius: int, bucket: int, last: bool):
    """Over rows (cell, fp) in order of cell: links (a, b, null) of small
    buckets, (fp, null, cell) of the nodes of larger ones, unless last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cell, held = None, np.zeros(0, np.int64)
        large = False   # the held bucket is known to be too large

        def emit(a, b, cell) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, cell)], names=["a", "b", "cell"])

        def done() -> Iterator[pa.RecordBatch]:
            values = np.unique(held)
            if large or len(values) > bucket and not last:
                yield emit(values, [None] * len(values), [held_cell] * len(values))
            elif len(values) > 1:
                links = _links(values.view(np.uint64), radius)
                if links:
                    at = np.array(links)
                    yield emit(values[at[:, 0]], values[at[:, 1]], [None] * len(at))

        for batch in batches:
            cell, fp = batch.column("cell").to_numpy(), batch.column("fp").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            alone = np.diff(cuts) == 1
            for k in np.flatnonzero(~alone | (np.arange(len(alone)) == 0) | (np.arange(len(alone)) == len(alone) - 1)).tolist():
                a, b = int(cuts[k]), int(cuts[k + 1])
                if a == b:
                    continue
                if cell[a] != held_cell:
                    if held_cell is not None:
                        yield from done()
                    held_cell, held, large = int(cell[a]), fp[a:b], False
                else:
                    held = np.concatenate([held, fp[a:b]])
                if len(held) > bucket and not last:   # send on, hold nothing
                    values = np.unique(held)
                    if large or len(values) > bucket:
                        yield emit(values, [None] * len(values), [held_cell] * len(values))
                        held, large = held[:0], True
        if held_cell is not None:
            yield from done()

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that differ in
    at most ``radius`` bits; enough of them to give the same components as
    all such pairs."""
    spark = nodes.sparkSession
    edges, todo = None, nodes.select(F.lit(0).cast("bigint").alias("cell"), "fp")
    for level in range(LEVELS):
        keyed = F.array(*[F.xxhash64(F.lit(level), F.lit(t), "cell", F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")))
                          for t, m in enumerate(masks(radius, level))])
        cells = todo.select("fp", F.explode(keyed).alias("cell"))
        found = stored(cells.repartition(partitions(spark), "cell").sortWithinPartitions("cell")
                       .mapInArrow(_compare(radius, bucket, level + 1 == LEVELS), EDGES), "links")
        links = found.where("b is not null").select("a", "b")
        edges = links if edges is None else edges.union(links)
        todo = found.where("b is null").select("cell", F.col("a").alias("fp"))
        if todo.isEmpty():
            break
    return edges


def _with_fingerprint(docs: DataFrame, name: str, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                # one text at a time: only its own shingles are held
                values = [_signed(fingerprint(t.as_py() or "", shingle)) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.int64())],
                                                 names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def fingerprint_components(fingerprints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(fp, root) for fingerprints with a link; the others stand alone."""
    return connected_components(near_links(fingerprints.select("fp").distinct(), radius, bucket)).toDF("fp", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Per row: doc_id, fingerprint as 16 hex digits, and component_id, the
    smallest doc_id that links of at most ``radius`` bits reach.

    Null and wordless texts have the fingerprint zero and link like others; a
    null doc_id is never a component's id unless all are null (then null);
    repeated rows give a row each; other columns are ignored; an empty table
    gives no rows.
    """
    rows = stored(_with_fingerprint(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "fp", shingle)
                  .select("doc_id", "fp"), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = nodes.join(fingerprint_components(nodes, radius, bucket), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for one of each
    component: the one of the smallest doc_id (a null id is largest)."""
    fp, row = unused_name(docs, "fp"), unused_name(docs, "row")
    rows = stored(_with_fingerprint(docs, fp, shingle).withColumn(row, F.monotonically_increasing_id()), "rows")
    rooted = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    nodes = rooted.groupBy("fp").agg(first.alias("low"))
    winners = (nodes.join(fingerprint_components(nodes, radius, bucket), "fp", "left")
               .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low"))
               .select(F.col("low.row").alias(row)))
    return rows.join(winners, row, "left_semi").select(*docs.columns)
