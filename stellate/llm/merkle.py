"""Merkle manifest of a table with nested-interval labels.

Every node carries the interval of leaf ranks that it covers. Nodes of one
tree are dealt into buckets by their level and the first rank of the bucket's
interval; a bucket of 2^BITS nodes climbs BITS levels at once and leaves one
node, its top, to the tier above. Going down again, each tier gets the paths
of its tops by an equality join on the bucket that contains them, and inside a
bucket a node's sibling is what remains of its parent's interval without its
own. So a leaf meets all its ancestors in a few joins of bounded groups, and
no task holds more than a bucket.

Leaves are ranked by a range sort; of a sorted part only its size and its first
and last tree reach the driver, to carry counts over the edges of parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(column: Column) -> Column:
    """``-`` if null, else byte count, colon, value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def tree_key(group: str) -> Column:
    """Trees by a column's value: its order is that of the values, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


# Ranks -----------------------------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of each tree inside a sorted part, and the trees."""
    part, last, run, at = TaskContext.get().partitionId(), None, -1, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("tree").dictionary_encode()
        names, code = codes.dictionary.to_pylist(), np.asarray(codes.indices)
        begin = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
        runs, place = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for b, e in zip(begin, [*begin[1:], len(code)]):
            if names[code[b]] != last:
                last, run, at = names[code[b]], run + 1, 0
            runs[b:e], place[b:e] = run, np.arange(at, at + e - b)
            at += e - b
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(code), part, np.int32)), pa.array(runs), pa.array(place)],
                                         [*batch.schema.names, "part", "run", "place"])


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``rank``, from 0 in each ``tree``, by ``order`` (null
    first). Rows that are equal in it get any of their ranks."""
    spark = nodes.sparkSession
    # equal rows may be very many, so that they are dealt out too
    salted = stored(nodes, "nodes").withColumn("_salt", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first(c) for c in ("tree", *order, "_salt")]
    dealt = salted.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("_salt")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    placed = stored(dealt.mapInArrow(_runs, f"{fields}, part int, run bigint, place bigint"), "ranks")
    # a row a part
    edges = placed.groupBy("part").agg(F.min(F.struct("run", "tree")).alias("first"), F.max(F.struct("run", "place", "tree")).alias("last")).orderBy("part").collect()
    carried, before = [], None
    for e in edges:
        held = before[1] if before and before[0] == e.first.tree else 0
        carried.append((e.part, held))
        before = (e.last.tree, e.last.place + 1 + (held if e.last.run == 0 else 0))
    carry = spark.createDataFrame(carried, "part int, held bigint")
    rank = (F.col("place") + F.when(F.col("run") == 0, F.col("held")).otherwise(0)).alias("rank")
    return placed.join(F.broadcast(carry), "part").select(*nodes.columns, rank)


# A bucket --------------------------------------------------------------------

@dataclass
class Bucket:
    """Nodes of a bucket, level by level, from those that are dealt into it
    to its top: first ranks and digests; the ends follow from the next."""

    levels: list[tuple[list[int], list[str]]]
    end: int

    @classmethod
    def climb(cls, nodes: pa.Table, bits: int) -> Bucket:
        """A bucket that is the whole tree, the first unless it is full, ends
        at one node; others climb all their levels, as nodes are left beside
        them."""
        low, digests = nodes.column("low").to_pylist(), nodes.column("digest").to_pylist()
        only = low[0] == 0 and len(low) < 1 << bits
        levels, end = [(low, digests)], nodes.column("high")[-1].as_py()
        while len(levels[-1][0]) > 1 or not only and len(levels) <= bits:
            low, own = levels[-1]
            levels.append((low[::2], [digest("".join(own[i:i + 2])) for i in range(0, len(own), 2)]))
        return cls(levels, end)

    def interval(self, level: int, k: int) -> tuple[int, int]:
        low = self.levels[level][0]
        return low[k], low[k + 1] if k + 1 < len(low) else self.end

    def siblings(self, k: int) -> list[str]:
        """From the node up to the top, for each level the sibling: ``L`` or
        ``R`` for its side, then its digest, or nothing."""
        path = []
        for level in range(len(self.levels) - 1):
            (low, high), (begin, end) = self.interval(level, k), self.interval(level + 1, k // 2)
            # the parent's interval without the node's
            side = "L" if begin < low else "R" if high < end else ""
            path.append(side and side + self.levels[level][1][k - 1 if side == "L" else k + 1])
            k //= 2
        return path

    def top(self) -> str:
        return self.levels[-1][1][0]


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and its siblings give."""
    for p in path:
        leaf = digest(p[1:] + leaf if p[:1] == "L" else leaf + p[1:])
    return leaf


def _in_order(table: pa.Table) -> pa.Table:
    return table.combine_chunks().sort_by("low")


# Tiers -----------------------------------------------------------------------

def _bucketed(nodes: DataFrame, tier: int, bits: int) -> DataFrame:
    """The bucket whose interval contains the node."""
    return nodes.withColumn("bucket", F.shiftright("low", bits * (tier + 1)))


def _tops(bits: int):
    def tops(nodes: pa.Table) -> pa.Table:
        t = _in_order(nodes)
        found = Bucket.climb(t, bits)
        return pa.table({"tree": t.column("tree").slice(0, 1), "low": t.column("low").slice(0, 1), "high": pa.array([found.end], pa.int64()),
                         "digest": [found.top()]})

    return tops


NODE = "tree string, low bigint, high bigint, digest string"
PATH = "tree string, low bigint, path array<string>, subroot string"


def _paths(bits: int):
    """Paths of a tier's nodes: inside their bucket, then that of its top."""
    def paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        t = _in_order(nodes)
        found = Bucket.climb(t, bits)
        rest, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        return pa.table({"tree": t.column("tree"), "low": t.column("low"),
                         "path": pa.array([found.siblings(k) + rest for k in range(t.num_rows)], pa.list_(pa.string())),
                         "subroot": pa.array([subroot] * t.num_rows, pa.string())})

    return paths


@dataclass
class Forest:
    """The tiers of some trees, from the leaves up, and their roots."""

    tiers: list[DataFrame]
    roots: DataFrame

    @classmethod
    def grow(cls, leaves: DataFrame) -> Forest:
        """``leaves``: NODE columns, ``low`` the rank."""
        tiers = [leaves]
        while True:
            tier = len(tiers) - 1
            climbed = stored(_bucketed(tiers[-1].select("tree", "low", "high", "digest"), tier, BITS)
                             .groupBy("tree", "bucket").applyInArrow(_tops(BITS), NODE), f"tier{tier + 1}")
            if climbed.where("low > 0").isEmpty():
                return cls(tiers, climbed)
            tiers.append(climbed)

    def down(self, above: DataFrame) -> DataFrame:
        """PATH of the buckets of leaves, from the trees' own paths."""
        paths = above
        for tier in range(len(self.tiers) - 1, 0, -1):
            paths = stored(_bucketed(self.tiers[tier], tier, BITS).groupBy("tree", "bucket")
                           .cogroup(_bucketed(paths, tier, BITS).groupBy("tree", "bucket")).applyInArrow(_paths(BITS), PATH), f"paths{tier}")
        return paths


RESULT = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
          "tree string, low bigint, siblings array<string>")


def _proofs(root: str, bits: int):
    def prove(leaves: pa.Table, above: pa.Table) -> pa.Table:
        t, n = _in_order(leaves), leaves.num_rows
        found = Bucket.climb(t, bits)
        rest, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        paths = [found.siblings(k) + rest for k in range(n)]
        folded = [fold(sent or leaf, p) for sent, leaf, p in zip(t.column("sent").to_pylist(), t.column("digest").to_pylist(), paths)]
        return pa.table({
            "doc_id": t.column("doc_id"), "leaf": t.column("digest"), "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array([digest("".join(p[1:] for p in path)) for path in paths], pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded]),
            "tree": t.column("tree"), "low": t.column("low"), "siblings": pa.array(paths, pa.list_(pa.string()))})

    return prove


@dataclass
class Manifest:
    """Trees of a table's leaves and the tree above them."""

    trees: Forest
    top: Forest
    root: str

    def nodes(self) -> DataFrame:
        """The nodes that are stored: tree, interval of leaf ranks [low, high)
        and digest of leaves, of every BITS-th level above, of the subroots
        (again, as intervals of tree ranks, under the tree ``null``), and of
        the root. The levels between follow from those below them."""
        def tiers(forest: Forest) -> list[DataFrame]:
            return [t.select("tree", "low", "high", "digest", F.lit(BITS * i).alias("level")) for i, t in enumerate(forest.tiers)] + [
                forest.roots.withColumn("level", F.lit(None).cast("int"))]

        own, *more = tiers(self.trees) + [t.withColumn("tree", F.lit(None).cast("string")) for t in tiers(self.top)]
        for t in more:
            own = own.unionByName(t)
        return own


def build_manifest(leaves: DataFrame, order: Sequence[str]) -> Manifest | None:
    """``leaves`` with tree and digest (and further columns), ranked in each
    tree by ``order``; None if there are none."""
    trees = Forest.grow(_as_nodes(ranked(leaves, order)))
    if trees.roots.isEmpty():
        return None
    subroots = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = Forest.grow(_as_nodes(ranked(subroots, ["name"])))
    return Manifest(trees, top, top.roots.first().digest)


def _as_nodes(leaves: DataFrame) -> DataFrame:
    """A leaf covers its own rank."""
    return leaves.withColumnRenamed("rank", "low").withColumn("high", F.col("low") + 1)


def prove(manifest: Manifest) -> DataFrame:
    """For every leaf its proof: siblings level by level, and whether the
    digest that was ``sent`` (the leaf's own if null) folds to the root."""
    spark = manifest.trees.roots.sparkSession
    nothing = spark.createDataFrame([("", 0, [], None)], PATH)
    forest, trees = manifest.top, manifest.trees
    # the subroots' paths in the tree above; each tree's buckets then carry them down
    of_roots = (_bucketed(forest.tiers[0].select("tree", "low", "high", "digest"), 0, BITS).groupBy("tree", "bucket")
                .cogroup(_bucketed(forest.down(nothing), 0, BITS).groupBy("tree", "bucket")).applyInArrow(_paths(BITS), PATH))
    named = of_roots.drop("subroot").join(forest.tiers[0].select("low", "name", F.col("digest").alias("subroot")), "low")
    above = trees.down(stored(named.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("low"), "path", "subroot"), "subroot-paths"))
    return (_bucketed(trees.tiers[0].select("tree", "low", "high", "digest", "doc_id", "sent"), 0, BITS).groupBy("tree", "bucket")
            .cogroup(_bucketed(above, 0, BITS).groupBy("tree", "bucket")).applyInArrow(_proofs(manifest.root, BITS), RESULT))


def verify_documents(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """For each document its leaf, the subroot of its ``lang``, the root, the
    digest of its proof, the root folded from the leaf that is received, and
    whether they agree; tree, rank and siblings with their sides follow.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Where
    ``tampered`` holds, n_chars is received with one added (null stays).
    Documents of a null lang are a tree of their own, the first. A null doc_id
    comes first in its tree; rows of one id come in order of their digests, and
    equal rows are leaves of their own side by side. An empty table gives no
    rows; other columns are ignored.
    """
    fields = [F.col(c) for c in FIELDS]
    more = [(c.cast("decimal(38,0)") + 1 if name == "n_chars" else c) for c, name in zip(fields, FIELDS)]
    sent = F.lit(None).cast("string") if tampered is None else F.when(tampered & F.col("n_chars").isNotNull(), leaf_digest(more))
    leaves = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tree_key("lang").alias("tree"),
                         leaf_digest(fields).alias("digest"), sent.alias("sent"))
    manifest = build_manifest(leaves, ["doc_id", "digest"])
    if manifest is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    return prove(manifest)


_SQL_FIELD = "coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_SQL_FIELD.format(c=n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


def _sql_climb(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT tree, 0 AS lev, k, n, h FROM {leaves}
  UNION ALL
  SELECT tree, lev + 1, k // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY k)) FROM {name} WHERE n > 1 GROUP BY tree, lev, k // 2)"""


#: CRC-32 bit by bit: a byte is taken in, then eight shifts (-1) follow.
_SQL_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""

MERKLE_SQL = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf("n_chars")} AS h,
    CASE WHEN {_SQL_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_sql_leaf("(CAST(n_chars AS HUGEINT) + 1)")} END AS sent FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS k,
    count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_sql_climb("up", "leaves")},
subroots AS MATERIALIZED (
  SELECT '' AS tree, u.tree AS name, lev AS levels, h, row_number() OVER (ORDER BY u.tree) - 1 AS k, count(*) OVER () AS n FROM up u WHERE n = 1),
{_sql_climb("above", "subroots")},
steps AS MATERIALIZED (
  SELECT l.r, i AS step, l.k >> i AS at, s.h AS sibling
  FROM leaves l JOIN subroots t ON t.name = l.tree CROSS JOIN LATERAL (SELECT unnest(range(t.levels)) AS i) g
  LEFT JOIN up s ON s.tree = l.tree AND s.lev = i AND s.k = xor(l.k >> i, 1)
  UNION ALL
  SELECT l.r, t.levels + i, t.k >> i, s.h
  FROM leaves l JOIN subroots t ON t.name = l.tree CROSS JOIN LATERAL (SELECT unnest(range((SELECT max(lev) FROM above))) AS i) g
  LEFT JOIN above s ON s.lev = i AND s.k = xor(t.k >> i, 1)),
proofs AS (SELECT r, count(*) AS n, string_agg(sibling, '' ORDER BY step) AS joined FROM steps GROUP BY r),
folded AS (
  SELECT r, CAST(0 AS BIGINT) AS step, coalesce(sent, h) AS h FROM leaves
  UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.h WHEN s.at % 2 = 1 THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM folded f JOIN steps s ON s.r = f.r AND s.step = f.step),
root AS (SELECT h FROM above WHERE n = 1)
SELECT l.doc_id, l.h AS leaf, t.h AS subroot, root.h AS root, sha256(coalesce(p.joined, '')) AS proof_sha256,
  f.h AS folded_root, f.h = root.h AS verified
FROM leaves l JOIN subroots t ON t.name = l.tree LEFT JOIN proofs p ON p.r = l.r
JOIN folded f ON f.r = l.r AND f.step = coalesce(p.n, 0) CROSS JOIN root"""
