"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. The angle between
an anchor and a row lies between the largest difference and the smallest sum
of their angles to a reference, so its cosine lies in an interval, which the
norms turn into bounds of the score; the angles carry a slack above their
rounding error. Only rows whose bounds reach an anchor's window get an integer
score. First each anchor's positives are found (its window begins at the worst
positive so far), then for each positive the first negatives of its window.

Anchors go in blocks of bounded size, broadcast one after the other; the rows
stay where they are and each task returns a few rows an anchor. Nothing but a
block of anchors reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import run_folder, stored

SCALE = 256
REFERENCES = 16
SAMPLE = 2_048            # rows that the references are chosen from
BLOCK_BYTES = 8 << 20     # vectors of the anchors that are broadcast at once
PAIRS = 1 << 18           # (anchor, row) pairs bounded at once
ROWS = 2_048
ROUNDS = 8               # of k-means for the references
SLACK = 4e-6              # radians; far above the rounding of float32 angles and of arccos
_EXACT = float(1 << 53)
_LOW = -(1 << 63)
_KEYS = ["row", "id", "label", "anchor", "v"]


def _matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """Vectors of equal length as a matrix."""
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), -1)


def _angles(v: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    unit = v / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(unit @ references.T, -1.0, 1.0)).astype(np.float32)


def _references(rows: DataFrame, k: int) -> dict[int, np.ndarray]:
    """By dimension, up to ``k`` directions: middles of the groups that
    spherical k-means finds among the rows of smallest hash."""
    sample = rows.select("v").where(F.size("v") > 0).withColumn("h", F.xxhash64("v")).orderBy("h").limit(SAMPLE).collect()
    found: dict[int, np.ndarray] = {}
    for dim in {len(r.v) for r in sample}:
        v = np.array([r.v for r in sample if len(r.v) == dim], float)
        unit = np.unique(v[np.any(v != 0, 1)], axis=0)
        if not len(unit):
            continue
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        middle = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
        for _ in range(ROUNDS):
            near = np.argmax(unit @ middle.T, 1)
            sums = np.zeros_like(middle)
            np.add.at(sums, near, unit)
            size = np.linalg.norm(sums, axis=1)
            # a group whose rows cancel out keeps its direction
            middle = np.where((size > 1e-9)[:, None], sums / np.where(size > 1e-9, size, 1.0)[:, None], middle)
        found[dim] = middle
    return found


def _prepared(rows: DataFrame, scale: int, k: int) -> DataFrame:
    """(row, id, label, anchor, v, norm, angles) of the rows that take part."""
    x = F.col("vector")
    fit = rows.where("label IS NOT NULL AND vector IS NOT NULL").where(
        ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))))
    # numbered once, over a written table, so that no recomputed task can number otherwise
    whole = stored(fit.select("id", F.col("label").cast("string").alias("label"), "anchor",
                              F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("bigint")).alias("v")), "vectors")
    references = _references(whole, k)
    shared = rows.sparkSession.sparkContext.broadcast(references)
    schema = "row bigint, id bigint, label string, anchor boolean, v array<bigint>, norm double, angles array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column("v").value_lengths())
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                v = _matrix(part.column("v"))
                if v.size and np.abs(v).max() >= _EXACT:
                    raise OverflowError("a component times the scale lies beyond 2^53")
                norms = np.sqrt((v * v).sum(1))
                refs = shared.value.get(int(dim))
                angles = np.zeros((len(v), 0), np.float32) if refs is None else _angles(v, norms, refs)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in _KEYS), pa.array(norms),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * angles.shape[1], pa.int32()), pa.array(angles.ravel()))],
                    [*_KEYS, "norm", "angles"])

    return stored(whole.select(F.monotonically_increasing_id().alias("row"), *_KEYS[1:]).mapInArrow(run, schema), "angles")


class Best:
    """For each of n slots its first k by score (higher first) and id (null
    first, then smaller first)."""

    def __init__(self, n: int, k: int):
        self.k, self.score = k, np.full((n, k), _LOW, np.int64)
        self.id, self.known = np.zeros((n, k), np.int64), np.zeros((n, k), np.int8)
        self.filled = np.zeros(n, np.int64)

    def worst(self) -> np.ndarray:
        """Score that a slot's next one has to reach; the lowest number while there is room."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, id: np.ndarray, known: np.ndarray) -> None:
        if not len(slot):
            return
        touched, at = np.unique(slot, return_inverse=True)
        old = np.repeat(np.arange(len(touched)), self.k)
        inside = (np.arange(self.k)[None] < self.filled[touched][:, None]).ravel()
        slots = np.concatenate([old[inside], at])
        scores = np.concatenate([self.score[touched].ravel()[inside], score])
        ids = np.concatenate([self.id[touched].ravel()[inside], id])
        flags = np.concatenate([self.known[touched].ravel()[inside], known])
        order = np.lexsort((ids, flags, -scores, slots))
        slots = slots[order]
        begin = np.searchsorted(slots, np.arange(len(touched)))
        place = np.arange(len(slots)) - begin[slots]
        stay = place < self.k
        order, slots, place = order[stay], slots[stay], place[stay]
        row = touched[slots]
        self.score[row, place], self.id[row, place], self.known[row, place] = scores[order], ids[order], flags[order]
        self.filled[touched] = np.bincount(slots, minlength=len(touched))


def _scores(a: np.ndarray, v: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices; ``bound`` is
    at least the largest of them."""
    if bound < _EXACT:
        return (a @ v.T).astype(np.int64)
    return (a.astype(np.int64).astype(object) @ v.astype(np.int64).astype(object).T).astype(np.int64)


def _reach(angles_a: np.ndarray, angles_v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest angle that each (anchor, row) pair can have."""
    low = np.zeros((len(angles_a), len(angles_v)), np.float32)
    high = np.full_like(low, np.pi)
    for j in range(angles_a.shape[1]):
        a, v = angles_a[:, j, None], np.ascontiguousarray(angles_v[:, j])[None]
        np.maximum(low, np.abs(a - v), out=low)
        total = a + v
        np.minimum(high, np.minimum(total, np.float32(2 * np.pi) - total), out=high)
    return low, high


def _limit(score: np.ndarray, norms_a: np.ndarray, n: float) -> np.ndarray:
    """The angle at which vectors of these norms have this score."""
    size = norms_a * n
    ratio = np.divide(score, size, out=np.where(score > 0, 2.0, -2.0), where=size > 0)
    return np.arccos(np.clip(ratio, -1.0, 1.0))


def _overlap(low: np.ndarray, high: np.ndarray, norms_a: np.ndarray, norms_v: np.ndarray,
             least: np.ndarray, most: np.ndarray | None) -> np.ndarray:
    """Which pairs can have a score from ``least`` to ``most``, an anchor's
    window. Half a unit is spared for rounding: scores are whole numbers."""
    need, small, large = least.astype(float) - 0.5, float(norms_v.min()), float(norms_v.max())
    # a positive score needs the largest norm at most, a negative one the smallest
    widest = np.maximum(_limit(need, norms_a, large), _limit(need, norms_a, small))
    inside = low <= (widest + SLACK)[:, None]
    if most is not None:
        allowed = most.astype(float) + 0.5
        inside &= high >= (np.minimum(_limit(allowed, norms_a, large), _limit(allowed, norms_a, small)) - SLACK)[:, None]
    return inside


class Anchors:
    """A block of anchors of one dimension, in order of label."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r.label)
        self.row = np.array([r.row for r in rows], np.int64)
        self.v = np.array([r.v for r in rows], np.float64).reshape(len(rows), -1)
        self.norms = np.array([r.norm for r in rows], float)
        self.angles = np.array([r.angles for r in rows], np.float32).reshape(len(rows), -1)
        self.labels, self.code = np.unique(np.array([r.label for r in rows], object), return_inverse=True)
        self.at = np.searchsorted(self.code, np.arange(len(self.labels) + 1))

    def __len__(self) -> int:
        return len(self.row)


class Rows:
    """Rows of one dimension of a batch, in order of label and norm."""

    def __init__(self, batch: pa.RecordBatch, labels: np.ndarray):
        place = {label: i for i, label in enumerate(labels)}
        code = np.array([place.get(label, -1) for label in batch.column("label").to_pylist()], np.int64)
        norms = np.asarray(batch.column("norm"))
        order = np.lexsort((norms, code))
        batch, self.code, self.norms = batch.take(pa.array(order)), code[order], norms[order]
        self.v, self.angles = _matrix(batch.column("v")), _matrix(batch.column("angles"), np.float32)
        ids = batch.column("id")
        self.row, self.known = np.asarray(batch.column("row")), np.asarray(ids.is_valid()).astype(np.int8)
        self.id = np.asarray(ids.fill_null(0))

    def pieces(self, one_label: bool) -> Iterator[slice]:
        cuts = np.flatnonzero(np.diff(self.code)) + 1 if one_label else np.zeros(0, int)
        for begin, end in zip([0, *cuts], [*cuts, len(self.code)]):
            for at in range(begin, end, ROWS):
                yield slice(at, min(at + ROWS, end))


def _batches(batches: Iterator[pa.RecordBatch], anchors: dict[int, Anchors]) -> Iterator[tuple[Anchors, Rows]]:
    for batch in batches:
        size = np.asarray(batch.column("v").value_lengths())
        for dim in np.unique(size):
            if int(dim) in anchors:
                own = anchors[int(dim)]
                yield own, Rows(batch.filter(pa.array(size == dim)), own.labels)


def _candidates(a: Anchors, part: slice, rows: Rows, piece: slice, least: np.ndarray, most: np.ndarray | None
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose bounds overlap the anchors' windows, with
    their scores. Where most pairs of the piece do, one product of matrices is
    cheaper than many of vectors; the others' scores are not looked at."""
    low, high = _reach(a.angles[part], rows.angles[piece])
    inside = _overlap(low, high, a.norms[part], rows.norms[piece], least, most)
    x, y = np.nonzero(inside)
    if not len(x):
        return x, y, np.zeros(0, np.int64)
    bound = float(a.norms[part].max() * rows.norms[piece].max()) * 1.01
    if 8 * len(x) > inside.size or bound >= _EXACT:
        return x, y, _scores(a.v[part], rows.v[piece], bound)[x, y]
    return x, y, np.einsum("ij,ij->i", a.v[part][x], rows.v[piece][y]).astype(np.int64)


def _best_only(slot: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Drops what is surely not among its slot's first k; ties stay."""
    order = np.lexsort((-score, slot))
    s = slot[order]
    place = np.arange(len(s)) - np.searchsorted(s, s)
    kth = np.full(int(s.max()) + 1 if len(s) else 0, _LOW, np.int64)
    kth[s[place == k - 1]] = score[order][place == k - 1]
    return score >= kth[slot]


def _step(n_rows: int) -> int:
    return max(1, PAIRS // max(1, n_rows))


def _positives(anchors: dict[int, Anchors], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(a), k) for dim, a in anchors.items()}
        for a, rows in _batches(batches, anchors):
            mine = best[a.v.shape[1]]
            for piece in rows.pieces(one_label=True):
                code = rows.code[piece.start]
                if code < 0:
                    continue
                step = _step(piece.stop - piece.start)
                for at in range(a.at[code], a.at[code + 1], step):
                    part = slice(at, min(at + step, a.at[code + 1]))
                    x, y, score = _candidates(a, part, rows, piece, mine.worst()[part], None)
                    y += piece.start
                    x += at
                    stay = (score >= mine.worst()[x]) & (rows.row[y] != a.row[x])
                    x, y, score = x[stay], y[stay], score[stay]
                    stay = _best_only(x, score, k)
                    x, y = x[stay], y[stay]
                    mine.add(x, score[stay], rows.id[y], rows.known[y])
        for dim, a in anchors.items():
            yield from _emit(best[dim], a.row, np.zeros(len(a), np.int32))

    return run


def _emit(best: Best, anchor: np.ndarray, positive: np.ndarray) -> Iterator[pa.RecordBatch]:
    slot, place = np.nonzero(np.arange(best.k)[None] < best.filled[:, None])
    if len(slot):
        ids = pa.array(best.id[slot, place], pa.int64(), mask=best.known[slot, place] == 0)
        yield pa.RecordBatch.from_arrays([pa.array(anchor[slot]), pa.array(positive[slot], pa.int32()), ids, pa.array(best.score[slot, place])],
                                         ["anchor", "positive", "id", "score"])


class Windows:
    """For the anchors of a block the window of scores of each positive."""

    def __init__(self, a: Anchors, found: list, low: tuple[int, int], high: tuple[int, int]):
        own = {int(r): i for i, r in enumerate(a.row)}
        # whole scores s with low * p <= s <= high * p, in integers
        rows = [(own[r.anchor], r.rank, -(-low[0] * r.score // low[1]), high[0] * r.score // high[1]) for r in found if r.anchor in own]
        rows = sorted(r for r in rows if r[2] <= r[3])
        self.anchor, self.positive, self.low, self.high = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        self.at = np.searchsorted(self.anchor, np.arange(len(a) + 1))


def _negatives(anchors: dict[int, Anchors], windows: dict[int, Windows], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(w.anchor), k) for dim, w in windows.items()}
        for a, rows in _batches(batches, anchors):
            w, mine = windows[a.v.shape[1]], best[a.v.shape[1]]
            for piece in rows.pieces(one_label=False):
                step = _step(piece.stop - piece.start)
                for at in range(0, len(a), step):
                    part = slice(at, min(at + step, len(a)))
                    slots = np.arange(w.at[part.start], w.at[part.stop])
                    if not len(slots):
                        continue
                    # the anchor's window: from the least score that still counts to the largest
                    least, most = np.full(part.stop - at, -_LOW - 1, np.int64), np.full(part.stop - at, _LOW, np.int64)
                    np.minimum.at(least, w.anchor[slots] - at, np.maximum(w.low, mine.worst())[slots])
                    np.maximum.at(most, w.anchor[slots] - at, w.high[slots])
                    x, y, score = _candidates(a, part, rows, piece, least, most)
                    y += piece.start
                    x += at
                    stay = (rows.code[y] != a.code[x]) & (score >= least[x - at]) & (score <= most[x - at])
                    x, y, score = x[stay], y[stay], score[stay]
                    # a pair for every window of its anchor
                    n = w.at[x + 1] - w.at[x]
                    pair = np.repeat(np.arange(len(x)), n)
                    slot = w.at[x][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
                    stay = (score[pair] >= np.maximum(w.low, mine.worst())[slot]) & (score[pair] <= w.high[slot])
                    pair, slot = pair[stay], slot[stay]
                    stay = _best_only(slot, score[pair], k)
                    pair, slot = pair[stay], slot[stay]
                    mine.add(slot, score[pair], rows.id[y[pair]], rows.known[y[pair]])
        for dim, w in windows.items():
            yield from _emit(best[dim], anchors[dim].row[w.anchor], w.positive)

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


_FOUND = "anchor bigint, positive int, id bigint, score bigint"


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100),
                   high: tuple[int, int] = (95, 100), scale: int = SCALE, references: int = REFERENCES) -> DataFrame:
    """For each anchor (a row of (id, vector, label) that ``is_anchor`` holds
    for) and each of its first ``positives`` other rows of the same label, the
    first ``negatives`` rows of another label whose score lies from ``low`` to
    ``high`` of the positive's (fractions): anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, and ``positive``, the
    positive's number from 1.

    A score is the inner product of the vectors' components times ``scale``,
    rounded down; higher scores come first, equal ones by id (null first).
    Rows with a null label or vector or a component that is null or not finite
    take no part. A null id is no anchor under a condition on ids, but can be
    a positive or negative. Rows repeated as a whole are rows of their own: a
    copy of the anchor is its positive, and each copy of an anchor returns the
    same rows. Only vectors of equal length are compared; an empty or zero
    vector scores 0. A positive without rows in its window, an anchor without
    positives and an empty table give no rows. Other columns are ignored.
    Components beyond 2^53 after scaling, and scores beyond 64 bits, raise an
    error.
    """
    spark = rows.sparkSession
    ready = _prepared(rows.select(F.col("id").cast("bigint").alias("id"), "vector", "label",
                                  F.coalesce(is_anchor, F.lit(False)).alias("anchor")), scale, references)
    # equal anchors are searched once
    alike = stored(ready.where("anchor").groupBy("id", "label", "v").agg(
        F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("norm").alias("norm"), F.first("angles").alias("angles")), "anchors")
    size = alike.agg(F.sum(8 * F.size("v") + 4 * F.size("angles") + 64).alias("bytes")).first()
    blocks = max(1, -(-(size.bytes or 0) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks))
    firsts, seconds = run_folder(spark, "positives"), run_folder(spark, "negatives")
    kind = f"{_FOUND}, rank int"
    for b in range(blocks):
        block_rows = alike.where(block == b).collect()
        by_dim = {dim: Anchors([r for r in block_rows if len(r.v) == dim]) for dim in {len(r.v) for r in block_rows}}
        shared = spark.sparkContext.broadcast(by_dim)
        _first(ready.mapInArrow(_on(shared, _positives, positives), _FOUND), positives).write.parquet(f"{firsts}/block={b}")
        found = spark.read.schema(kind).parquet(f"{firsts}/block={b}").collect()   # a few rows an anchor of this block
        spans = spark.sparkContext.broadcast({dim: Windows(a, found, low, high) for dim, a in by_dim.items()})
        _first(ready.mapInArrow(_on(shared, _negatives, negatives, spans), _FOUND), negatives).write.parquet(f"{seconds}/block={b}")
        shared.unpersist()
        spans.unpersist()
    first = spark.read.schema(f"{kind}, block int").parquet(firsts).select(
        "block", "anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    second = spark.read.schema(f"{kind}, block int").parquet(seconds).select(
        "block", "anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = second.join(first, ["block", "anchor", "positive"]).join(
        alike.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "copies"), "anchor")
    every = named.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return every.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive")


def _on(shared, work, k: int, spans=None):
    """The task function for a broadcast block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        args = (shared.value, k) if spans is None else (shared.value, spans.value, k)
        yield from work(*args)(batches)

    return run


HARD_NEGATIVES_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CASE WHEN len(a.v) = 0 THEN 0 ELSE CAST(list_inner_product(a.v, b.v) AS BIGINT) END AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
positives AS (
  SELECT * FROM (SELECT a, anchor_id, other_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id NULLS FIRST) AS positive FROM pairs WHERE same) p WHERE positive <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score, CAST(positive AS INT) AS positive
FROM (SELECT p.anchor_id, p.positive_id, p.positive, p.positive_score, n.other_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.positive ORDER BY n.score DESC, n.other_id NULLS FIRST) AS rank
  FROM positives p JOIN pairs n ON p.a = n.a AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score) t
WHERE rank <= 3"""
