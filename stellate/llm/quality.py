"""Quality classifier: random-indexing word vectors, pooled, two layers.

Every word has a fixed sparse random index vector; its word vector is the sum
of the index vectors of its neighbours over the whole corpus. Words are
hashed into ``WORDS`` buckets, so the vectors are a table of fixed size,
summed per task and then in two steps, and small enough to broadcast whatever
the corpus. A document is pooled to the mean and the spread of its words'
vectors and the mean likeness of neighbouring words. A network of two layers in numpy is trained on a bounded sample of
labelled documents; a temperature fitted on rows kept from the training
calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from .common import byte_runs, partitions, run_hashes, stored, text_slices, unused_name, utf8

WORDS = 8192            # buckets of words, a power of two
SIZE = 48               # length of a vector
WIDTH = 2 * SIZE + 1     # of a pooled document
NONZERO = 4             # entries of an index vector that are not zero
REACH = 2               # neighbours on each side
SAMPLE = 20_000         # labelled documents that are trained on at most
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3
_PARTS = 16             # the table of sums travels in so many pieces

_KIND = np.full(256, 2, np.uint8)   # 0 white space, 1 word, 2 signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x30:0x3A] = _KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, SIZE, (WORDS, NONZERO)), rng.choice([-1.0, 1.0], (WORDS, NONZERO))


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words (letter case counts; runs of signs are words) of
    the batch's texts, and the first word of each text."""
    data, cuts = utf8(batch)
    begin, end = byte_runs(_KIND[data], cuts)
    return (run_hashes(data, begin, end) % np.uint64(WORDS)).astype(np.int64), np.searchsorted(begin, cuts)


def add_contexts(table: np.ndarray, words: np.ndarray, first: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each word's sums the index vectors of its neighbours."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for distance in range(1, REACH + 1):
        near = text[distance:] == text[:-distance]
        left, right = words[:-distance][near], words[distance:][near]
        for word, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                table += np.bincount(word * SIZE + places[other, k], signs[other, k], len(table))


PIECE = "part int, salt int, sums binary"


def _piece(part: int, salt: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([salt], pa.int32()),
                                       pa.array([sums.tobytes()], pa.binary())], names=["part", "salt", "sums"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    table, seen = np.zeros(WORDS * SIZE), 0
    for batch in batches:
        for part in text_slices(batch):
            words, first = words_of(part)
            add_contexts(table, words, first, places, signs)
            seen += len(words)
    if seen:
        for i, sums in enumerate(np.split(table.astype(np.float32), _PARTS)):
            yield _piece(i, seen % 64, sums)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of each piece over the rows of one partition, one row at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("sums")):
            own = np.frombuffer(raw.as_buffer(), np.float32)
            sums[part] = sums[part] + own if part in sums else own.astype(np.float64)
    for part, own in sums.items():
        yield _piece(part, 0, own.astype(np.float32))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of unit word vectors, from all words of all texts. What
    reaches the driver has a fixed size (1.5 MB)."""
    pieces = docs.select("text").mapInArrow(_contexts, PIECE)
    some = pieces.repartition(partitions(docs.sparkSession), "part", "salt").mapInArrow(_summed, PIECE)
    table = np.zeros((_PARTS, WORDS * SIZE // _PARTS), np.float32)
    for row in some.repartition(_PARTS, "part").mapInArrow(_summed, PIECE).collect():
        table[row.part] += np.frombuffer(row.sums, np.float32)
    table = table.reshape(WORDS, SIZE)
    table = table - table.sum(0) / max(1, np.count_nonzero(table.any(1)))
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(words: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text, and the mean cosine
    of neighbours; zero without words."""
    out = np.zeros((len(first) - 1, WIDTH))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for at in range(0, len(words), 1 << 17):
        own, of = vectors[words[at:at + (1 << 17)]], text[at:at + (1 << 17)]
        new = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        out[of[new], :SIZE] += np.add.reduceat(own, new, axis=0)
        out[of[new], SIZE:-1] += np.add.reduceat(own * own, new, axis=0)
        near = np.flatnonzero(text[at + 1:at + len(own) + 1] == of[:len(text) - at - 1])
        likeness = np.einsum("ij,ij->i", own[near], vectors[words[at + near + 1]])
        out[:, -1] += np.bincount(of[near], likeness, len(out))
    out /= np.maximum(1, np.diff(first))[:, None]
    out[:, SIZE:-1] = np.sqrt(np.maximum(0, out[:, SIZE:-1] - out[:, :SIZE] ** 2))
    return out


def _with_features(docs: DataFrame, vectors: np.ndarray, score=None, name: str = "score") -> DataFrame:
    """``docs`` with the pooled vector, or the score of it, as a new column.
    The table is broadcast: its size is fixed."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors.astype(np.float32), score))
    made_type = ArrayType(FloatType()) if score is None else DoubleType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = shared.value
        for batch in batches:
            for part in text_slices(batch):
                features = pooled(*words_of(part), table)
                made = (pa.array(list(features.astype(np.float32)), pa.list_(pa.float32())) if model is None
                        else pa.array(model.score(features), pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, made_type)]))


@dataclass
class Network:
    """score(x) = sigmoid((tanh(x A + a) B + b) / temperature) on scaled x."""

    center: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, bias, b, shift = self.weights
        return np.tanh((x - self.center) / self.scale @ a + bias) @ b + shift

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _constant(rate: float) -> Network:
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    return Network(np.zeros(WIDTH), np.ones(WIDTH),
                   (np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), np.log(rate / (1 - rate))), 1.0)


def train(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Adam on the cross entropy of four fifths of the rows, then the
    temperature of least cross entropy on the rest. Without rows of both
    labels the score is the share of label 1 (a half without any rows)."""
    if len(y) < 10 or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside, used = order[:len(y) // 5], order[len(y) // 5:]
    center, scale = x[used].mean(0), x[used].std(0) + 1e-6
    z, target = (x[used] - center) / scale, y[used].astype(np.float64)
    width = x.shape[1]
    weights = [rng.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        turn = rng.permutation(len(target))
        for at in range(0, len(turn), 256):
            rows = turn[at:at + 256]
            hidden = np.tanh(z[rows] @ weights[0] + weights[1])
            off = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30))) - target[rows]) / len(rows)
            back = np.outer(off, weights[2]) * (1 - hidden ** 2)
            slopes = [z[rows].T @ back + 1e-4 * weights[0], back.sum(0), hidden.T @ off + 1e-4 * weights[2], off.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope ** 2
                weights[i] = weights[i] - 0.003 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    model = Network(center, scale, tuple(weights), 1.0)
    logits, target = model.logits(x[aside]), y[aside]

    def loss(t: float) -> float:
        return float(np.logaddexp(0, np.where(target == 1, -1, 1) * logits / t).mean())

    model.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))
    return model


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts, and the network trained on at most
    ``sample`` labelled documents that are not held out (those of smallest
    hash of their id; of an id labelled twice the lower label, of an id with
    several texts the one of smaller features)."""
    vectors = word_vectors(docs)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    # at most `sample` rows of 16 bytes: small enough to broadcast
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # one row an id, so that no more than the sample reaches the driver
    rows = (_with_features(own, vectors, None, "features").groupBy("doc_id")
            .agg(F.min("label").alias("label"), F.min("features").alias("features")).orderBy("doc_id").collect())
    x = np.array([r.features for r in rows], np.float64).reshape(-1, WIDTH)
    return vectors, train(x, np.array([r.label for r in rows]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per document: whether it was held out, its score and the label that
    the threshold gives. Null and empty texts get the score of a text without
    words; repeated rows are scored each; a null doc_id is scored and never
    trained on; other columns are no inputs; an empty table gives no rows."""
    vectors, model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _with_features(rows, vectors, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score the threshold
    or more."""
    vectors, model = fit(docs, labels, sample)
    name = unused_name(docs, "score")
    return _with_features(docs, vectors, model, name).where(F.col(name) >= threshold).drop(name)
