"""Token counts by source, language and tokenizer version, kept by deltas.

A change is a signed row: +1 with a document's counts enters it, -1 with the
counts it was entered with takes it out, a revision is both. A batch of
changes is summed (partial aggregation) to one delta row a group and written
to a folder of its own; the batch counts from the moment its id is appended to
the commit table. Of several commits of one id the reader takes one, so a
batch that is sent again, or committed by two drivers, changes nothing, and
folders that were never committed are not read. Totals are the sum of the
committed deltas; ``compact`` folds them into one folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_folder, stored, text_list, text_slices, utf8
from .token_files import LibraryEncoder

GROUP = ["source", "lang", "tokenizer_version"]
TOTALS = ["n_docs", "n_tokens", "n_bytes"]
DELTA = "source string, lang string, tokenizer_version string, n_docs bigint, n_tokens bigint, n_bytes bigint"
COMMIT = "batch_id string, generation bigint, folder string"


class Rollup:
    """The rollup below ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> dict[str, tuple[int, str]]:
        """Of each committed batch the newest generation, and of its commits
        the first folder by name. One row a batch."""
        try:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        best: dict[str, tuple[int, str]] = {}
        for r in rows.collect():
            had = best.get(r.batch_id)
            if had is None or (-r.generation, r.folder) < (-had[0], had[1]):
                best[r.batch_id] = r.generation, r.folder
        return best

    def _commit(self, rows: list[tuple[str, int, str]]) -> None:
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def _write(self, deltas: DataFrame) -> str:
        folder = f"deltas-{uuid.uuid4().hex}"
        deltas.write.parquet(f"{self.root}/{folder}")
        return folder

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch of signed rows (sign, the group's columns, n_tokens,
        n_bytes). False, and nothing done, if its id is committed already."""
        if batch_id in self._commits():
            return False
        sign = F.col("sign")
        deltas = changes.groupBy(*GROUP).agg(
            F.sum(sign).cast("bigint").alias("n_docs"), F.sum(sign * F.col("n_tokens")).cast("bigint").alias("n_tokens"),
            F.sum(sign * F.col("n_bytes")).cast("bigint").alias("n_bytes"))
        changed = deltas.where(" or ".join(f"{c} <> 0" for c in TOTALS)).select(*GROUP, *TOTALS)
        self._commit([(batch_id, 0, self._write(changed))])
        return True

    def totals(self) -> DataFrame:
        """Totals of the groups that have documents, as committed by now."""
        folders = sorted({folder for _, folder in self._commits().values()})
        if not folders:
            return self.spark.createDataFrame([], DELTA)
        deltas = self.spark.read.schema(DELTA).parquet(*(f"{self.root}/{f}" for f in folders))
        sums = deltas.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in TOTALS))
        return sums.where(" or ".join(f"{c} <> 0" for c in TOTALS))

    def compact(self) -> None:
        """Fold all committed deltas into one folder, in the name of all their
        batches and of a higher generation. Two that run at once may fold
        different batches; run one at a time."""
        commits = self._commits()
        if len({folder for _, folder in commits.values()}) > 1:
            folder = self._write(self.totals())
            above = 1 + max(generation for generation, _ in commits.values())
            self._commit([(batch, above, folder) for batch in commits])


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*GROUP, "n_tokens", "n_bytes", F.lit(sign).alias("sign"))


COUNTS = ("doc_id bigint, source string, lang string, tokenizer_version string, n_tokens bigint, "
          "n_bytes bigint, text_hash1 bigint, text_hash2 bigint")
_loaded: dict[str, object] = {}


def _counter(path: str):
    """A function from texts to numbers of ids; special tokens' strings count
    as ordinary text for rank files, as the library does for JSON files."""
    if path not in _loaded:
        if path.endswith(".tiktoken"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            _loaded[path] = lambda texts: [len(model.encode_ordinary(t)) for t in texts]
        else:
            encoder = LibraryEncoder(path)
            width = np.dtype(encoder.kind).itemsize
            _loaded[path] = lambda texts: [len(i) // width for i in encoder.encode(texts)]
    return _loaded[path]


def count_tokens(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """A row for each document and tokenizer version (name: path of its
    file): tokens, UTF-8 bytes and a 128-bit hash of the text. A narrow pass
    over whole texts. A null text has no tokens and no bytes."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("text_hash1"),
                       F.xxhash64(F.lit(1), "text").alias("text_hash2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts, n_bytes = text_list(part), pa.array(np.diff(utf8(part)[1]), pa.int64())
                for name, path in tokenizers.items():
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("doc_id", "source", "lang")), pa.array([name] * len(texts), pa.string()),
                         pa.array(_counter(path)(texts), pa.int64()), n_bytes, part.column("text_hash1"), part.column("text_hash2")],
                        names=[c.split()[0] for c in COUNTS.split(", ")])

    return rows.mapInArrow(run, COUNTS)


def without_copies(counts: DataFrame) -> DataFrame:
    """Signed rows that take out every later copy of a text: all rows leave
    and the one of the smallest doc_id of each text (null last) comes back.
    The first is an aggregate, so a text of very many copies is no hot key."""
    first = (counts.groupBy("tokenizer_version", "text_hash1", "text_hash2")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang", "n_tokens", "n_bytes")).alias("f"))
             .select("f.source", "f.lang", "tokenizer_version", "f.n_tokens", "f.n_bytes"))
    return signed(counts, -1).unionByName(signed(first, 1))


def _entered(docs: DataFrame, tokenizers: dict[str, str], root: str | None, bytes_a_token: int) -> tuple[Rollup, DataFrame, DataFrame]:
    """A rollup that all documents have entered on arrival with an estimate
    from their size, which exact counts revised; the counts, the revision."""
    spark = docs.sparkSession
    rollup = Rollup(spark, root or run_folder(spark, "rollup"))
    counts = stored(count_tokens(docs, tokenizers), "counts")
    estimate = counts.withColumn("n_tokens", F.ceil(F.col("n_bytes") / bytes_a_token))
    revision = signed(estimate, -1).unionByName(signed(counts, 1))
    rollup.apply("arrival", signed(estimate, 1))
    rollup.apply("exact counts", revision)
    return rollup, counts, revision


def _copies_left(rollup: Rollup, counts: DataFrame, revision: DataFrame) -> DataFrame:
    """Totals after later copies of a text were deleted and the revision was
    sent once more, which changes nothing."""
    rollup.apply("later copies", without_copies(counts))
    rollup.compact()
    rollup.apply("exact counts", revision)
    return rollup.totals()


def token_totals(docs: DataFrame, tokenizers: dict[str, str], root: str | None = None, bytes_a_token: int = 4) -> DataFrame:
    """Totals of the distinct texts of a corpus, each counted with its row of
    smallest doc_id, after four commits: arrival, exact counts, later copies,
    and the exact counts again.

    A null source or language is a group of its own; rows of a repeated
    doc_id count each unless their texts are equal; an empty table gives no
    rows; other columns are ignored.
    """
    return _copies_left(*_entered(docs, tokenizers, root, bytes_a_token))


def corpus_totals(docs: DataFrame, tokenizers: dict[str, str], root: str | None = None, bytes_a_token: int = 4) -> DataFrame:
    """n_docs, n_tokens and n_bytes of all documents, copies and null texts
    included, and as distinct_docs, distinct_tokens and distinct_bytes what
    ``token_totals`` gives: 0 in a group that holds later copies only."""
    rollup, counts, revision = _entered(docs, tokenizers, root, bytes_a_token)
    every = stored(rollup.totals(), "totals")   # a few rows, before copies leave
    own = [c.replace("n_", "distinct_") for c in TOTALS]
    distinct = _copies_left(rollup, counts, revision).select(
        *(F.col(c).alias(f"of_{c}") for c in GROUP), *(F.col(c).alias(o) for c, o in zip(TOTALS, own)))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in GROUP]
    return every.join(distinct, same, "left").select(*GROUP, *TOTALS, *(F.coalesce(c, F.lit(0)).alias(c) for c in own))
