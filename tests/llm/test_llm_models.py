"""Token rollup, quality classifier, the pipeline and the registered queries."""

import random
import subprocess
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import (AWKWARD, SCHEMA, benchmark_words, components, contamination, deleted_lines, frame, line_report, order,
                   rows, sha, simhash, text_hash)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMOKE
from stellate.llm import quality, token_rollup
from stellate.llm.common import package_on_workers, range_bounds, range_bucket, unused_name
from stellate.llm.queries import ORACLES, QUERIES

PATHS = {"word": public_tokenizers.path("word_bpe_49k.json"), "byte": public_tokenizers.path("byte_bpe_50k.tiktoken")}


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    package_on_workers(spark)


# 8 ---------------------------------------------------------------------------
def plain_totals(table):
    """Counts of each text's first row; ties and nulls as the operator has them."""
    library = {"word": Tokenizer.from_file(PATHS["word"]),
               "byte": Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))}
    library["byte"].encode_special_tokens = True
    first = {}
    for d, t, lang, source, _ in table:
        key = (d is None, d or 0, source is not None, source or "", lang is not None, lang or "")
        if t not in first or key < first[t][0]:
            first[t] = key, source, lang
    out = defaultdict(lambda: [0, 0, 0])
    for t, (_, source, lang) in first.items():
        for name, model in library.items():
            v = out[source, lang, name]
            v[0] += 1
            v[1] += len(model.encode(t or "", add_special_tokens=False).ids)
            v[2] += len((t or "").encode())
    return {k: tuple(v) for k, v in out.items()}


def totals(df):
    return {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens, r.n_bytes) for r in df.collect()}


def test_token_totals(spark):
    docs = frame(spark).withColumn("sign", F.lit(7)).withColumn("n_tokens", F.lit(7))
    assert totals(token_rollup.token_totals(docs, PATHS)) == plain_totals(rows())
    assert token_rollup.token_totals(spark.createDataFrame([], SCHEMA), PATHS).collect() == []


def test_corpus_totals_count_every_document(spark):
    """Copies count in their own source; a group of copies only is there."""
    table = [*rows(), (30, None, "en", "s", 0), (31, "x", "en", "copies", 1), (32, "x", "en", "copies", 1), (None, "x", None, None, 1)]
    df = token_rollup.corpus_totals(spark.createDataFrame(table, SCHEMA).repartition(3), PATHS)
    found = df.collect()
    library = {"word": Tokenizer.from_file(PATHS["word"]), "byte": Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))}
    library["byte"].encode_special_tokens = True
    want = defaultdict(lambda: [0, 0, 0])
    for _, t, lang, source, _ in table:
        for name, model in library.items():
            v = want[source, lang, name]
            v[0], v[1] = v[0] + 1, v[1] + len(model.encode(t or "", add_special_tokens=False).ids)
            v[2] += len((t or "").encode())
    group = lambda r: (r.source, r.lang, r.tokenizer_version)
    assert {group(r): [r.n_docs, r.n_tokens, r.n_bytes] for r in found} == want and len(found) == len(want)
    assert {group(r): (r.distinct_docs, r.distinct_tokens, r.distinct_bytes) for r in found if r.distinct_docs} == plain_totals(table)
    assert ("copies", "en", "word") in {group(r) for r in found if not r.distinct_docs}
    assert token_rollup.corpus_totals(spark.createDataFrame([], SCHEMA), PATHS).collect() == []


def test_registered_rollup_counts_all_rows(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").union(spark.read.parquet(f"{SF_SMOKE}/documents.parquet"))
    import tempfile
    folder = tempfile.mkdtemp(prefix="stellate-test-twice-")
    docs.write.parquet(f"{folder}/documents.parquet")
    sums = QUERIES["op8_token_rollup"](spark, folder).groupBy("tokenizer_version").agg(F.sum("n_docs").alias("n")).collect()
    assert len(sums) == 2 and {r.n for r in sums} == {docs.count()}


def changes(spark, *table):
    return spark.createDataFrame(table, "sign int, source string, lang string, tokenizer_version string, n_tokens bigint, n_bytes bigint")


def test_batches_count_once(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/rollup")
    assert totals(rollup.totals()) == {}
    a = changes(spark, (1, "s", "en", "v1", 10, 40), (1, None, "en", "v1", 5, 20), (1, "t", "en", "v1", 2, 8))
    assert rollup.apply("a", a) and not rollup.apply("a", a)
    assert rollup.apply("b", changes(spark, (-1, "s", "en", "v1", 10, 40), (1, "s", "en", "v1", 12, 40), (-1, "t", "en", "v1", 2, 8)))
    want = {("s", "en", "v1"): (1, 12, 40), (None, "en", "v1"): (1, 5, 20)}
    assert totals(rollup.totals()) == want   # groups without documents go
    rollup.compact()
    assert totals(rollup.totals()) == want and not rollup.apply("b", a)
    assert rollup.apply("c", changes(spark, (1, "s", "en", "v1", 1, 1)))
    rollup.compact()
    assert totals(rollup.totals())["s", "en", "v1"] == (2, 13, 41)
    assert totals(token_rollup.Rollup(spark, f"file://{tmp_path}/rollup").totals())["s", "en", "v1"] == (2, 13, 41)


def test_a_batch_committed_by_two_drivers_counts_once(spark, tmp_path):
    one, two = (token_rollup.Rollup(spark, f"file://{tmp_path}/rollup") for _ in range(2))
    a = changes(spark, (1, "s", "en", "v1", 10, 40))
    two._commits = dict   # the second does not see the first's commit
    assert one.apply("a", a) and two.apply("a", a)
    assert totals(one.totals()) == {("s", "en", "v1"): (1, 10, 40)}


def test_a_folder_without_commit_is_not_read(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/rollup")
    rollup.apply("a", changes(spark, (1, "s", "en", "v1", 10, 40)))
    rollup._write(rollup.totals())   # a driver that died before the commit
    assert totals(rollup.totals()) == {("s", "en", "v1"): (1, 10, 40)}


# 9 ---------------------------------------------------------------------------
def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    found = scored.join(labels, "doc_id").collect()
    out = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in found if r.held_out} == {r.doc_id for r in out}
    assert sum(r.predicted == r.quality for r in out) / len(out) >= 0.95
    good = [r for r in out if r.quality == 1]
    assert sum(r.predicted for r in good) / len(good) >= 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_quality_awkward(spark):
    labels = spark.createDataFrame([(d, i % 2) for i, d in enumerate(range(5, 20))] + [(None, 1), (8, None), (9, 0)], "doc_id bigint, quality int")
    docs = frame(spark).withColumn("score", F.lit(7)).withColumn("features", F.lit(7)).withColumn("label", F.lit(7))
    scored = quality.score_documents(docs, labels).collect()
    assert sorted((order(r.doc_id) for r in scored)) == sorted(order(d) for d, _ in AWKWARD)
    assert all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 2)}) == 1
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(order(r.doc_id) for r in kept.collect()) == sorted(order(r.doc_id) for r in scored if r.predicted)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.score_documents(docs, none).collect()} == {0.5}
    assert quality.score_documents(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_word_vectors_count_neighbours(spark):
    """The table's sums are those of a plain loop over neighbours."""
    places, signs = quality.index_vectors()
    rng = random.Random(1)
    words, first = np.array([rng.randrange(5) for _ in range(40)]), np.array([0, 0, 15, 16, 40])
    table = np.zeros(quality.WORDS * quality.SIZE)
    quality.add_contexts(table, words, first, places, signs)
    want = np.zeros((quality.WORDS, quality.SIZE))
    for a, b in zip(first, first[1:]):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                if i != j:
                    np.add.at(want[words[i]], places[words[j]], signs[words[j]])
    assert np.allclose(table.reshape(want.shape), want)


def test_pooled_is_by_text():
    vectors = np.random.default_rng(1).normal(size=(quality.WORDS, quality.SIZE)).astype(np.float32)
    words, first = np.arange(30) % 7, np.array([0, 10, 10, 30])
    out = quality.pooled(words, first, vectors)
    own = vectors[words[10:]].astype(float)
    assert np.allclose(out[2, :quality.SIZE], own.mean(0), atol=1e-5) and np.allclose(out[2, quality.SIZE:-1], own.std(0), atol=1e-3)
    assert np.isclose(out[2, -1], (own[1:] * own[:-1]).sum() / 20, atol=1e-4) and not out[1].any()


def test_calibrated_network():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, quality.WIDTH))
    y = (rng.random(4000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(float)
    model = quality.train(x[:3000], y[:3000])
    score = model.score(x[3000:])
    assert abs(score.mean() - y[3000:].mean()) < 0.05
    for low in (0, 0.25, 0.5, 0.75):
        own = (score >= low) & (score < low + 0.25)
        assert abs(score[own].mean() - y[3000:][own].mean()) < 0.15


# ranges -----------------------------------------------------------------------
def test_range_buckets(spark):
    ids = [None, -5, 0, 3, 3, 3, 9, 10, 11, 1 << 60]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint")
    bounds, low, nulls = range_bounds(df, "k", 4)
    assert low == -5 and nulls and bounds == sorted(set(bounds)) and set(bounds) <= set(ids)
    for r in df.withColumn("b", range_bucket("k", bounds)).collect():
        assert r.b == (0 if r.k is None else sum(b <= r.k for b in bounds))
    assert range_bounds(df.limit(0), "k", 4) == ([], None, False)


def test_unused_name(spark):
    assert unused_name(spark.createDataFrame([], "A int, a_ int"), "a") == "a__"


# pipeline and queries -----------------------------------------------------------
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    schema, state = docs.schema, docs.withColumn("hits", F.lit(1))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near copies", "benchmark", "tokens"]
    table = [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, SF_SMOKE)
        if name == "quality":
            kept = {r.doc_id for r in quality.score_documents(docs, spark.read.parquet(f"{SF_SMOKE}/labels.parquet")).collect() if r.predicted}
            table = [(d, t) for d, t in table if d in kept]
        elif name == "lines":
            gone = deleted_lines(table)
            cut = [(d, t.split("\n"), gone.get((d, t), ())) for d, t in table]
            table = [(d, "\n".join(x for i, x in enumerate(lines) if i not in g)) for d, lines, g in cut if len(g) < len(lines)]
        elif name == "near copies":
            prints = {t: simhash(t) for _, t in table}
            root = components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
            first = {}
            for d, t in sorted(table):
                first.setdefault(root[prints[t]], (d, t))
            table = list(first.values())
        elif name == "benchmark":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet").collect()]
            clean = {w[0] for w in contamination(table, items) if not w[5]}
            table = [(d, t) for d, t in table if d in clean]
        if name == "tokens":
            library = Tokenizer.from_file(PATHS["word"])
            ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in table}
            assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in out.collect()} == {
                d: (len(i), sha(" ".join(map(str, i)))) for d, i in ids.items()}
        else:
            assert out.columns == [*schema.names, "hits"] and [out.schema[n].dataType for n in schema.names] == [f.dataType for f in schema]
            state = spark.createDataFrame(out.collect(), out.schema)
            assert sorted((r.doc_id, r.text) for r in state.collect()) == sorted(table), name
            assert all(r.n_chars == len(r.text) for r in state.collect())
    ran = corpus_pipeline.run(spark, SF_SMOKE)
    assert sorted(r.doc_id for r in ran.collect()) == sorted(d for d, _ in table)


def test_pipeline_on_awkward_documents(spark):
    state = frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, SF_SMOKE)
        state = spark.createDataFrame(out.collect(), out.schema)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = spark.createDataFrame(stage(spark, empty, SF_SMOKE).collect(), stage(spark, empty, SF_SMOKE).schema)
        assert empty.count() == 0


def test_one_query_for_each_operator():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMOKE}/documents.parquet')")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    have = QUERIES[name](spark, SF_SMOKE)
    assert sorted(have.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in have.collect()) == sorted(want.fetchall())


def test_library_imports_without_the_subpackage(tmp_path):
    """Entry module and registry work where llm and the pipeline are gone."""
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('stellate.llm'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not any(q.startswith('op') for q in e.queries()) and 'pipeline' not in e.queries()\n")
    import os
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
