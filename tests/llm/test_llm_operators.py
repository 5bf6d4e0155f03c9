"""Each operator against its plain version, on awkward documents and on the
small tables."""

import hashlib
import random
import struct
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from brute import (AWKWARD, SCHEMA, components, contamination, frame, line_copies, line_report, near_copies, order, removed_bytes, sha, simhash,
                   text_hash)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMOKE
from stellate.llm import bpe, decontaminate, fingerprints, line_runs, shards, simhash as sh, suffix_dedup, token_files
from stellate.llm.common import package_on_workers
from stellate.llm.components import connected_components

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    package_on_workers(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def small(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()]


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def clash(docs):
    """Further columns of names that the operators use inside."""
    for n in ("fp", "row", "d", "h", "runs", "lines", "kept", "hits", "items", "n_words", "score", "grp", "shard"):
        docs = docs.withColumn(n, F.lit(7))
    return docs


# 1 ---------------------------------------------------------------------------
REPEATS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("held", [4096, 2])
def test_repeated_bytes(spark, held):
    df = suffix_dedup.remove_repeats(clash(frame(spark)), held_segments=held, with_text=True)
    assert got(df, *REPEATS) == removed_bytes(AWKWARD, 100)
    for r in df.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeated_bytes_small(spark, small):
    df = suffix_dedup.remove_repeats(spark.read.parquet(f"{SF_SMOKE}/documents.parquet"))
    assert got(df, *REPEATS) == removed_bytes(small, 100)


def test_repeats_of_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    text = random.Random(1).randbytes(5000)
    runs = list(suffix_dedup._pieces([text, b"", text[:50]], 100))
    assert sum(len(r) for r in runs) >= 6
    starts = [o + i for r in runs for n, o, p in r if n == 0 for i in range(len(p) - 99)]
    assert starts == list(range(4901))


def test_suffix_order_marks_all_but_the_first():
    flags = suffix_dedup.repeats_in_suffix_order([b"abcabcabc", b"bca", b"xyz"], 3)
    assert flags.tolist() == [False, False, False, True, True, True, True, True, False]


def test_equal_strings_have_equal_anchors():
    rng = random.Random(2)
    body = bytes(rng.choice(b"ab") for _ in range(300))
    a = [(0, 0, b"q" * 130 + body)]
    b = [(0, 0, rng.randbytes(77) + body)]
    keys = [set(suffix_dedup.segments(r)[0].tolist()) for r in (a, b)]
    assert keys[0] & keys[1]


# 2 ---------------------------------------------------------------------------
ITEMS = [(1, "word1 of a passage word2 of a passage word3 of a passage word4"), (2, "one TWO"), (3, None), (4, "..."), (None, "x"),
         (10, "a text without an id"), (11, "x"), (12, "word1 of a passage word2 of a passage word3 of a passage word4")]
HIT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("bound", [1 << 20, 100])
def test_contamination(spark, bound):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = clash(frame(spark))
    want = contamination(AWKWARD, ITEMS)
    assert got(decontaminate.find_contamination(docs, items, broadcast_bytes=bound), *HIT) == want
    kept = decontaminate.remove_contaminated(docs, items, broadcast_bytes=bound)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((w[0] for w in want if not w[5]), key=repr)


def test_windows_of_items_without_an_id(spark):
    items = spark.createDataFrame([(None, "one two"), ("x", None), ("y", "!")], "item_id string, text string")
    row = decontaminate.find_contamination(frame(spark, [(1, "one two three"), (2, "two one")]), items).orderBy("doc_id").collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in row] == [(2, 0, True), (0, 0, False)]


@pytest.mark.parametrize("piece", [5, 40])
def test_long_items_in_pieces(spark, piece, monkeypatch):
    """Pieces share the words of a window, so that none is lost between them."""
    rnd = random.Random(6)
    words = [f"w{rnd.randrange(40)}" for _ in range(300)]
    items = [("long", " ".join(words)), ("again", " , ".join(words[100:160])), ("short", "w1 w2"), (None, " ".join(words[50:90]))]
    batch = pa.RecordBatch.from_pydict({"item_id": [i for i, _ in items], "text": [t for _, t in items]}, pa.schema([("item_id", pa.string()), ("text", pa.string())]))
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
    pieces = [r for b in decontaminate._normalised(13)([batch]) for r in b.to_pylist()]
    assert len(pieces) > 8 and max(r["n"] for r in pieces) <= piece + 12
    found = decontaminate.benchmark_windows([(r["item_id"], r["words"]) for r in pieces], 13)
    texts = [" ".join(words[i:i + 20]) for i in range(0, 280, 3)] + ["w1 w2 w1 w2", "w2 w1"]
    docs = list(enumerate(texts))
    data = "".join(texts).encode()
    cuts = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hit, ids = decontaminate._search(decontaminate.WordTexts(np.frombuffer(data, np.uint8), cuts), found)
    first = decontaminate.WordTexts(np.frombuffer(data, np.uint8), cuts).first
    want = {w[0]: w for w in contamination(docs, items)}
    for d, _ in docs:
        assert int(hit[first[d]:first[d + 1]].sum()) == want[d][2] and sha(",".join(sorted(ids[d]))) == want[d][4]


def test_equal_hashes_of_different_words():
    text = np.frombuffer(b"a b c d", np.uint8)
    at = np.array([0, 4, 0, 4])
    found = decontaminate.Windows(text, np.array([7, 7, 7, 9], np.uint64), at, at + 3, np.array([0, 1, 2, 3]))
    assert found.keys.tolist() == [7, 7, 9]
    assert found.find(0, b"a b").tolist() == [0, 2] and found.find(0, b"c d").tolist() == [1] and found.find(0, b"x") is None


def test_contamination_small(spark, small):
    items = spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet")
    df = decontaminate.find_contamination(spark.read.parquet(f"{SF_SMOKE}/documents.parquet"), items)
    want = contamination(small, [(r.item_id, r.text) for r in items.collect()])
    assert got(df, *HIT) == want and any(w[5] for w in want) and not all(w[5] for w in want)


# 3 ---------------------------------------------------------------------------
def test_token_files(spark, library, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    df = token_files.token_files(clash(frame(spark)), WORD_BPE, folder=folder)
    encoded = sorted(((order(d), library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in AWKWARD),
                     key=lambda x: (x[0], np.array(x[1], "<u2").tobytes()))
    want, start = [], 0
    for d, ids in encoded:
        want.append((None if d == order(None) else d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got(df, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    shards_of = [token_files.Shard(folder, r.shard) for r in spark.read.parquet(f"{folder}/manifest").collect()]
    found = [s.get(11) for s in shards_of if s.get(11) is not None]
    assert len(found) == 1 and found[0].tolist() == library.encode("a" * 5000).ids + [2]
    assert all(s.get(10**12) is None for s in shards_of)
    assert sum(s.get(9, 1) is not None for s in shards_of) == 1   # the second row of a repeated id


def test_shards_end_after_some_bytes(spark, library, tmp_path):
    """One id holds a third of all rows: its range makes several shards."""
    folder = f"file://{tmp_path}/tokens"
    pairs = [(i, f"text number {i}") for i in range(400)] + [(7, f"another text {i} of the same id") for i in range(200)]
    manifest = token_files.write_token_files(frame(spark, pairs), folder, WORD_BPE, ranges=3, shard_bytes=300).collect()
    assert len(manifest) > 12 and sum(m.n_docs for m in manifest) == 600 and max(m.n_docs for m in manifest) < 60
    rows = token_files.read_token_files(spark, folder).collect()
    want, start = [], 0
    for d, ids in sorted(((d, library.encode(t, add_special_tokens=False).ids + [2]) for d, t in pairs), key=lambda x: (x[0], np.array(x[1], "<u2").tobytes())):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows)) == sorted(want)


def test_another_seed_where_hashes_are_equal(monkeypatch):
    keys = np.arange(5)
    real, seeds = token_files.key_hash, []

    def hashes(k, n, o, seed=0):
        seeds.append(seed)
        return np.zeros(len(k), np.uint64) if seed < 2 else real(k, n, o, seed)

    monkeypatch.setattr(token_files, "key_hash", hashes)
    assert token_files.distinct_hashes(keys, np.zeros(5, bool), np.zeros(5, np.uint32))[0] == 2 and seeds == [0, 1, 2]
    monkeypatch.setattr(token_files, "key_hash", lambda k, n, o, seed=0: np.zeros(len(k), np.uint64))
    with pytest.raises(ValueError):
        token_files.distinct_hashes(keys, np.zeros(5, bool), np.zeros(5, np.uint32))


def test_perfect_hash_is_minimal():
    keys = np.arange(5000) * 7919
    hashes = token_files.key_hash(keys, np.zeros(5000, bool), np.zeros(5000))
    index = token_files.KeyIndex.build(hashes, keys.astype(np.uint64), np.ones(5000, np.uint64))
    assert sorted(index.slots(hashes)) == list(range(5000))
    known, start, _ = index.find(hashes)
    assert known.all() and (start == keys.astype(np.uint64)).all()
    other = token_files.key_hash(keys + 1, np.zeros(5000, bool), np.zeros(5000))
    assert not index.find(other)[0].any()


def test_library_encoder_forgets_and_still_agrees(library, small, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 50)
    texts = [t for _, t in small if t][:40] + [t for _, t in AWKWARD if t]
    encoder = token_files.LibraryEncoder(WORD_BPE)
    for i in range(0, len(texts), 3):
        for t, raw in zip(texts[i:i + 3], encoder.encode(texts[i:i + 3])):
            assert np.frombuffer(raw, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids
    bytewise = public_tokenizers.path("byte_bpe_50k.json")
    assert np.frombuffer(token_files.LibraryEncoder(bytewise).encode(["It's so"])[0], "<u2").tolist() == Tokenizer.from_file(bytewise).encode("It's so").ids


# 4 ---------------------------------------------------------------------------
def test_shards(spark):
    many = AWKWARD + [(i, f"text {i}") for i in range(100, 700)] + [(99, "same")] * 200
    docs = clash(frame(spark, many))
    df = shards.shard_documents(docs, bucket_bytes=2000)
    rows = df.collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in many if d is not None)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) == set(range(16))
    assert len({r.shard for r in rows if r.doc_id == 99}) == 1
    assert 0 < sum(r.grown_shard == 16 for r in rows) < len(rows) / 4
    again = {(r.doc_id, r.text_crc32): r.shard for r in shards.shard_documents(frame(spark, many), bucket_bytes=2000).collect()}
    assert all(again[r.doc_id, r.text_crc32] == r.shard for r in rows)


def plain_shard(key, n, seed=shards.SEED):
    """Highest of a chained 64-bit hash of seed, shard and key; the lower shard on a tie."""
    best = None
    for s in range(n):
        h = 42
        for raw in (struct.pack("<i", seed), struct.pack("<i", s), *([] if key is None else [struct.pack("<q", key)])):
            h = xxhash.xxh64_intdigest(raw, h)
        h -= (1 << 64) if h >> 63 else 0
        best = max(best, (h, -s)) if best else (h, -s)
    return -best[1]


def test_shards_follow_the_law(spark):
    many = AWKWARD + [(i * 37 - 500, f"text {i}") for i in range(200)]
    rows = shards.shard_documents(frame(spark, many), bucket_bytes=2000).collect()
    assert sorted(((r.doc_id, r.shard, r.grown_shard) for r in rows), key=repr) == sorted(
        ((d, plain_shard(d, 16), plain_shard(d, 17)) for d, _ in many), key=repr)


def test_slots_of_very_many_buckets(spark):
    counts = spark.range(40_000).select((F.col("id") % 2).cast("int").alias("shard"), F.floor(F.col("id") / 2).cast("int").alias("bucket"), (F.col("id") % 7).alias("n"))
    began = time.time()
    got_rows = {(r.shard, r.bucket): r.before for r in shards.rows_before(counts).collect()}
    assert time.time() - began < 30 and len(got_rows) == 40_000
    for shard in (0, 1):
        total = 0
        for bucket in range(20_000):
            assert got_rows[shard, bucket] == total
            total += (2 * bucket + shard) % 7


def test_shards_of_a_shuffled_input_are_written_first(spark):
    docs = frame(spark).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    settled = shards._settled(docs)
    assert "Exchange" not in settled._jdf.queryExecution().executedPlan().toString() and settled.count() == docs.count()
    plain = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    assert shards._settled(plain) is plain


def test_fisher_yates_is_a_uniform_order():
    assert sorted(shards.fisher_yates(50, np.random.default_rng(1))) == list(range(50))
    assert shards.fisher_yates(0, np.random.default_rng(1)).tolist() == []
    seen = np.zeros((4, 4))
    rng = np.random.default_rng(2)
    for _ in range(4000):
        seen[np.arange(4), shards.fisher_yates(4, rng)] += 1
    assert (abs(seen / 4000 - 0.25) < 0.05).all()


# 5 ---------------------------------------------------------------------------
def test_bpe(spark, library, small):
    pairs = AWKWARD + small[:60]
    df = bpe.encode_decode(clash(frame(spark, pairs)), WORD_BPE)
    want = []
    for d, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got(df, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_random_words(library):
    rng = random.Random(3)
    model = bpe.bpe(WORD_BPE)
    for _ in range(3000):
        word = "".join(rng.choice("aeiounrsthldéñ日'!1 ") for _ in range(rng.randrange(1, 40)))
        assert model.encode(word)[0].tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_bpe_memory_is_renewed(library, small, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 40)
    model = bpe.Bpe(WORD_BPE)
    for _, t in small[:30]:
        assert model.encode(t or "")[0].tolist() == library.encode(t or "", add_special_tokens=False).ids
    assert len(model._bytes) <= max(40, max(len(set((t or "").split())) * 2 for _, t in small[:30]))


# 6 ---------------------------------------------------------------------------
@pytest.mark.parametrize("bucket", [1024, 3])
def test_simhash(spark, bucket, small):
    pairs = AWKWARD + [(d + 1000, t) for d, t in small[:80]] + [(3000 + i, "one two three four five six seven " * 30 + f"end{i}") for i in range(25)]
    docs = clash(frame(spark, pairs))
    want = near_copies(pairs)
    assert got(sh.near_duplicates(docs, bucket=bucket), "doc_id", "fingerprint", "component_id") == want
    kept = sh.keep_one(docs, bucket=bucket)
    assert kept.columns == docs.columns
    # one row of each component, that of its smallest id
    prints = [simhash(t) for _, t in pairs]
    roots = components(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for (d, _), p in zip(pairs, prints):
        first[roots[p]] = min(first.get(roots[p], (True, 0)), (d is None, d or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(first.values())


def test_simhash_links_in_crowded_buckets(spark):
    """Many fingerprints that share most bits: dealt out again, none lost."""
    rng = random.Random(4)
    values = {rng.getrandbits(10) << 20 | 5 for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame_ = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for bucket in (1024, 8):
        edges = [(r.a, r.b) for r in sh.near_links(frame_, bucket=bucket).collect()]
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in edges)
        want = components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
        have = components(signed, lambda a, b, e=set(edges): (a, b) in e or (b, a) in e)
        assert len(set(want.values())) == len(set(have.values()))


def test_masks_cover_every_three_bits():
    rng = random.Random(5)
    for level in range(3):
        tables = sh.masks(3, level)
        for _ in range(3000):
            bits = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(not m & bits for m in tables)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150), (150, 200)]
    have = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert have == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 150: 150, 200: 150}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 7 ---------------------------------------------------------------------------
LINES = ("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", "kept_sha256")


@pytest.mark.parametrize("min_lines, min_words", [(1, None), (2, 50)])
def test_line_runs(spark, min_lines, min_words):
    docs = clash(frame(spark))
    want = line_report(AWKWARD, min_lines, min_words)
    assert got(line_runs.line_report(docs, min_lines, min_words), *LINES) == want
    cut = line_runs.delete_copies(docs, min_lines, min_words)
    assert cut.columns == docs.columns and cut.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    left = [w for w in want if w[1] == 0 or w[2] < w[1]]
    assert sorted((r.doc_id, sha(r.text or "")) for r in cut.collect() if r.doc_id is not None) == sorted(
        (w[0], w[5]) for w in left if w[0] is not None)


@pytest.mark.parametrize("min_lines", [4])
def test_line_runs_of_many_words(spark, min_lines):
    """A passage of many words goes though it has few lines."""
    many, edge = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(49))
    half = " ".join(f"h{i}" for i in range(25))
    pairs = AWKWARD + [(40, f"a\n{many}\nb\n{edge}"), (41, f"c\n{many}\nd\n{edge}"), (42, f"{many}\n{many}"), (43, f"e\n{half}\n{half}x\nf"),
                       (44, f"g\n{half}\n{half}x\n{many}"), (45, f"a\n{many}\nb")]
    df = line_runs.line_report(clash(frame(spark, pairs)), min_lines, 50)
    assert got(df, *LINES) == line_report(pairs, min_lines, 50)
    assert {r.doc_id: r.n_removed for r in df.collect()}[41] == 1


def test_long_passages_of_one_line_are_cut_out(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    pairs = [(1, f"own one\n{passage}\nown two"), (2, f"own three\n{passage}\nown four"), (3, passage), (4, "own one\nshort")]
    assert got(line_runs.delete_copies(frame(spark, pairs)), "doc_id", "text") == [pairs[0], (2, "own three\nown four"), pairs[3]]
    assert got(line_runs.delete_copies(frame(spark, pairs), min_words=None), "doc_id", "text") == pairs


def test_runs_of_different_origins_are_runs_of_their_own(spark):
    pairs = [(1, "b\nx"), (2, "c\nd"), (3, "w\nb\nx\nc\nd\nv"), (4, "o\np\nq"), (5, "n\no\np"), (6, "n\no\np\nq")]
    report = {r.doc_id: (r.n_removed, r.n_runs, r.longest_run) for r in line_runs.line_report(frame(spark, pairs)).collect()}
    assert report[3] == (4, 2, 2) and report[5] == (2, 1, 2) and report[6] == (4, 2, 3)


@pytest.mark.parametrize("letters, seed", [(2, 1), (12, 3)])
def test_longest_copies_of_random_lines(spark, letters, seed):
    """Every start's longest earlier run, on lines that repeat in all ways."""
    rnd = random.Random(seed)
    pairs = [(i, "\n".join(rnd.choice("abcdefghijkl"[:letters]) for _ in range(rnd.randrange(1, 40)))) for i in range(60)]
    pairs += [(100, "\n".join("ab" * 40)), (101, "\n".join("a" * 70)), (102, pairs[3][1] + "\n" + pairs[4][1])]
    found = {(r.d, r.i): r.n for r in line_runs.longest_copies(frame(spark, pairs)).collect()}
    want = {(d, a): b - a for (d, _), runs in line_copies(pairs, 1, None).items() for a, b in runs}
    assert found == want and max(found.values()) > 16


def test_line_runs_with_hot_lines(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "HOT_ROWS", 3)
    pairs = [(i, f"common one\ncommon two\nown {i}\ncommon one\nown again {i}") for i in range(60)]
    assert got(line_runs.line_report(frame(spark, pairs)), *LINES) == line_report(pairs)


def test_line_runs_use_no_python(spark):
    plan = line_runs.line_report(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 10 --------------------------------------------------------------------------
def test_fingerprints(spark, small):
    pairs = AWKWARD + [(d + 1000, t) for d, t in small[:60]]
    rows = fingerprints.document_fingerprints(clash(frame(spark, pairs)), buckets=5).collect()
    texts = [t for _, t in sorted((order(d), t or "") for d, t in pairs)]
    edits = [fingerprints.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
    ids = sorted(order(d) for d, _ in pairs)
    want = sorted((d, len(t), sha(e)) for d, t, e in zip(ids, texts, edits))
    assert sorted((order(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    by_text = {}
    for t, s in zip(texts, fingerprints.sketches(texts)):
        assert by_text.setdefault(t, fingerprints.fingerprint(s)) == fingerprints.fingerprint(s)
    assert len(set(by_text.values())) == len(by_text)
    one = fingerprints.document_fingerprints(frame(spark, [(1, "alone here")]), buckets=3).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == sha("alonealone")


def plain_sketch(text):
    """Fingerprint parts by definition: polynomial hashes of all spans."""
    def value(span):
        parts = [sum((ord(c) + 1) * pow(b, k, 2 ** 31 - 1) for k, c in enumerate(span)) % (2 ** 31 - 1) for b in fingerprints.BASES]
        return parts[0] << 31 | parts[1]

    n, own = len(text), 16
    while own > 1 and n < 4 * own:
        own //= 2
    lengths = [16] if n >= 128 else [k for k in (16, 8, 4, 2, 1) if k <= own]
    return n, value(text), {k: sorted({value(text[i:i + k]) for i in range(n - k + 1)})[:24] for k in lengths if n}


def plain_likeness(a, b):
    if a[:2] == b[:2]:
        return 1.0
    common = a[2].keys() & b[2].keys()
    if not common:
        return 0.0
    x, y = a[2][max(common)], b[2][max(common)]
    some = sorted({*x, *y})[:24]
    return sum(v in x and v in y for v in some) / len(some)


def common_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_fingerprints_by_definition(spark, small):
    pairs = [(d, (t or "")[:400]) for d, t in AWKWARD if d is not None] + [(100 + i, "xyz abc"[:i]) for i in range(8)] + [
        (200 + i, f"{'a short text of this many letters, and then some more of them to follow'[:3 * i]}") for i in range(24)] + [(d + 1000, t[:700]) for d, t in small[:20]]
    rows = fingerprints.document_fingerprints(frame(spark, pairs), buckets=3).collect()
    docs = sorted((d, t) for d, t in pairs)
    want = []
    for (d, t), (_, following) in zip(docs, docs[1:] + docs[:1]):
        changed = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        own, other, after = plain_sketch(t), plain_sketch(changed), plain_sketch(following)
        line = f"{own[0]:08x}{own[1]:016x}" + "".join(f"{v:016x}" for k in sorted(own[2], reverse=True) for v in own[2][k])
        want.append((d, line, round(plain_likeness(own, other), 9), round(plain_likeness(own, after), 9), common_prefix(t, changed), common_prefix(t, following)))
    assert sorted((r.doc_id, r.fingerprint, round(r.near_edited, 9), round(r.near_next, 9), r.prefix_edited, r.prefix_next) for r in rows) == sorted(want)
    # an unchanged half leaves common spans, however short the text; among many spans the sketch may miss them
    assert all(r.near_edited > 0 for r in rows if 0 < r.n_chars < 32)
    assert sum(r.near_edited > 0 for r in rows if r.n_chars) >= 0.95 * sum(r.n_chars > 0 for r in rows)


def test_prefix_hashes_answer_spans():
    rng = random.Random(6)
    codes = np.array([rng.choice([97, 98, 0x1F600]) for _ in range(400)] * 2, np.uint32)
    hashes = fingerprints.PrefixHashes(codes)
    for _ in range(300):
        i, j, n = rng.randrange(700), rng.randrange(700), rng.randrange(100)
        assert bool(hashes.equal(i, j, n)) == (codes[i:i + n].tolist() == codes[j:j + n].tolist())
    longest = hashes.common_extension(np.array([0, 5, 1]), np.array([400, 405, 0]), 1000)
    assert longest[:2].tolist() == [400, 395]


# empty tables -----------------------------------------------------------------
def test_empty_tables(spark, tmp_path):
    none = clash(spark.createDataFrame([], SCHEMA))
    items = spark.createDataFrame([], "item_id bigint, text string")
    for df in (suffix_dedup.remove_repeats(none), decontaminate.find_contamination(none, items),
               token_files.token_files(none, WORD_BPE, folder=f"file://{tmp_path}/none"), shards.shard_documents(none),
               bpe.encode_decode(none, WORD_BPE), sh.near_duplicates(none), line_runs.line_report(none),
               fingerprints.document_fingerprints(none), line_runs.delete_copies(none), sh.keep_one(none),
               decontaminate.remove_contaminated(none, items)):
        assert df.collect() == []
    docs = frame(spark)
    assert not any(r.contaminated for r in decontaminate.find_contamination(docs, items).collect())
    assert simhash(None) == 0


def test_line_runs_of_a_row_that_is_repeated_often(spark):
    """Equal rows are one document: their starts don't multiply by rounds."""
    text = "\n".join(f"own line {i}" for i in range(6))
    pairs = [(1, text)] * 200 + [(2, text), (3, "own line 1\nown line 2\nown line 3\nother")]
    for min_lines in (2, 5):
        assert line_runs.later_copies(frame(spark, pairs), min_lines).count() == {2: 5 + 2, 5: 2}[min_lines]
        assert got(line_runs.line_report(frame(spark, pairs), min_lines), *LINES) == line_report(pairs, min_lines)
