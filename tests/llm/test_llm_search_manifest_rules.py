"""Hard negatives, Merkle manifest and quality rules against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import AWKWARD, frame, rows
from pyspark.sql import functions as F

from stellate.llm import hard_negatives as hn, merkle, quality_rules as qr
from stellate.llm.common import package_on_workers


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    package_on_workers(spark)


# 11 --------------------------------------------------------------------------
NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
VECTORS = "id bigint, vector array<float>, label int, score int, anchor int"


def plain_negatives(data, positives=5, negatives=3):
    """Every anchor against every row, in whole numbers."""
    known = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label, *_ in data
             if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda i: (i is not None, i or 0)
    out = []
    for at, (a, av, al) in enumerate(known):
        if a is None or a % 50:
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, label) for k, (i, v, label) in enumerate(known) if k != at and len(v) == len(av)]
        scored.sort(key=lambda s: (-s[0], first(s[1])))
        for ps, pid, _ in [s for s in scored if s[2] == al][:positives]:
            window = [s for s in scored if s[2] != al and 50 * ps <= 100 * s[0] <= 95 * ps][:negatives]
            out += [(a, pid, r, nid, ps, ns) for r, (ns, nid, _) in enumerate(window, 1)]
    return sorted(out, key=repr)


def vectors(n=400, dim=12, seed=3, far=False):
    """Clustered vectors with ties, repeated rows and everything that takes no part."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dim))
    data = []
    for i in range(n):
        label = int(rnd.integers(4))
        v = centres[int(rnd.integers(6))] + rnd.normal(size=dim) * 0.4
        data.append((i, [float(np.float32(x)) for x in (v * (10.0 ** (i % 5 - 2)) if far else v)], label))
    nan, inf = float("nan"), float("inf")
    data += [(50, list(data[50][1]), data[50][2]), (50, list(data[50][1]), data[50][2]), (100, [0.5] * dim, 1), (100, [0.25] * dim, 2)]
    data += [(n + 1, [1.0] * dim, None), (n + 2, None, 1), (n + 3, [1.0] * (dim - 1) + [None], 1), (n + 4, [nan] * dim, 1), (n + 5, [inf] * dim, 1)]
    data += [(None, [0.3] * dim, 1), (None, list(data[50][1]), data[50][2]), (150, [], 1), (n + 6, [], 1), (n + 7, [], 2), (n + 8, [], 2), (200, [0.0] * dim, 3), (n + 9, [0.0] * dim, 2)]
    data += [(250, [1.0, 2.0], 0), (n + 10, [1.0, 1.9], 0), (n + 11, [1.0, 1.5], 1), (-50, [-0.5] * dim, 2), (-51, [-0.4] * dim, 0)]
    return [(*d, 7, 7) for d in data]


@pytest.mark.parametrize("far", [False, True])
def test_hard_negatives(spark, far, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_BYTES", 1500)   # several blocks of anchors
    data = vectors(far=far)
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    got = sorted((tuple(r[c] for c in NEGATIVES) for r in hn.hard_negatives(df, F.col("id") % 50 == 0).collect()), key=repr)
    assert got == plain_negatives(data) and len(got) > 50


def test_hard_negatives_of_copies(spark):
    """A third of all rows are one vector of one id, and scores tie."""
    rnd = random.Random(1)
    data = [(i, [float(rnd.randrange(-1, 2)) for _ in range(3)], rnd.randrange(2), 7, 7) for i in range(200)]
    data += [(50, [1.0, 1.0, 0.0], 0, 7, 7)] * 100
    df = spark.createDataFrame(data, VECTORS).repartition(4)
    got = sorted((tuple(r[c] for c in NEGATIVES) for r in hn.hard_negatives(df, F.col("id") % 50 == 0).collect()), key=repr)
    assert got == plain_negatives(data)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hn.hard_negatives(empty, F.col("id") % 50 == 0).count() == 0
    lone = spark.createDataFrame([(50, [1.0], 1, 7, 7), (51, [2.0], 1, 7, 7)], VECTORS)
    assert hn.hard_negatives(lone, F.col("id") % 50 == 0).count() == 0


def test_bounds_hold_every_score():
    """No pair with a score in its window is left out, and some are."""
    rnd = np.random.default_rng(5)
    v = np.floor(rnd.normal(size=(500, 6)) * 10.0 ** rnd.integers(0, 4, (500, 1)))
    a, norms = v[:40], np.sqrt((v * v).sum(1))
    refs = v[100:110] / norms[100:110, None]
    angles = hn._angles(v, norms, refs)
    low, high = hn._reach(angles[:40], angles)
    scores = (a @ v.T).astype(np.int64)
    for least, most in ((np.quantile(scores, 0.9, 1), np.quantile(scores, 0.95, 1)), (np.quantile(scores, 0.1, 1), np.quantile(scores, 0.2, 1))):
        least, most = least.astype(np.int64), most.astype(np.int64)
        inside = hn._overlap(low, high, norms[:40], norms, least, most)
        wanted = (scores >= least[:, None]) & (scores <= most[:, None])
        assert not (wanted & ~inside).any()
        for piece in (slice(0, 50), slice(50, 500)):
            near = hn._overlap(low[:, piece], high[:, piece], norms[:40], norms[piece], least, most)
            assert not (wanted[:, piece] & ~near).any()
    near = hn._overlap(low, high, norms[:40], norms, scores.max(1) * 9 // 10, None)
    assert near.mean() < 0.9


def test_large_components_stay_exact(spark):
    big = float(2 ** 40)
    data = [(50, [big, 3.0], 1, 7, 7), (51, [big, 1.0], 1, 7, 7), (52, [big * 0.75, 5.0], 2, 7, 7)]
    with pytest.raises(Exception, match="OverflowError"):   # 2^96 is beyond 64 bits
        hn.hard_negatives(spark.createDataFrame(data, VECTORS), F.col("id") % 50 == 0).collect()
    big = float(2 ** 20)
    data = [(50, [big, 3.0, 1.0], 1, 7, 7), (51, [big, 1.0, 5.0], 1, 7, 7), (52, [big * 0.75, 5.0, 0.125], 2, 7, 7)]
    got = [tuple(r[c] for c in NEGATIVES) for r in hn.hard_negatives(spark.createDataFrame(data, VECTORS), F.col("id") % 50 == 0).collect()]
    assert got == plain_negatives(data)


# 12 --------------------------------------------------------------------------
PROOFS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in doc))


def climb(nodes):
    """Levels of (digest, leaf numbers below) from the leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([sha("".join(own[i:i + 2])) for i in range(0, len(own), 2)])
    return levels


def path(levels, k):
    out = []
    for level in levels[:-1]:
        out.append((k % 2, level[k ^ 1] if k ^ 1 < len(level) else None))
        k //= 2
    return out


def plain_proofs(docs, tampered):
    """docs: (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for d in docs:
        trees[d[2]].append((d[0] is not None, d[0] or 0, plain_leaf(d), d))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        levels[name] = climb([x[2] for x in trees[name]])
    top = climb([levels[n][-1][0] for n in names])
    out = []
    for at, name in enumerate(names):
        for k, (_, _, leaf, d) in enumerate(trees[name]):
            siblings = path(levels[name], k) + path(top, at)
            h = plain_leaf((*d[:3], d[3] + 1, d[4])) if tampered(d) and d[3] is not None else leaf
            for right, s in siblings:
                h = sha(h) if s is None else sha(s + h if right else h + s)
            out.append((d[0], leaf, levels[name][-1][0], top[-1][0], sha("".join(s or "" for _, s in siblings)), h, h == top[-1][0]))
    return sorted(out, key=repr)


def marked(d):
    return d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0


def manifest_of(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3)
    for n in ("tree", "rank", "digest", "low", "part", "run"):
        df = df.withColumn(n, F.lit("x"))
    got = merkle.verify_documents(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return sorted((tuple(r[c] for c in PROOFS) for r in got.collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 10])
def test_merkle_proofs(spark, bits, monkeypatch):
    """``bits``: small buckets give many tiers."""
    docs = [(d, s, lang, n, t) for d, t, lang, s, n in rows(AWKWARD)] * 2
    docs += [(100 + i, f"s{i % 3}", ("de", "é", "", None, "zz")[i % 5], i if i % 4 else None, "t" * i) for i in range(37)]
    docs += [(777, None, "de", 3, "a row that is repeated often")] * 40 + [(1000, "s", "one", 2 ** 63 - 1, "x")]
    monkeypatch.setattr(merkle, "BITS", bits)
    assert manifest_of(spark, docs) == plain_proofs(docs, marked)


def test_merkle_of_many_and_of_one(spark):
    docs = [(i, "s", "en" if i % 3 else "fr", i, f"text {i}") for i in range(2300)]
    assert manifest_of(spark, docs) == plain_proofs(docs, marked)
    assert manifest_of(spark, docs[:1]) == plain_proofs(docs[:1], marked)
    assert manifest_of(spark, []) == []


def test_stored_nodes_cover_their_intervals(spark):
    docs = [(i, "s", "en" if i % 3 else "fr", i, f"text {i}") for i in range(2300)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    leaves = df.select("doc_id", merkle.tree_key("lang").alias("tree"), merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]).alias("digest"),
                       F.lit(None).cast("string").alias("sent"))
    found = merkle.build_manifest(leaves, ["doc_id", "digest"])
    nodes = found.nodes().collect()
    assert found.root in {n.digest for n in nodes}
    for tree, n in (("=en", 1533), ("=fr", 767)):
        own = [x for x in nodes if x.tree == tree]
        for level in {x.level for x in own}:
            spans = sorted((x.low, x.high) for x in own if x.level == level)
            assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


# 13 --------------------------------------------------------------------------
STATS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    t = text or ""
    w = _WORDS.findall(t)
    lines = [x for x in t.split("\n") if _WORDS.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines)


TEXTS = AWKWARD + [(200, "a b c " * 3), (201, "a a a a a a"), (202, "x y z\nx y z\n \nx y z"), (203, "a\x1cb c\xa0d 😀 #*$%&|<> a\x1cb c\xa0d 😀"),
                   (204, "one two three four one two three"), (205, "p q r s p q r s p q"), (206, "w " * 70), (207, " ".join(f"w{i}" for i in range(20_000)))]


def test_statistics(spark):
    df = frame(spark, TEXTS)
    for n in ("_text", "_words", "windows", "h", "p"):
        df = df.withColumn(n, F.lit(7))
    got = sorted((tuple(r[c] for c in STATS) for r in qr.with_statistics(df).collect()), key=repr)
    assert got == sorted(((d, *plain_statistics(t)) for d, t in TEXTS), key=repr)


def test_binomial_tail(spark):
    cases = [(n, k, p) for p in (0.01, 0.2, 0.5) for n in (0, 1, 5, 20, 21, 300, 4000) for k in (0, 1, 2, 10, 60, 700) if k <= n]
    df = spark.createDataFrame([(n, k) for n, k, _ in cases], "n bigint, k bigint")
    got = {(r.n, r.k, p): r.t for p in (0.01, 0.2, 0.5) for r in df.distinct().select("n", "k", qr.binomial_tail(F.col("n"), F.col("k"), p).alias("t")).collect()}
    for n, k, p in cases:
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
        assert math.isclose(got[n, k, p], want if k < n * p else 1.0, rel_tol=1e-8), (n, k, p)


def test_binomial_tail_of_many(spark):
    """Ten standard deviations of terms are enough: against the normal law."""
    n, p = 10 ** 9, 0.01
    k = int(n * p - 3 * math.sqrt(n * p * (1 - p)))
    got = spark.range(1).select(qr.binomial_tail(F.lit(n), F.lit(k), p).alias("t")).first().t
    assert math.isclose(got, 0.5 * math.erfc(3 / math.sqrt(2)), rel_tol=5e-3)


def corpus(spark, n_labelled, seed=2):
    """Documents of three strata; bad ones of the first two are full of symbols."""
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n_labelled):
        lang, bad = ("a", "b", None)[i % 3], rnd.random() < 0.2
        words = [f"w{rnd.randrange(9999)}" for _ in range(60)]
        if bad:
            words = [w + "#" * rnd.randrange(1, 4) for w in words]
        docs.append((i, " ".join(words), lang))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int"), dict(labels)


def test_cutoffs_need_enough_labels(spark):
    docs, labels, quality = corpus(spark, 3000)
    got = qr.judge_documents(docs, labels).collect()
    assert sum(r.kept for r in got if quality[r.doc_id]) == sum(quality.values())
    assert not any(r.kept for r in got if not quality[r.doc_id]) and all("symbols" in r.rejected_by for r in got if r.rejected_by)
    # 40 labelled documents a stratum certify nothing
    few = qr.judge_documents(docs, labels.where("doc_id < 120")).collect()
    assert all(r.kept for r in few)
    assert all(r.kept for r in qr.judge_documents(docs, labels.limit(0)).collect())


def test_strata_by_shuffle(spark, monkeypatch):
    docs, labels, _ = corpus(spark, 2400)
    want = sorted(map(tuple, qr.judge_documents(docs, labels).collect()))
    monkeypatch.setattr(qr, "STRATA", 0)
    assert sorted(map(tuple, qr.judge_documents(docs, labels).collect())) == want


def test_risk_is_kept():
    """Of 200 drawn holdouts, far fewer than the error certify a cutoff whose
    true rate is above the risk (exact tail, in turn from lenient to strict)."""
    rnd = np.random.default_rng(1)
    rates, risk, error, n = np.array([0.002, 0.006, 0.0101, 0.02]), 0.01, 0.05, 2000
    tail = lambda k: sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk)
                                  + (n - i) * math.log(1 - risk)) for i in range(k + 1)) if k < n * risk else 1.0
    broken = 0
    for _ in range(200):
        score = rnd.random(n)
        ok = True
        for r in rates:
            ok = ok and tail(int((score < r).sum())) <= error
            broken += ok and r == 0.0101
    assert broken <= 200 * error * 1.8


def test_rules_on_awkward_documents(spark):
    df = frame(spark, TEXTS)
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (9, None), (10, 1)], "doc_id bigint, quality int")
    got = sorted(((r.doc_id, r.base_failed, r.kept) for r in qr.judge_documents(df, labels).collect()), key=repr)
    want = []
    for d, t in TEXTS:
        s = plain_statistics(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((d, failed, not failed))
    assert got == sorted(want, key=repr)
    empty = df.limit(0)
    assert qr.judge_documents(empty, labels).count() == 0


def test_rules_use_no_python(spark):
    docs, labels, _ = corpus(spark, 30)
    for df in (qr.judge_documents(docs, labels), qr.with_statistics(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
