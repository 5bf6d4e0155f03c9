"""Removal of repeated runs of lines, with DataFrame functions only.

Prefix doubling over the line ids of all documents: starts whose runs of 2^k
lines are equal form a class, named by its first position; a class of twice
the length is a pair of names, 2^k lines apart. Starts whose run is found
nowhere else leave at once, so each round has only the repeats of the one
before, and doubling goes on until none are left.

The classes of every length are the intervals of the suffix array in which
neighbours share that many lines, and the longest in which a start is not the
first gives the longest run from it that also starts earlier. It is found by
halving: a class is split by the names that follow, the longer first; the first
of a subclass stays behind for it, so that each round has a row a start and a
row a class. A later copy of ``min_lines`` lines or more counts, and so does a
shorter one of ``min_words`` words. Runs that no other run holds are reported;
lines that any of them covers are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, stored, unused_name

MIN_LINES = 2
LONG_WORDS = 50
HOT_ROWS = 10_000
_LEAST = -(1 << 63)
_BREAK = "\n"
_WORD = r"[^ \t\n\x0B\f\r]+"


def _document(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells documents apart, in their order: the id (null first) and a
    hash of the text."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LEAST)).alias("d"), F.xxhash64(text).alias("h")]


def _named(starts: DataFrame, keys: list[str], carried: list[str], most: int | None = None) -> tuple[DataFrame, int]:
    """(d, h, i, first) and the carried columns, which are equal in a class,
    for the starts of classes with several starts, and how many these are.
    ``most``: how many starts there are at most, where that is known.

    The classes are found with partial aggregation. Those that hold very many
    starts are few (fewer than four a partition), so they are broadcast and
    their starts stay where they are; only the others are joined by a shuffle.
    """
    classes = (starts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct("d", "h", "i")).alias("first"))
               .where("_rows > 1"))
    if most is not None and most <= HOT_ROWS:
        joined = starts.join(classes.drop("_rows"), keys)
    else:
        classes = stored(classes, "classes")
        rows = classes.agg(F.sum("_rows")).first()[0] or 0
        limit = max(HOT_ROWS, rows // (4 * partitions(starts.sparkSession)))
        hot, cold = classes.where(F.col("_rows") > limit).drop("_rows"), classes.where(F.col("_rows") <= limit).drop("_rows")
        few = starts.join(F.broadcast(hot), keys)
        joined = few.unionByName(starts.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))
    # rows equal in doc_id and text have equal starts: one of each goes on
    named = stored(joined.select("d", "h", "i", "first", *carried).distinct(), "names")
    return named, named.count()


def _lines(docs: DataFrame) -> DataFrame:
    """(d, h, i, k1, k2, words): every line, by 128 bits of hash."""
    lines = docs.where(F.length("text") > 0).select(*_document(), F.posexplode(F.split("text", _BREAK)).alias("i", "line"))
    return lines.select("d", "h", "i", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"),
                        F.regexp_count("line", F.lit(_WORD)).alias("words"))


def _classes(docs: DataFrame) -> list[tuple[DataFrame, int]]:
    """For each k the starts (d, h, i) of 2^k lines that have an equal run
    elsewhere, with its first position and number of words; and how many."""
    levels = [_named(stored(_lines(docs), "lines"), ["k1", "k2"], ["words"])]
    while levels[-1][1]:
        step, (named, n) = 1 << (len(levels) - 1), levels[-1]
        after = named.select("d", "h", (F.col("i") - step).alias("i"), F.col("first").alias("k2"), F.col("words").alias("more"))
        pairs = named.withColumnRenamed("first", "k1").join(after, ["d", "h", "i"]).withColumn("words", F.col("words") + F.col("more"))
        levels.append(_named(pairs, ["k1", "k2"], ["words"], n))
    return levels[:-1]


def _copied(level: DataFrame) -> DataFrame:
    """The starts that are not the first of their class."""
    return level.where(F.struct("d", "h", "i") > F.col("first"))


def _firsts(level: DataFrame) -> DataFrame:
    return level.where(F.struct("d", "h", "i") == F.col("first"))


def longest_copies(docs: DataFrame) -> DataFrame:
    """(d, h, i, n, words): for each start whose line also starts earlier the
    most lines that do, and their words."""
    levels = _classes(docs)
    if not levels:
        return docs.sparkSession.createDataFrame([], "d bigint, h bigint, i int, n int, words int")
    done = pool = None
    for k in reversed(range(len(levels))):
        level, n = levels[k]
        if pool is not None:
            pool = _longer(pool, level, 1 << k)
        # those that are copies of 2^k lines but not of 2^(k+1), and the first
        # of each class, which they are compared with
        own = _copied(level)
        if k + 1 < len(levels):
            own = own.join(_copied(levels[k + 1][0]).select("d", "h", "i"), ["d", "h", "i"], "left_anti")
        enter = own.select("d", "h", "i", F.lit(1 << k).alias("n"), "words", F.col("first").alias("grp"), F.lit(False).alias("anchor"))
        if not k:
            done = enter     # one line: nothing longer to look for
            break
        firsts = _firsts(level).select("d", "h", "i", F.lit(1 << k).alias("n"), "words", F.col("first").alias("grp"), F.lit(True).alias("anchor"))
        enter = enter.unionByName(firsts)
        pool = enter if pool is None else pool.unionByName(enter)
    if pool is not None:
        done = done.unionByName(pool.where("NOT anchor"))
    return done.select("d", "h", "i", "n", "words")


def _longer(pool: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """The pool with ``step`` lines more where an earlier start of the same
    group goes on with the same lines."""
    pool = stored(pool, "pool")
    following = level.select("d", "h", F.col("i").alias("at"), F.col("first").alias("following"), F.col("words").alias("more"))
    on = pool.withColumn("at", F.col("i") + F.col("n")).join(following, ["d", "h", "at"]).drop("at").withColumn("words", F.col("words") + F.col("more"))
    found, n = _named(on, ["n", "grp", "following"], ["n", "words", "anchor"], pool.count())
    if not n:
        return pool
    moved = _copied(found).select("d", "h", "i", (F.col("n") + step).alias("n2"), F.col("words").alias("words2"), F.col("first").alias("grp2"))
    anchors = (_firsts(found)
               .select("d", "h", "i", (F.col("n") + step).alias("n"), "words", F.col("first").alias("grp"), F.lit(True).alias("anchor")).distinct())
    # a start is in the pool once, besides being the first of groups
    own = pool.where("NOT anchor").join(moved, ["d", "h", "i"], "left").select(
        "d", "h", "i", F.coalesce("n2", "n").alias("n"), F.coalesce("words2", "words").alias("words"), F.coalesce("grp2", "grp").alias("grp"), "anchor")
    return own.unionByName(pool.where("anchor")).unionByName(anchors)


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = LONG_WORDS) -> DataFrame:
    """(d, h, i, n): every start of a later copy that counts, with its length."""
    enough = F.col("n") >= min_lines
    return longest_copies(docs).where(enough if min_words is None else enough | (F.col("words") >= min_words)).select("d", "h", "i", "n")


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = LONG_WORDS) -> DataFrame:
    """(d, h, runs, longest, cuts): per document the runs that also start
    earlier and that no other one holds (their number), the lines of the
    longest, and the lines to delete, as [start, end) in order."""
    order = Window.partitionBy("d", "h").orderBy("i")
    before = F.max(F.col("i") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = later_copies(docs, min_lines, min_words).withColumn("end", F.col("i") + F.col("n")).withColumn("before", F.coalesce(before, F.lit(-1)))
    # ends never fall: a run that reaches no further than those before is held by one
    whole = ends.where(F.col("end") > F.col("before")).withColumn("new", (F.col("i") > F.col("before")).cast("int"))
    runs = (whole.withColumn("run", F.sum("new").over(order)).groupBy("d", "h", "run")
            .agg(F.min("i").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("runs"), F.max("n").alias("longest")))
    return runs.groupBy("d", "h").agg(F.sum("runs").alias("runs"), F.max("longest").alias("longest"),
                                      F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def _cut(docs: DataFrame, min_lines: int, min_words: int | None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns for its runs and what is left of its lines."""
    own = {n: unused_name(docs, n) for n in ("d", "h", "runs", "longest", "cuts", "lines", "kept")}
    runs = stored(repeated_runs(docs, min_lines, min_words), "runs").toDF(*[own[n] for n in ("d", "h", "runs", "longest", "cuts")])
    d, h = _document()
    keyed = docs.withColumn(own["d"], d).withColumn(own["h"], h)
    cuts, lines = F.col(own["cuts"]), F.col(own["lines"])
    # sorted and merged whatever the size of either side
    cut = (keyed.join(runs.hint("merge"), [own["d"], own["h"]], "left")
           .withColumn(own["cuts"], F.coalesce(cuts, F.array().cast("array<struct<start:int,end:int>>")))
           .withColumn(own["lines"], F.when(F.length("text") > 0, F.split("text", _BREAK)).otherwise(F.array().cast("array<string>"))))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(cuts, lambda r: r["end"])).alias("a"),
                        F.concat(F.transform(cuts, lambda r: r["start"]), F.array(F.size(lines))).alias("b"))
    kept = F.when(F.size(cuts) == 0, lines).otherwise(F.flatten(F.transform(
        gaps, lambda g: F.slice(lines, g["a"] + 1, F.greatest(g["b"] - g["a"], F.lit(0))))))
    return cut.withColumn(own["kept"], kept), own


def line_report(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = LONG_WORDS) -> DataFrame:
    """Per document: lines, deleted lines, repeated runs that no other run
    holds, lines of the longest, and sha256 of the lines left, joined by line
    feeds. A run is repeated if it also starts earlier; it counts if it has
    ``min_lines`` lines, or ``min_words`` words (None: never by words).

    Null and empty texts have no lines. A null doc_id comes first (together
    with the id -2^63, if there is one). Of rows of a repeated doc_id with
    different texts the smaller text hash comes first; rows equal in doc_id
    and text are one document, cut alike. An empty table gives no rows; other
    columns are ignored.
    """
    cut, own = _cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), min_lines, min_words)
    return cut.select(
        "doc_id", F.size(own["lines"]).cast("bigint").alias("n_lines"),
        (F.size(own["lines"]) - F.size(own["kept"])).cast("bigint").alias("n_removed"),
        F.coalesce(own["runs"], F.lit(0)).cast("bigint").alias("n_runs"), F.coalesce(own["longest"], F.lit(0)).cast("bigint").alias("longest_run"),
        F.sha2(F.array_join(own["kept"], _BREAK), 256).alias("kept_sha256"))


def delete_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with the later copies cut out of the texts (and n_chars, if
    there is such a column, counted anew); documents that lose all their
    lines go, others stay as they are, those of null or empty texts too. An
    empty table gives no rows."""
    cut, own = _cut(docs, min_lines, min_words)
    whole = F.size(own["cuts"]) == 0
    text = F.when(whole, F.col("text")).otherwise(F.array_join(own["kept"], _BREAK))
    cut = cut.where(whole | (F.size(own["kept"]) > 0)).withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return cut.select(*docs.columns)


#: Pairs of equal lines that follow one another on a diagonal make the runs
#: that two starts share; a start's longest with an earlier one counts.
LINE_REPORT_SQL = f"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE length(text) > 0),
repeated AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY line) AS c, len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) AS words
  FROM (SELECT *, count(*) OVER (PARTITION BY line) AS n FROM lines) x WHERE n > 1),
equal AS (SELECT a.doc_id AS p, a.i AS i, b.doc_id AS q, a.i - b.i AS shift
  FROM repeated a JOIN repeated b ON a.c = b.c AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.i < a.i)),
islands AS (SELECT p, i, q, shift, i - row_number() OVER (PARTITION BY p, q, shift ORDER BY i) AS island FROM equal),
shared AS (SELECT p, i, row_number() OVER (PARTITION BY p, q, shift, island ORDER BY i DESC) AS n FROM islands),
longest AS (SELECT p AS doc_id, i, max(n) AS n FROM shared GROUP BY p, i),
counted AS (SELECT l.* FROM longest l JOIN repeated r USING (doc_id, i) WHERE l.n >= {MIN_LINES} OR r.words >= {LONG_WORDS}),
runs AS (SELECT * FROM (SELECT *, coalesce(max(i + n) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM counted) x WHERE i + n > before),
per_doc AS (SELECT doc_id, count(*) AS n_runs, max(n) AS longest FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM runs),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS rest
         FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(coalesce(longest, 0) AS BIGINT) AS longest_run,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN per_doc USING (doc_id)"""
