"""Quality rules with risk-controlled cutoffs, with DataFrame functions only.

A rule rejects documents whose statistic lies above a cutoff. For each stratum
and rule the cutoffs of a fixed grid are tried from the most lenient to the
strictest on all labelled documents: a cutoff is certified if, were its rate of
false rejection as high as allowed, so few rejected good documents would be
unlikely (exact binomial tail). The first that fails ends the sequence, so the
grid costs no confidence; strata and rules share it (Bonferroni), and the rules
share the risk (union bound). With the given confidence, then, every certified
cutoff of every stratum keeps its rate, whichever is chosen: the one that
rejects most bad documents beyond the good ones it costs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, unused_name

RISK = 0.05          # share of a stratum's good documents that all rules together may reject
ERROR = 0.05         # chance that any certified cutoff of any stratum exceeds its share
MIN_WORDS = 50
MAX_REPEATED = 50    # percent of the words
STRATA = 50_000      # strata whose cutoffs are broadcast; more are joined by a salted shuffle
SALTS = 64
_SPACES = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Rejects what lies above the cutoff; ``value`` is SQL over the statistics
    (also run by DuckDB), ``grid`` goes from lenient to strict."""

    name: str
    value: str
    grid: tuple[float, ...]


RULES = (
    Rule("symbols", "CAST(n_symbols AS DOUBLE) / word_chars", (0.3, 0.25, 0.2, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)),
    Rule("repeated_words", "CAST(n_repeat_words AS DOUBLE) / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("repeated_lines", "CAST(n_dup_lines AS DOUBLE) / n_lines", (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("long_words", "CAST(word_chars AS DOUBLE) / n_words", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
    Rule("short_words", "-CAST(word_chars AS DOUBLE) / n_words", (-1.5, -2.0, -2.5, -3.0, -3.5, -4.0, -4.25)),
)
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of the text; null counts as empty.

    Words in 3-word windows that come twice or more: windows are sorted by
    128 bits of hash, those equal to a neighbour are repeated, and the words
    that any of them covers count once. Every step is linear or a sort in the
    length of the text.
    """
    own = [unused_name(docs, n) for n in ("_text", "_words", "_lines", "_windows", "_twice")]
    t, words, lines, windows, twice = map(F.col, own)
    few = F.size(words) < 3
    # arrays that are used more than once are columns of their own
    split = (docs.withColumn(own[0], F.coalesce(F.col(text), F.lit("")))
             .withColumn(own[1], F.filter(F.split(t, _SPACES), lambda w: w != ""))
             .withColumn(own[2], F.filter(F.split(t, "\n"), lambda line: line.rlike(_WORD))))
    zipped = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"),
                          F.slice(words, 3, F.greatest(F.size(words), F.lit(1))).alias("c"))
    hashed = F.transform(zipped, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"),
                                                       F.xxhash64(F.lit(1), x["c"], x["b"], x["a"]).alias("g"), i.alias("p")))
    # the last two start no window
    whole = F.when(few, F.slice(hashed, 1, 0)).otherwise(F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0))))
    sort = split.withColumn(own[3], F.sort_array(whole))
    pairs = F.zip_with(windows, F.slice(windows, 2, F.greatest(F.size(windows), F.lit(1))), lambda a, b: F.when(
        (a["h"] == b["h"]) & (a["g"] == b["g"]), F.array(*[x["p"] + k for x in (a, b) for k in range(3)])))
    found = sort.withColumn(own[4], F.filter(pairs, lambda p: p.isNotNull()))
    n = {"n_words": F.size(words), "word_chars": F.length(F.regexp_replace(t, _SPACES, "")), "n_symbols": F.regexp_count(t, F.lit(_SYMBOL)),
         "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
         "n_repeat_words": F.size(F.array_distinct(F.flatten(twice))), "n_lines": F.size(lines)}
    return found.select(*docs.columns, *[c.cast("bigint").alias(name) for name, c in n.items()])


def base_failed(min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))


# Exact binomial tails --------------------------------------------------------

def _log_factorial(n: Column) -> Column:
    """Exact up to 20, then Stirling's series (an error below 1e-13)."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Chance of ``k`` or fewer among ``n`` at rate ``p``, for k below n * p; 1
    beyond. From k downwards each term is the one before times a ratio below
    1; after ten standard deviations nothing is left to add."""
    log_term = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                + k * F.lit(math.log(p)) + (n - k) * F.lit(math.log1p(-p)))
    terms = F.least(k, F.ceil(10 * F.sqrt(n * F.lit(p * (1 - p)))) + 60).cast("bigint")

    def further(state: Column, j: Column) -> Column:
        i = k - j
        term = state["term"] * i * F.lit(1 - p) / ((n - i + 1) * F.lit(p))
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    steps = F.when(terms > 0, F.sequence(F.lit(0).cast("bigint"), F.greatest(terms - 1, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), further)["total"]
    return F.when(k < n * F.lit(p), F.exp(log_term) * total).otherwise(F.lit(1.0))


# Cutoffs ---------------------------------------------------------------------

def _first_rejecting(rule: Rule) -> Column:
    """Number of the first cutoff that rejects; the grid's length if none does."""
    return reduce(lambda a, b: a + b, [(~(F.expr(rule.value) > c)).cast("int") for c in rule.grid])


def certified_cutoffs(statistics: DataFrame, labels: DataFrame, stratum: str, rules: Sequence[Rule] = RULES, risk: float = RISK,
                      error: float = ERROR, good: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_lost, n_caught): for each stratum and
    rule the certified cutoff that rejects most labelled bad documents beyond
    the good ones; none where that is no gain. ``statistics``: documents that
    passed the base rules, with a key, ``stratum``, that is never null."""
    level = [f"_first{i}" for i in range(len(rules))]
    # an id may be that of very many rows: they are counted before they are joined
    counted = (statistics.where("doc_id IS NOT NULL").select("doc_id", stratum, *[_first_rejecting(r).alias(c) for r, c in zip(rules, level)])
               .groupBy("doc_id", stratum, *level).agg(F.count(F.lit(1)).alias("n")))
    marked = labels.where(f"doc_id IS NOT NULL AND {good} IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.max(good) == 1).alias("good"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(c).alias("first")) for i, c in enumerate(level)])).alias("x")
    seen = stored(counted.join(marked, "doc_id").select(F.col(stratum), "good", "n", each)
                  .groupBy(stratum, F.col("x.rule").alias("rule"), F.col("x.first").alias("first"))
                  .agg(F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                       F.sum(F.when(F.col("good"), 0).otherwise(F.col("n"))).alias("bad")), "labelled")
    chains = max(1, seen.select(stratum).distinct().count() * len(rules))
    # a list has a grid's length at most
    lists = seen.groupBy(stratum, "rule").agg(F.sum("good").alias("n_good"), F.collect_list(F.struct("first", "good", "bad")).alias("h"))
    grids = F.array(*[F.array(*[F.lit(float(c)) for c in r.grid]) for r in rules])
    tried = lists.select(stratum, "rule", "n_good", "h", F.posexplode(F.get(grids, F.col("rule"))).alias("step", "cutoff"))

    def rejected(kind: str) -> Column:
        return F.aggregate(F.col("h"), F.lit(0).cast("bigint"),
                           lambda total, x: total + F.when(x["first"] <= F.col("step"), x[kind]).otherwise(0))

    counts = tried.select(stratum, "rule", "step", "cutoff", "n_good", rejected("good").alias("n_lost"), rejected("bad").alias("n_caught"))
    passed = binomial_tail(F.col("n_good"), F.col("n_lost"), risk / len(rules)) <= error / chains
    in_turn = Window.partitionBy(stratum, "rule").orderBy("step")
    gain = F.col("n_caught") - F.col("n_lost")
    best = Window.partitionBy(stratum, "rule").orderBy(F.desc("gain"), "step")
    return (counts.withColumn("certified", F.min(passed.cast("int")).over(in_turn.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("gain", gain).where("certified = 1 AND gain > 0")
            .withColumn("place", F.row_number().over(best)).where("place = 1")
            .select(stratum, "rule", "cutoff", "n_good", "n_lost", "n_caught"))


def _with_cutoffs(rows: DataFrame, cutoffs: DataFrame, stratum: str, n_rules: int) -> DataFrame:
    """``rows`` with one column of cutoffs, a number or null for each rule."""
    wide = stored(cutoffs.groupBy(stratum).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("m"))
                  .select(stratum, F.transform(F.sequence(F.lit(0), F.lit(n_rules - 1)), lambda i: F.col("m")[i]).alias("_cutoffs")), "cutoffs")
    if wide.count() <= STRATA:
        return rows.join(F.broadcast(wide), stratum, "left")
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS))
    spread = wide.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return rows.withColumn("_salt", salt).join(spread, [stratum, "_salt"], "left").drop("_salt")


def judge_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: Sequence[Rule] = RULES,
                    risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per document: its statistics, ``base_failed`` (too few words, or too
    many repeated), ``kept``, and ``rejected_by``, the rules above their cutoff
    in its stratum (for documents that passed the base rules), comma-joined.

    Null and empty texts have no words and fail. A null stratum is a stratum
    of its own. A null doc_id has no label. Rows of a repeated doc_id are
    judged one by one and share the label; an id with several labels counts as
    good if one says so. Where a stratum has too few labelled documents for a
    certified cutoff, the rule rejects nothing there. Empty labels leave the
    base rules; an empty table gives no rows; other columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("_stratum")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key, "text")
    counted = stored(with_statistics(texts).drop("text").withColumn("base_failed", base_failed()), "statistics")
    cutoffs = certified_cutoffs(counted.where("NOT base_failed"), labels, "_stratum", rules, risk, error)
    known = _with_cutoffs(counted, cutoffs, "_stratum", len(rules))
    # the base rules come first: they leave no divisor that is zero
    over = [F.when(F.expr(r.value) > F.get(F.col("_cutoffs"), F.lit(i)), F.lit(r.name)) for i, r in enumerate(rules)]
    rejected = F.when(F.col("base_failed"), F.lit("")).otherwise(F.array_join(F.array_compact(F.array(*over)), ","))
    return known.withColumn("rejected_by", rejected).select(
        "doc_id", *[c for c in STATISTICS if c != "n_lines"], "base_failed",
        (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")


def _sql_values() -> str:
    return " UNION ALL ".join(f"SELECT stratum, doc_id, {i} AS rule, {r.value} AS v FROM passed" for i, r in enumerate(RULES))


QUALITY_RULES_SQL = f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM texts, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i) g),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) x WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) o GROUP BY r),
counted AS MATERIALIZED (
  SELECT r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{_SYMBOL}')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
  FROM texts LEFT JOIN covered USING (r)),
judged AS MATERIALIZED (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted),
passed AS (SELECT * FROM judged WHERE NOT base_failed),
marked AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
grid AS (SELECT rule, unnest(cutoffs) AS cutoff, generate_subscripts(cutoffs, 1) AS step FROM
  (VALUES {', '.join(f"({i}, {[float(c) for c in r.grid]})" for i, r in enumerate(RULES))}) g(rule, cutoffs)),
known AS MATERIALIZED (SELECT stratum, rule, v, good FROM ({_sql_values()}) x JOIN marked USING (doc_id)),
tried AS (
  SELECT stratum, rule, step, cutoff, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND v > cutoff) AS k,
    count(*) FILTER (WHERE NOT good AND v > cutoff) AS caught
  FROM known JOIN grid USING (rule) GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k >= n * {RISK / len(RULES)!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
    - lgamma(n - i + 1) + i * ln({RISK / len(RULES)!r}) + (n - i) * ln(1 - {RISK / len(RULES)!r})))) END AS tail FROM tried),
certified AS (
  SELECT *, caught - k AS gain, bool_and(tail <= {ERROR!r} / ((SELECT count(DISTINCT stratum) FROM known) * {len(RULES)}))
    OVER (PARTITION BY stratum, rule ORDER BY step ROWS UNBOUNDED PRECEDING) AS ok FROM tails),
cutoffs AS (
  SELECT stratum, rule, cutoff FROM (SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, step) AS place
    FROM certified WHERE ok AND gain > 0) x WHERE place = 1),
values_of AS ({_sql_values().replace('SELECT stratum, doc_id,', 'SELECT r, stratum,')}),
rejected AS (SELECT r, string_agg(name, ',' ORDER BY rule) AS names FROM values_of JOIN cutoffs USING (stratum, rule)
  JOIN (VALUES {', '.join(f"({i}, '{r.name}')" for i, r in enumerate(RULES))}) m(rule, name) USING (rule) WHERE v > cutoff GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND names IS NULL AS kept,
  coalesce(names, '') AS rejected_by
FROM judged LEFT JOIN rejected USING (r)"""
