"""Operator 3: mixing sources to target weights by temperature.

A source's token share p becomes the weight p**a / sum(p**a). The exponent a, in steps of
1/65536 from 0 (uniform) to 1 (as it is), is bisected twice: it is the largest one with
which the weights' entropy reaches ``entropy_share`` of the maximum, or, if higher, the
smallest one with which no source is passed over more than ``max_repeats`` times. A pass over
the sources' totals tries 256 exponents at once, so two passes do for the sixteen halvings. The
weights times the token budget are the sources' budgets. A source is laid out as one
hash-ordered permutation of its documents after another, a new one per pass (epoch), until
its budget is met; a document counts if it begins within the budget. The mixture is cut
into blocks of about ``block_tokens`` tokens, each with every source at its weight: a
document's block follows from how far into its source's budget it begins. A block's documents
of all sources are put into one hash-ordered permutation, ``place`` being a document's number
in it; blocks in order, and places in them, are the order of the mixture.

Tokens are counted as white space separated words: spaces, tabs and line breaks plus one,
in texts that are not empty.

Only keys, counts and hashes are laid out; texts meet their places at last, in one shuffle.
Running sums never stand in one task: rows are dealt out by source, epoch and hash range,
and the ranges' totals give each its start, so a source with a third of all rows is split. The
hash takes key and text, so rows that share a key (or have none) are split as well; rows that
are equal in everything are counted first and laid out as one.

Defined cases: null source is a source of its own; empty or null text has no tokens and
is laid out but moves nothing; sources without any token have weight 0 and yield no rows;
ties in the hash are ordered by key, text hash and tokens, repeated rows follow each other; an
empty table gives an empty result; extra columns are carried along and keep their values: an
output whose name is taken gets underscores behind it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint_root, expanded, fresh, shuffle_width, table

STEPS = 1 << 16
ENTROPY_SHARE = 0.98
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 16
SEED = 3
#: Sources up to which the table of weights is broadcast; beyond it, a shuffled join.
BROADCAST_SOURCES = 10_000


def token_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    bare = text
    for space in (" ", "\n", "\t"):
        bare = F.replace(bare, F.lit(space), F.lit(""))
    return F.when(text == "", F.lit(0)).otherwise(F.length(text) - F.length(bare) + 1).cast("bigint")


def _tried(totals: DataFrame, total: int, exponents: list[int]) -> dict[int, tuple[float, float, float]]:
    """For each exponent k (in steps): the sum z of the tilted shares, their entropy and the worst
    ratio of weight to share. One aggregate over the sources; a row per exponent comes back."""
    p, a = F.col("t") / F.lit(float(total)), F.col("k") / F.lit(float(STEPS))
    each = totals.select("t", F.explode(F.array(*map(F.lit, exponents))).alias("k"))
    sums = each.groupBy("k").agg(F.sum(F.pow(p, a)).alias("z"), F.sum(F.pow(p, a) * F.ln(p)).alias("tilt"), F.max(F.pow(p, a - 1)).alias("worst"))
    rows = sums.select("k", "z", F.ln("z") - a * F.col("tilt") / F.col("z"), F.col("worst") / F.col("z")).collect()
    return {r[0]: (r[1], r[2], r[3]) for r in rows}


def _exponent(totals: DataFrame, total: int, sources: int, passes: float, entropy_share: float, max_repeats: float) -> tuple[int, float]:
    """The exponent in steps, and its sum of tilted shares. Entropy and repeats fall as it rises."""
    least = entropy_share * math.log(sources)
    tests = (lambda x: x[1] >= least, lambda x: passes * x[2] > max_repeats)
    stride = 1 << 8
    found = _tried(totals, total, list(range(0, STEPS + 1, stride)))

    def last(test) -> int:
        return max((k for k, x in found.items() if test(x)), default=-1)

    starts = [last(t) for t in tests]
    fine = sorted({k for s in starts if s >= 0 for k in range(s, min(s + stride, STEPS) + 1)} - set(found))
    found |= _tried(totals, total, fine) if fine else {}
    by_entropy, over = (last(t) for t in tests)
    k = max(by_entropy, min(over + 1, STEPS) if over >= 0 else 0, 0)
    if k not in found:
        found |= _tried(totals, total, [k])
    return k, found[k][0]


WEIGHTS = "source_tokens bigint, weight double, exponent double, source_budget bigint, mixture_budget bigint"


def source_weights(
    docs: DataFrame,
    source: str = "source",
    tokens: str = "tokens",
    entropy_share: float = ENTROPY_SHARE,
    max_repeats: float = MAX_REPEATS,
    budget: int | None = None,
) -> DataFrame:
    """Per source: ``source_tokens``, ``weight``, ``exponent``, ``source_budget`` and ``mixture_budget``.

    ``budget``: tokens of the mixture, as many as there are if not given.
    """
    checkpoint_root(docs.sparkSession)
    totals = docs.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("t")).where("t > 0").checkpoint()
    total, sources = totals.agg(F.sum("t"), F.count(F.lit(1))).first()
    if not sources:
        return totals.select("source", *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in WEIGHTS.split(", ")))
    budget = budget or total
    k, z = _exponent(totals, total, sources, budget / total, entropy_share, max_repeats)
    weight = F.pow(F.col("t") / F.lit(float(total)), F.lit(k / STEPS)) / F.lit(z)
    return totals.select(
        "source",
        F.col("t").alias("source_tokens"),
        weight.alias("weight"),
        F.lit(k / STEPS).alias("exponent"),
        F.floor(weight * budget).cast("bigint").alias("source_budget"),
        F.lit(budget).cast("bigint").alias("mixture_budget"),
    )


def _draw(*parts: Column | int | str) -> Column:
    """32 bits of a hash of the parts, nulls left out."""
    listed = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *listed)), 1, 8), 16, 10).cast("bigint")


def _sums_before(df: DataFrame, groups: list[str], rank: str, ties: list[str], value: str, width: int, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the group's earlier rows by ``rank``, which is spread
    over [0, 2**32), and ``ties``. Rows are dealt out by group and range of ranks."""
    dealt = df.withColumn("__part", F.floor(F.col(rank) * width / (1 << 32)).cast("int"))
    parts = [*groups, "__part"]
    sums = dealt.groupBy(*parts).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*parts, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    own = Window.partitionBy(*parts).orderBy(rank, *ties).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return summed.join(starts, parts).withColumn(out, F.col("__start") + F.col("__own")).drop("__part", "__start", "__own")


def layout(docs: DataFrame, key: str, source: str, text: str, seed: int = SEED, block_tokens: int = BLOCK_TOKENS, carry: tuple[str, ...] = (), **target) -> DataFrame:
    """(key, source, tokens, weight, epoch, start, block, place, and ``carry``): a row per document and
    pass, without its text. ``carry``: hashes by which the caller finds the rows again."""
    spark = docs.sparkSession
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    slim = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), token_count(F.col(text)).alias("tokens"), digest.alias("digest"), *(F.col(c).alias(f"carried{i}") for i, c in enumerate(carry))
    )
    carried = [f"carried{i}" for i in range(len(carry))]
    weights, few = _counted(source_weights(slim, **target))
    weights = weights.withColumnRenamed("source", "weighed")
    counted = slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(F.broadcast(weights) if few else weights, F.col("source").eqNullSafe(F.col("weighed"))).drop("weighed")
    passes = F.expr("sequence(0, cast(greatest(ceil(source_budget / cast(source_tokens as double)), 1) - 1 as int))")
    laid = joined.where("source_budget > 0").withColumn("epoch", F.explode(passes))
    # a null source as a value, so that groups join and shuffle by plain equality
    laid = laid.withColumns({"named": F.coalesce(F.col("source").cast("string"), F.lit("")), "unnamed": F.col("source").isNull()})
    laid = laid.withColumns({"rank": _draw(seed, F.col("epoch"), F.col("key"), F.col("digest")), "held": F.col("tokens") * F.col("n")})
    placed = _sums_before(laid, ["named", "unnamed", "epoch"], "rank", ["key", "digest", "tokens", *carried], "held", 4 * shuffle_width(spark), "before")
    each = expanded(placed.where("epoch * source_tokens + before < source_budget"), "n", "copy")
    each = each.withColumn("start", F.expr("epoch * source_tokens + before + copy * tokens")).where("start < source_budget")
    blocks = f"greatest(ceil(mixture_budget / {float(block_tokens)}D), 1)"
    each = each.withColumn("block", F.expr(f"cast(floor(cast(start as double) / source_budget * {blocks}) as bigint)"))
    each = each.select("key", "source", "tokens", "weight", "epoch", "start", "block", *carried).withColumn("one", F.lit(1))
    each = each.withColumn("rank", _draw(seed, "place", *(F.col(c) for c in ("block", "source", "key", "epoch", "start"))))
    done = _sums_before(each, ["block"], "rank", ["source", "key", "epoch", "start", "tokens", *carried], "one", shuffle_width(spark), "place")
    return done.select("key", "source", "tokens", "weight", "epoch", "start", "block", F.col("place").cast("bigint").alias("place"), *(F.col(c).alias(n) for c, n in zip(carried, carry)))


OUTPUTS = ("tokens", "weight", "epoch", "start", "block", "place")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, block_tokens: int = BLOCK_TOKENS, **target) -> DataFrame:
    """The mixture: documents with ``tokens``, ``weight``, ``epoch``, ``start`` (tokens of
    the source's layout before it), ``block`` and ``place``; a document has a row per pass."""
    one, two = fresh(docs, "__hash1"), fresh(docs, "__hash2")
    hashed = docs.withColumns({name: F.xxhash64(F.lit(i), *(F.col(c) for c in docs.columns)) for i, name in enumerate((one, two))})
    laid = layout(hashed, key, source, text, seed, block_tokens, (one, two), **target)
    laid = laid.select(one, two, *(F.col(c).alias(fresh(docs, c)) for c in OUTPUTS))
    repeated = hashed.groupBy(one, two).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(one, two).checkpoint()
    if repeated.limit(1).count():  # equal rows are laid out as one, so one of them meets all places
        twins = hashed.join(repeated, [one, two], "left_semi").dropDuplicates([one, two])
        hashed = hashed.join(repeated, [one, two], "left_anti").unionByName(twins)
    return hashed.join(laid, [one, two]).drop(one, two)


def _counted(weights: DataFrame) -> tuple[DataFrame, bool]:
    """The weights, and whether they are few enough to be broadcast."""
    return weights, weights.count() <= BROADCAST_SOURCES


def op3_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents by source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    laid = layout(docs, "doc_id", "source", "text")
    return laid.select(F.col("key").alias("doc_id"), "source", "tokens", F.round("weight", 6).alias("weight"), "epoch", "start", "block", "place")


OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE
    length(text) - length(replace(replace(replace(text, ' ', ''), chr(10), ''), chr(9), '')) + 1 END::BIGINT AS tokens, md5(coalesce(text, '')) AS digest FROM documents),
t AS (SELECT source, sum(tokens)::BIGINT AS t FROM d GROUP BY source HAVING sum(tokens) > 0),
b AS (SELECT sum(t)::BIGINT AS total, count(*) AS n FROM t),
ks AS (
  SELECT k, ln(sum(pow(p, a))) - a * sum(pow(p, a) * ln(p)) / sum(pow(p, a)) AS h, max(pow(p, a - 1)) / sum(pow(p, a)) AS r, sum(pow(p, a)) AS z, any_value(n) AS n
  FROM (SELECT k, k / {float(STEPS)} AS a, t.t::DOUBLE / total AS p, n FROM range({STEPS + 1}) g(k), t, b) GROUP BY k, a),
best AS (
  SELECT greatest(
    coalesce(max(k) FILTER (h >= {ENTROPY_SHARE}::DOUBLE * ln(n)), 0),
    coalesce(least(max(k) FILTER (r > {MAX_REPEATS}::DOUBLE) + 1, {STEPS}), 0)) AS k FROM ks),
w AS (
  SELECT source, t.t, pow(t.t::DOUBLE / total, k / {float(STEPS)}) / z AS weight, total,
    floor(pow(t.t::DOUBLE / total, k / {float(STEPS)}) / z * total)::BIGINT AS budget
  FROM t, b, best JOIN ks USING (k)),
e AS (
  SELECT doc_id, d.source, tokens, digest, weight, t, budget, total, unnest(range(greatest(ceil(budget / t::DOUBLE), 1)::BIGINT)) AS epoch
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source WHERE budget > 0),
r AS (SELECT *, ('0x' || substr(md5(concat_ws('|', '{SEED}', epoch, doc_id, digest)), 1, 8))::BIGINT AS rank FROM e),
s AS (
  SELECT *, epoch * t + coalesce(sum(tokens) OVER (PARTITION BY source, epoch ORDER BY rank, doc_id, digest, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM r),
k AS (SELECT *, floor(start::DOUBLE / budget * greatest(ceil(total / {float(BLOCK_TOKENS)}), 1))::BIGINT AS block FROM s WHERE start < budget),
q AS (SELECT *, ('0x' || substr(md5(concat_ws('|', '{SEED}', 'place', block, source, doc_id, epoch, start::BIGINT)), 1, 8))::BIGINT AS place_rank FROM k)
SELECT doc_id, source, tokens, round(weight, 6) AS weight, epoch::INTEGER AS epoch, start::BIGINT AS start, block,
  (row_number() OVER (PARTITION BY block ORDER BY place_rank, source NULLS FIRST, doc_id NULLS FIRST, epoch, start, tokens) - 1)::BIGINT AS place
FROM q
"""

QUERIES = {"op3_temperature_mixing": op3_temperature_mixing}
SQL = {"op3_temperature_mixing": OP3_SQL}
