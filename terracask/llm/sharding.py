"""Operator 4: sharding by jump consistent hashing (Lamping and Veach, 2014).

A key's walk over ever higher shard numbers depends on the key alone; with n shards the
key lives at the last stop below n. So adding a shard moves about 1/(n+1) of the keys,
all of them into the new shard, and there is no ring table to keep.

Defined cases: a null key is treated as key 0; keys that are not integers are taken by
their xxhash64; repeated rows go to one shard but get slots of their own; slots follow
the order of the key (nulls first; keys that are not integers by their xxhash64), then of
the tie columns; an empty table gives an empty result. Extra columns are carried along and
keep their values: an output whose name is taken gets underscores behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import expanded, fresh, hot_keys, range_bounds, shuffle_width, table, with_bucket

SHARDS = 16
#: Fixed value of the published generator: its multiplier, in 16- and 32-bit limbs below.
MULTIPLIER = 2862933555777941757
#: Parts that the rows of one hot key are numbered in.
TIE_PARTS = 64


def jump_hash(key: Column, shards: list[int]) -> Column:
    """An array with the shard of ``key`` (bigint) for each shard count, from one walk.

    64-bit products are put together from limbs, as ANSI arithmetic doesn't wrap.
    """
    high, low = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
    c3, c2, c1, c0 = high >> 16, high & 0xFFFF, low >> 16, low & 0xFFFF
    m32, m16 = 0xFFFFFFFF, 0xFFFF
    most = max(shards)

    def limb(x: Column, upper: int, lower: int) -> Column:  # x * (upper:lower) modulo 2**32
        return (x * lower).bitwiseAND(F.lit(m32)) + F.shiftleft((x * upper).bitwiseAND(F.lit(m16)), 16)

    def step(s: Column, _: Column) -> Column:
        hi, lo, j = s["hi"], s["lo"], s["j"]
        low_sum = (lo * c0).bitwiseAND(F.lit(m32)) + F.shiftleft((lo * c1).bitwiseAND(F.lit(m16)), 16) + 1
        new_lo = low_sum.bitwiseAND(F.lit(m32))
        new_hi = (
            F.shiftright(lo * c0, 32) + F.shiftright(lo * c1, 16) + F.shiftright(low_sum, 32) + limb(hi, c1, c0) + limb(lo, c3, c2)
        ).bitwiseAND(F.lit(m32))
        draw = F.shiftright(new_hi, 1) + 1  # the upper 31 bits, plus 1
        jumped = F.least(F.floor((j + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double"))), F.lit(1 << 40)).cast("bigint")
        done = j >= most
        return F.struct(
            F.when(done, hi).otherwise(new_hi).alias("hi"),
            F.when(done, lo).otherwise(new_lo).alias("lo"),
            F.when(done, j).otherwise(jumped).alias("j"),
            F.transform(
                F.arrays_zip(s["at"].alias("at"), F.array(*map(F.lit, shards)).alias("n")),
                lambda x: F.when(j < x["n"], j).otherwise(x["at"]),
            ).alias("at"),
        )

    start = F.struct(
        F.shiftright(key, 32).bitwiseAND(F.lit(m32)).alias("hi"),
        key.bitwiseAND(F.lit(m32)).alias("lo"),
        F.lit(0).cast("bigint").alias("j"),
        F.array(*(F.lit(0).cast("bigint") for _ in shards)).alias("at"),
    )
    # The walk starts at shard 0 and rises at each step, so it ends within ``most`` steps.
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)["at"]


def key_of(df: DataFrame, key: str) -> Column:
    """The key as bigint, null as it is."""
    kind = df.schema[key].dataType.simpleString()
    whole = F.col(key).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(F.col(key))
    return F.when(F.col(key).isNotNull(), whole)


def with_slots(df: DataFrame, group: str, key: str, ties: list[str], out: str) -> DataFrame:
    """Adds ``out``: gapless numbers from 0 within each ``group`` (never null), in ``key`` order.

    For slim rows: equal ones are counted first and numbered as one, so they may be any share
    of the table. The counted rows are numbered within (group, key range); the ranges' counts,
    a small table, give each range its first number. A key so frequent that it fills ranges by
    itself is split by the first of ``ties``, a hash spread over [0, 2**32).
    """
    spark = df.sparkSession
    order, range_, part, n, before, start, copy, row_start = (fresh(df, c) for c in ("__order", "__range", "__part", "__n", "__before", "__start", "__copy", "__row"))
    ordered = df.withColumn(order, key_of(df, key))
    bounds = range_bounds(ordered, order, 2 * shuffle_width(spark))
    hot = hot_keys(bounds)
    counted = ordered.groupBy(*ordered.columns).agg(F.count(F.lit(1)).alias(n))
    dealt = with_bucket(counted, order, bounds, range_)
    # Within a range whose lower end is a hot key, that key comes first.
    is_hot = F.coalesce(F.col(order).cast("double").isin(hot), F.lit(False)) if hot else F.lit(False)
    split = F.floor(F.coalesce(F.col(ties[0]), F.lit(0)) * TIE_PARTS / (1 << 32))
    dealt = dealt.withColumn(part, F.when(is_hot | F.col(order).isNull(), split).otherwise(F.lit(TIE_PARTS)).cast("int"))
    parts = [group, range_, part]
    counts = dealt.groupBy(*parts).agg(F.sum(n).alias(n))
    earlier = Window.partitionBy(group).orderBy(range_, part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*parts, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(start))
    rest = [c for c in df.columns if c not in (*ties, group)]
    within = Window.partitionBy(*parts).orderBy(*(F.col(c).asc_nulls_first() for c in (order, *ties, *rest))).rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.withColumn(before, F.coalesce(F.sum(n).over(within), F.lit(0)))
    placed = numbered.join(starts, parts).withColumn(row_start, F.col(start) + F.col(before))
    slot = (F.col(row_start) + F.col(copy)).cast("bigint").alias(fresh(df, out))
    return expanded(placed.select(*df.columns, n, row_start), n, copy).select(*df.columns, slot)


def shard(df: DataFrame, key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``df`` with ``shard``, its shard, and ``grown_shard``, that with one shard more."""
    both = fresh(df, "__both")
    walked = df.withColumn(both, jump_hash(F.coalesce(key_of(df, key), F.lit(0).cast("bigint")), [shards, shards + 1]))
    names = fresh(df, "shard"), fresh(df, "grown_shard")
    return walked.withColumns({n: F.col(both)[i].cast("int") for i, n in enumerate(names)}).drop(both)


def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by their id."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = with_slots(shard(docs), "shard", "doc_id", ["text_crc32", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


OP4_SQL = f"""
WITH RECURSIVE walk AS (
  SELECT doc_id, coalesce(text, '') AS t, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS k,
    0::BIGINT AS j, 0::BIGINT AS a, 0::BIGINT AS g, row_number() OVER () AS rid
  FROM documents
  UNION ALL
  SELECT doc_id, t, nk, least(floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((nk // 8589934592) + 1)::DOUBLE)), 1e12)::BIGINT,
    CASE WHEN j < {SHARDS} THEN j ELSE a END, CASE WHEN j < {SHARDS + 1} THEN j ELSE g END, rid
  FROM (SELECT *, ((((k // 4294967296) * {MULTIPLIER}::HUGEINT % 4294967296) * 4294967296 + (k % 4294967296) * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616)::HUGEINT AS nk
        FROM walk WHERE j < {SHARDS + 1})),
placed AS (
  SELECT rid, doc_id, t, max(a) AS shard, max(g) AS grown_shard FROM walk GROUP BY rid, doc_id, t),
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS lut),
summed AS (
  SELECT rid, doc_id, shard, grown_shard, strlen(t) + 1 AS size,
    xor(list_reduce(list_transform(range(1, 2 * strlen(t) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
                    lambda c, b: xor(c >> 8, lut[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) AS crc
  FROM (SELECT *, hex(encode(t)) AS h FROM placed), crc_table)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, crc, size) - 1)::BIGINT AS slot,
  grown_shard::INTEGER AS grown_shard
FROM summed
"""

QUERIES = {"op4_jump_sharding": op4_jump_sharding}
SQL = {"op4_jump_sharding": OP4_SQL}
