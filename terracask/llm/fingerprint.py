"""Operator 1: homomorphic multiset fingerprints of documents.

A text is a multiset of paragraphs (its non-empty lines). Each paragraph is
hashed to a wide vector, and the fingerprint is the sum of these vectors, lane by
lane, modulo a power of two:

* 8 equality lanes modulo 2**32: the eight words of the paragraph's SHA-256;
* 64 likeness lanes modulo 2**32: each clause of the paragraph (a part between full
  stops and commas) adds +1 or -1 to one lane, both chosen by its MD5. (A vector of the
  paragraph as a whole would tell nothing of a text of one paragraph after any edit.)

The sum doesn't depend on the order of paragraphs, and a paragraph is inserted or
deleted by adding or subtracting its vector (``combine``). The likeness lanes are a
random projection of the clause multiset, so 2<u,v>/(<u,u>+<v,v>) estimates how much
of two texts is the same; the standard error is about 0.18 of the part that differs.

The next document of each is found in ranges of ids, each sorted by itself. Ids that fill
ranges by themselves, and null, are split by the hash of the text, and their equal rows are
counted first, so no id or text may hold too many rows.

Defined cases: null text is the empty text; the empty text (and one of line breaks
only) has all lanes 0; two fingerprints whose likeness lanes are all 0 have likeness 1 if their
equality lanes are equal and 0 if not; repeated paragraphs count as often as they occur; rows of
one id (nulls last) follow each other by the MD5 of their texts, descending; the next of the
only row is itself; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .common import expanded, fresh, hot_keys, literal_rows, range_bounds, shuffle_width, table, with_bucket

EQUALITY_LANES = 8
LIKENESS_LANES = 64
MODULUS = 1 << 32
_HEX = "0123456789abcdef"
#: The code of the first of the 128 letters that stand for a lane and a sign.
_FIRST = 33


def _hashes(text: Column) -> tuple[Column, Column]:
    """A string with a letter for each clause (its lane and sign), and the paragraphs' SHA-256.

    Splitting at single characters keeps clear of the regular expression engine.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.replace(F.replace(text, F.lit("."), F.lit("\n")), F.lit(","), F.lit("\n"))
    clauses = F.filter(F.transform(F.split(lines, "\n", -1), lambda c: F.trim(c)), lambda c: c != "")

    def digit(m: Column, at: int) -> Column:
        return F.instr(F.lit(_HEX), F.substring(m, at, 1)) - 1

    def letter(m: Column) -> Column:  # 7 bits
        return F.char((digit(m, 1) * 16 + digit(m, 2)).bitwiseAND(F.lit(2 * LIKENESS_LANES - 1)) + _FIRST)

    letters = F.array_join(F.transform(F.transform(clauses, lambda c: F.md5(c)), letter), "")
    return letters, F.transform(F.filter(F.split(text, "\n", -1), lambda p: p != ""), lambda p: F.sha2(p, 256))


def _summed(letters: str, digests: str) -> Column:
    def count(letter: str) -> str:
        return f"(length({letters}) - length(replace({letters}, {letter}, '')))"

    plus, minus = count(f"char({_FIRST} + 2 * j)"), count(f"char({_FIRST + 1} + 2 * j)")
    likeness = f"transform(sequence(0, {LIKENESS_LANES - 1}), j -> pmod(cast({plus} - {minus} as bigint), {MODULUS}L))"
    equality = [
        f"aggregate({digests}, 0L, (a, x) -> (a + cast(conv(substring(x, {1 + 8 * k}, 8), 16, 10) as bigint)) & {MODULUS - 1}L)"
        for k in range(EQUALITY_LANES)
    ]
    return F.expr(f"concat({likeness}, array({', '.join(equality)}))")


def with_lanes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the lanes of ``text`` as array<bigint>: likeness, then equality lanes.

    Letters and digests are columns of their own (a struct would be taken apart and made
    anew for each lane)."""
    c, p = f"{out}__c", f"{out}__p"
    letters, digests = _hashes(F.col(text))
    return df.withColumns({c: letters, p: digests}).withColumn(out, _summed(f"`{c}`", f"`{p}`")).drop(c, p)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union of two multisets (or, with ``sign=-1``, of a's paragraphs without b's)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))


def as_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.hex(x))), "-")


def with_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds a likeness in [0, 1] for each pair of lane columns."""

    def signed(lanes: str) -> Column:
        half = MODULUS // 2
        return F.expr(f"transform(slice(`{lanes}`, 1, {LIKENESS_LANES}), c -> cast(if(c >= {half}L, c - {MODULUS}L, c) as double))")

    def dot(a: str, b: str) -> Column:
        return F.expr(f"aggregate(zip_with(`{a}__signed`, `{b}__signed`, (x, y) -> x * y), 0D, (s, x) -> s + x)")

    names = sorted({c for pair in pairs.values() for c in pair})
    wide = df.withColumns({f"{c}__signed": signed(c) for c in names})
    wide = wide.withColumns({f"{c}__square": dot(c, c) for c in names})
    wide = wide.withColumns({f"{out}__dot": dot(a, b) for out, (a, b) in pairs.items()})
    for out, (a, b) in pairs.items():
        whole = F.col(f"{a}__square") + F.col(f"{b}__square")
        same = F.slice(F.col(a), LIKENESS_LANES + 1, EQUALITY_LANES) == F.slice(F.col(b), LIKENESS_LANES + 1, EQUALITY_LANES)
        share = F.when(whole > 0, 2 * F.col(f"{out}__dot") / whole).otherwise(same.cast("double"))
        wide = wide.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))).drop(f"{out}__dot")
    return wide.drop(*(f"{c}__{k}" for c in names for k in ("signed", "square")))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with its texts' fingerprints; the rows stay where they are."""
    lanes = fresh(df, f"{out}__lanes")
    return with_lanes(df, text, lanes).withColumn(fresh(df, out), as_text(F.col(lanes))).drop(lanes)


# ------------------------------------------------------------------ next rows

#: Parts that the rows of one hot key are dealt out to.
PARTS = 64


def with_next(df: DataFrame, key: str, tie: str, carry: dict[str, str]) -> DataFrame:
    """Adds, for each ``carry`` item (new name: column), the value of the next row in
    descending ``key`` order (nulls last; then ``tie``, an MD5, descending); after the last
    comes the first.

    The rows are dealt out by key ranges, hot keys and null by ranges of ``tie`` too, each sorted
    by itself, and each range gets a copy of the first row of the one behind it, so that no task
    sees the whole table.
    """
    spark = df.sparkSession
    bounds = range_bounds(df, key, 4 * shuffle_width(spark))
    hot = hot_keys(bounds)
    bucket, part, n, ghost, copy = (fresh(df, c) for c in ("__bucket", "__part", "__n", "__ghost", "__copy"))
    value = F.col(key).cast("double")
    is_hot = (F.coalesce(value.isin(hot), F.lit(False)) if hot else F.lit(False)) | F.col(key).isNull()
    # Within a range a hot key is the lowest, and null is below all: both come last.
    at = F.floor((F.lit((1 << 32) - 1) - F.conv(F.substring(tie, 1, 8), 16, 10).cast("bigint")) * PARTS / (1 << 32))
    dealt = with_bucket(df, key, bounds, bucket).withColumn(part, F.when(is_hot, at).otherwise(F.lit(-1)).cast("int"))
    first = F.max(F.struct(F.col(key).alias("k"), F.col(tie).alias("t"))).alias("first")
    tops = sorted(dealt.groupBy(bucket, part).agg(first).collect(), key=lambda r: (-r[0], r[1]))  # a row per range
    kind = df.schema[key].dataType.simpleString()
    ghosts = [(r[0], r[1], after[2]["k"], after[2]["t"]) for r, after in zip(tops, tops[1:] + tops[:1])]
    links = literal_rows(spark, ghosts, f"__to_bucket int, __to_part int, __top {kind}, __tie string")
    most = 1
    if any(r[1] >= 0 for r in tops):
        equal = dealt.where(is_hot).groupBy(*dealt.columns).agg(F.count(F.lit(1)).alias(n))
        most = equal.agg(F.max(n)).first()[0]
        dealt = dealt.where(~is_hot).withColumn(n, F.lit(1).cast("bigint")).unionByName(equal)
    firsts = dealt.join(F.broadcast(links), F.col(key).eqNullSafe(F.col("__top")) & (F.col(tie) == F.col("__tie")))
    firsts = firsts.withColumns({bucket: F.col("__to_bucket"), part: F.col("__to_part")}).drop("__to_bucket", "__to_part", "__top", "__tie")
    both = dealt.withColumn(ghost, F.lit(0)).unionByName(firsts.withColumn(ghost, F.lit(1)))
    window = Window.partitionBy(bucket, part).orderBy(ghost, F.col(key).desc_nulls_last(), F.col(tie).desc())
    both = both.withColumns({new: F.lead(old).over(window) for new, old in carry.items()}).where(F.col(ghost) == 0).drop(ghost, bucket, part)
    if most == 1:
        return both.drop(n)
    # of equal rows each has its like behind it, but for the last
    each = expanded(both, n, copy) if most > common.COPIES_AT_ONCE else both.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)))
    return each.withColumns({new: F.when(F.col(copy) < F.col(n) - 1, F.col(old)).otherwise(F.col(new)) for new, old in carry.items()}).drop(n, copy)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    own = with_next(with_lanes(docs, "t", "own").withColumn("tie", F.md5("t")), "doc_id", "tie", {"next_t": "t", "next": "own"})
    own = own.withColumn("n_chars", F.length("t").cast("bigint")).withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    edited = own.withColumn("edited_t", F.expr("concat(substring(t, 1, cast(n_chars as int) - cut), substring(next_t, 1, cut))"))
    edited = with_lanes(edited.drop("next_t", "t", "tie"), "edited_t", "edited")
    near = with_likeness(edited, {"near_edited": ("own", "edited"), "near_next": ("own", "next")})
    return near.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_t", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        F.round("near_edited", 6).alias("near_edited"),
        F.round("near_next", 6).alias("near_next"),
    )


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (
  SELECT doc_id, t, length(t) AS n_chars,
    coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(t) DESC)),
e AS (SELECT *, substr(t, 1, n_chars - n_chars // 3) || substr(nt, 1, n_chars // 3) AS et FROM n),
x AS (SELECT doc_id, n_chars, et, unnest(['own', 'next', 'edited']) AS kind, unnest([t, nt, et]) AS u FROM e),
h AS (
  SELECT doc_id, n_chars, et, kind, list_filter(string_split(u, chr(10)), lambda c: c <> '') AS lines FROM x),
g AS (
  SELECT doc_id, n_chars, et, kind,
    list_transform(list_filter(list_transform(flatten(list_transform(lines, lambda p: string_split_regex(p, '[.,]'))), lambda c: trim(c)), lambda c: c <> ''),
                   lambda c: (('0x' || substr(md5(c), 1, 2))::BIGINT & {2 * LIKENESS_LANES - 1})) AS hs,
    list_transform(lines, lambda c: sha256(c)) AS ps
  FROM h),
v AS (
  SELECT doc_id, n_chars, et, kind,
    list_transform(range({LIKENESS_LANES}), lambda j: (len(list_filter(hs, lambda b: b = 2 * j)) - len(list_filter(hs, lambda b: b = 2 * j + 1)))::BIGINT) AS l,
    list_transform(range({EQUALITY_LANES}), lambda k: (coalesce(list_sum(list_transform(ps, lambda p: ('0x' || substr(p, (1 + 8 * k)::INT, 8))::BIGINT)), 0) % {MODULUS})::BIGINT) AS q
  FROM g),
s AS (
  SELECT doc_id, n_chars, et, kind,
    array_to_string(list_transform(list_concat(list_transform(l, lambda y: (y + {MODULUS}) % {MODULUS}), q), lambda y: printf('%x', y)), '-') AS fp,
    list_transform(l, lambda y: y::DOUBLE) AS z, q
  FROM v),
p AS (
  SELECT o.doc_id, o.n_chars, sha256(o.et) AS edited_sha256, o.fp AS fingerprint, e.fp AS edited_fingerprint,
    o.z AS oz, e.z AS ez, x.z AS xz, o.q = e.q AS same_e, o.q = x.q AS same_x
  FROM s o JOIN s e ON o.doc_id = e.doc_id AND e.kind = 'edited' JOIN s x ON o.doc_id = x.doc_id AND x.kind = 'next'
  WHERE o.kind = 'own'),
r AS (
  SELECT *, list_inner_product(oz, oz) AS oo, list_inner_product(ez, ez) AS ee, list_inner_product(xz, xz) AS xx,
    list_inner_product(oz, ez) AS oe, list_inner_product(oz, xz) AS ox FROM p)
SELECT doc_id, n_chars::BIGINT AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
  round(greatest(0, least(1, CASE WHEN oo + ee > 0 THEN 2 * oe / (oo + ee) ELSE same_e::INT END))::DOUBLE, 6) AS near_edited,
  round(greatest(0, least(1, CASE WHEN oo + xx > 0 THEN 2 * ox / (oo + xx) ELSE same_x::INT END))::DOUBLE, 6) AS near_next
FROM r
"""

QUERIES = {"op1_document_fingerprints": op1_document_fingerprints}
SQL = {"op1_document_fingerprints": OP1_SQL}
