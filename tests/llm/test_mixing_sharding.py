import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terracask.llm import common, mixing, sharding

from .conftest import write


def corpus(make):
    rows = [(i, "w " * (5 + i % 7) + "end", "en", "big" if i % 4 else f"small{i % 3}", None) for i in range(400)]
    return make(rows)


def test_mix_meets_weights_and_budgets(make):
    docs = corpus(make)
    out = mixing.mix(docs).collect()
    total = sum(r["tokens"] for r in docs.withColumn("tokens", mixing.token_count(F.col("text"))).collect())
    by, weights = Counter(), {}
    for r in out:
        by[r["source"]] += r["tokens"]
        weights[r["source"]] = r["weight"]
    assert math.isclose(sum(weights.values()), 1)
    for s, w in weights.items():
        assert w * total - 1 <= by[s] <= w * total + 12
    entropy = -sum(w * math.log(w) for w in weights.values())
    assert entropy >= mixing.ENTROPY_SHARE * math.log(len(weights)) - 1e-9
    for (doc, epoch), n in Counter((r["doc_id"], r["epoch"]) for r in out).items():
        assert n == 1


def test_repetition_limit_wins(make):
    docs = corpus(make)
    sized = docs.withColumn("tokens", mixing.token_count(F.col("text")))
    loose = mixing.source_weights(sized, entropy_share=1.0, max_repeats=100.0).collect()
    tight = mixing.source_weights(sized, entropy_share=1.0, max_repeats=1.5).collect()
    assert len({round(r["weight"], 9) for r in loose}) == 1
    assert max(r["source_budget"] / r["source_tokens"] for r in tight) <= 1.5 + 1e-6
    assert tight[0]["exponent"] > loose[0]["exponent"] == 0


CLASHES = ("tokens", "weight", "epoch", "start", "block", "place", "source_tokens", "source_budget", "exponent", "key", "rank", "n", "copy", "digest", "named", "__part", "__sum")


def test_mix_of_odd_rows(make, odd_docs):
    clashing = odd_docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    out = mixing.mix(clashing).collect()
    assert {r["doc_id"] for r in out} <= {1, 2, 3, None, -5, 7, 8}
    assert out and all(r[c] == f"own {c}" for r in out for c in CLASHES) and {"tokens_", "place_"} <= set(out[0].asDict())
    assert mixing.mix(make([])).count() == 0


def brute_layout(rows):
    """(doc_id, source, tokens, epoch, start, block, place) of the mixture, in plain Python."""
    import hashlib
    from itertools import groupby

    def draw(*parts):
        return int(hashlib.md5("|".join(str(p) for p in parts if p is not None).encode()).hexdigest()[:8], 16)

    docs = [(d, s, 0 if not t else sum(t.count(c) for c in " \n\t") + 1, hashlib.md5((t or "").encode()).hexdigest()) for d, t, s in rows]
    totals = Counter()
    for _, s, n, _ in docs:
        totals[s] += n
    totals = {s: n for s, n in totals.items() if n}
    whole = sum(totals.values())

    def tilt(k):
        w = {s: (n / whole) ** (k / mixing.STEPS) for s, n in totals.items()}
        z = sum(w.values())
        return {s: x / z for s, x in w.items()}

    def entropy(k):
        return -sum(x * math.log(x) for x in tilt(k).values())

    lo, hi = 0, mixing.STEPS  # the largest exponent that reaches the entropy
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if entropy(mid) >= mixing.ENTROPY_SHARE * math.log(len(totals)) else (lo, mid - 1)
    k = next(k for k in range(lo, mixing.STEPS + 1) if max(x * whole / totals[s] for s, x in tilt(k).items()) <= mixing.MAX_REPEATS or k == mixing.STEPS)
    out = []
    blocks = max(math.ceil(whole / mixing.BLOCK_TOKENS), 1)
    for s, weight in tilt(k).items():
        budget = math.floor(weight * whole)
        at = epoch = 0
        while at < budget:
            own = sorted((draw(mixing.SEED, epoch, d, h), d is not None, d or 0, h, n) for d, x, n, h in docs if x == s)
            for _, known, d, h, n in own:
                if at < budget:
                    out.append((d if known else None, s, n, epoch, at, math.floor(at / budget * blocks)))
                at += n
            epoch += 1
    order = sorted(out, key=lambda r: (r[5], draw(mixing.SEED, "place", r[5], r[1], r[0], r[3], r[4])))
    return [(*r, i) for _, group in groupby(order, key=lambda r: r[5]) for i, r in enumerate(group)]


def test_layout_against_brute_force(make, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(common, "COPIES_AT_ONCE", 7)
    rows = [(i, "w " * (i % 9) + "end", "big" if i % 4 else f"small{i % 3}") for i in range(300)]
    rows += [(None, f"no id {i % 20} here", None) for i in range(60)] + [(7, "again and again", "small1")] * 30 + [(500, None, "small0"), (501, "", "empty")]
    docs = make([(d, t, None, s, None) for d, t, s in rows])
    got = mixing.layout(docs, "doc_id", "source", "text", block_tokens=300).collect()
    assert Counter((r["key"], r["source"], r["tokens"], r["epoch"], r["start"], r["block"], r["place"]) for r in got) == Counter(brute_layout(rows))
    mixed = mixing.mix(docs, block_tokens=300).collect()
    assert Counter((r["doc_id"], r["source"], r["tokens"], r["epoch"], r["start"], r["block"], r["place"]) for r in mixed) == Counter(brute_layout(rows))
    assert all(r["tokens"] == (0 if not r["text"] else len(r["text"].split(" "))) for r in mixed)


def reference_jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 100])
def test_jump_hash(spark, shards):
    keys = [0, 1, -1, 12345678901234, -(1 << 63), (1 << 63) - 1, *range(50)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", sharding.jump_hash(F.col("k"), [shards, shards + 1]).alias("s"))
    for r in df.collect():
        assert list(r["s"]) == [reference_jump(r["k"], shards), reference_jump(r["k"], shards + 1)]
        assert r["s"][1] in (r["s"][0], shards)


def test_slots_are_gapless_on_odd_rows(spark, make, odd_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "COPIES_AT_ONCE", 40)
    many = odd_docs.unionByName(make([(42, "same", None, None, None)] * 300 + [(43, f"text {i}", None, None, None) for i in range(300)] + [(None, f"t {i % 150}", None, None, None) for i in range(300)]))
    rows = sharding.op4_jump_sharding(spark, write(spark, tmp_path, documents=many)).collect()
    assert len(rows) == many.count()
    for s in {r["shard"] for r in rows}:
        own = sorted((r for r in rows if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        order = [(r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"]) for r in own]
        assert order == sorted(order)
    assert len({r["shard"] for r in rows if r["doc_id"] == 42}) == 1


def test_empty_table_and_other_keys(spark, make, tmp_path):
    assert sharding.op4_jump_sharding(spark, write(spark, tmp_path, documents=make([]))).count() == 0
    named = sharding.shard(spark.createDataFrame([(f"k{i % 50}", i % 20) for i in range(200)] + [(None, 3)], "id string, shard int"), "id")
    assert named.columns == ["id", "shard", "shard_", "grown_shard"]
    slots = sharding.with_slots(named, "shard_", "id", ["shard"], "slot").collect()
    assert len(slots) == 201
    for s in {r["shard_"] for r in slots}:
        assert sorted(r["slot"] for r in slots if r["shard_"] == s) == list(range(sum(r["shard_"] == s for r in slots)))
