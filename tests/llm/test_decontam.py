import random
import re

from terracask.llm import decontam

ITEMS = "item_id bigint, text string"


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, threshold):
    out = set()
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            k = min(5, len(v))
            if not k:
                continue
            want = {tuple(v[a : a + k]) for a in range(len(v) - k + 1)}
            have = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)}
            if len(want & have) >= threshold * len(want):
                out.add((d, i, len(want), len(want & have)))
    return out


def case():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 20, 31, 33, 60, 130])]
    items += [(50, None), (51, ""), (None, "alpha beta gamma delta epsilon zeta"), (52, "ALPHA, beta; gamma!"), (5, items[5][1])]
    docs = []
    for d in range(60):
        text = [draw.choice(vocabulary) for _ in range(draw.choice((3, 40, 400)))]
        if d % 3:
            item = words(draw.choice(items)[1])
            for _ in range(d % 4):
                if item:
                    item[draw.randrange(len(item))] = "changed"
            at = draw.randrange(len(text))
            text[at:at] = item
        docs.append((d, ("  " if d % 2 else " , ").join(text)))
    docs += [(100, None), (101, ""), (None, "x Alpha-Beta gamma delta EPSILON zeta y"), (7, docs[7][1])]
    return docs, items


def classes(items):
    """Smallest id and number of the items with the same words."""
    out = {}
    for i, t in items:
        if words(t):
            known, n = out.get(tuple(words(t)), (None, 0))
            out[tuple(words(t))] = (min((x for x in (known, i) if x is not None), default=None), n + 1)
    return out


def test_against_brute_force(spark):
    docs, items = case()
    items += [(i + 1000, t.upper() + " !") for i, t in items[:6]] * 3
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEMS)
    found = classes(items)
    want = brute(docs, [(i, " ".join(w)) for w, (i, _) in found.items()], 0.8)
    for size in (decontam.BLOCK_SHINGLES, 100):  # one pass, and several blocks of items
        got = decontam.find_leaks(a, b, block_shingles=size).collect()
        assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["shared"]) for r in got} == want and len(got) == len(want)
        assert all((r["item_id"], r["n_items"]) in found.values() for r in got)
    assert want
    members = {(r["item_id"], r["class_id"]) for r in decontam.item_classes(b).collect()}
    assert members == {(i, found[tuple(words(t))][0]) for i, t in items if words(t)}


def test_drop_judges_rows_and_keeps_clashing_columns(spark):
    docs, items = case()
    docs.append((1, "clean text under a used id"))
    schema = "doc_id bigint, text string, item_id int, containment int, words string, n_items array<int>"
    a = spark.createDataFrame([(i, t, 1, 2, "w", [3]) for i, t in docs], schema)
    for size in (decontam.BLOCK_SHINGLES, 100):
        left = decontam.drop_leaks(a, spark.createDataFrame(items, ITEMS), block_shingles=size)
        want = [(d, t) for d, t in docs if not brute([(0, t)], items, 0.8)]
        assert left.columns == a.columns and sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted(want, key=repr)
        assert all((r["item_id"], r["words"], r["n_items"]) == (1, "w", [3]) for r in left.collect())


def test_empty_tables(spark):
    docs, items = case()
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert decontam.find_leaks(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontam.find_leaks(spark.createDataFrame(docs, none.schema), spark.createDataFrame([], ITEMS)).count() == 0
