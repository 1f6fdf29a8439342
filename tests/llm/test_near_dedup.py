from itertools import combinations

import numpy as np
import pyarrow as pa

from terracask.llm import near_dedup as nd
from terracask.llm import shingles as S
from terracask.llm.components import components


def shingle_set(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def verdicts(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_against_brute_force(make, prose):
    rows = list(enumerate(prose))
    docs = make([(i, t, None, None, None) for i, t in rows])
    for percent in (80, 85):
        assert verdicts(nd.near_duplicates(docs, percent)) == brute(rows, percent)


def test_oversize_nodes_are_branched_and_blocked(make, prose, monkeypatch):
    rows = list(enumerate(prose))
    docs = make([(i, t, None, None, None) for i, t in rows])
    monkeypatch.setattr(nd, "NODE", 3)
    monkeypatch.setattr(nd, "BLOCK", 2)
    monkeypatch.setattr(nd, "ROUNDS", 1)
    assert verdicts(nd.near_duplicates(docs, 85)) == brute(rows, 85)


def look_alikes(pairs, changed=(140,)):
    """A text that is linked with nothing, and linked pairs that look much like it and like each other."""
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for k in range(pairs):
        left = [f"v{k}x{i}" if i in (20, 60, 100) else w for i, w in enumerate(base)]
        right = [f"u{k}x{i}" if i in changed else w for i, w in enumerate(left)]
        texts += [" ".join(left), " ".join(right)]
    return list(enumerate(texts))


def test_rows_of_one_block_meet_in_their_own_block_only(make, monkeypatch):
    rows = look_alikes(20)
    want = brute(rows, 85)
    assert len({c for _, c in want.values()}) == 21
    monkeypatch.setattr(nd, "NODE", 6)
    monkeypatch.setattr(nd, "BLOCK", 3)
    monkeypatch.setattr(nd, "ROUNDS", 0)
    assert verdicts(nd.near_duplicates(make([(i, t, None, None, None) for i, t in rows]), 85)) == want


def test_deep_nodes_keep_pairs_near_the_threshold(make, monkeypatch):
    rows = look_alikes(30, (125, 140))
    want = brute(rows, 85)
    assert len({c for _, c in want.values()}) == 31
    docs = make([(i, t, None, None, None) for i, t in rows])
    monkeypatch.setattr(nd, "NODE", 4)
    monkeypatch.setattr(nd, "BLOCK", 4)
    monkeypatch.setattr(nd, "ROUNDS", 3)
    assert verdicts(nd.near_duplicates(docs, 85)) == want
    monkeypatch.setattr(nd, "COPIES", 0)
    monkeypatch.setattr(nd, "ROUNDS", 1)
    assert verdicts(nd.near_duplicates(docs, 85)) == want


def test_branching_on_a_node_keeps_pairs_at_the_threshold():
    draw = np.random.default_rng(3)
    pairs = 400
    sig = np.repeat(draw.integers(0, 256, (pairs, nd.COORDINATES), dtype=np.uint8), 2, axis=0)
    sig[1::2] += (draw.random((pairs, nd.COORDINATES)) >= 0.85).astype(np.uint8)
    node = np.repeat(draw.integers(-(2**62), 2**62, pairs), 2)
    columns = [pa.array(node), pa.array(np.arange(2 * pairs)), pa.array(np.ones(2 * pairs, np.int64)), pa.array([x.tobytes() for x in sig], pa.binary())]
    children = pa.Table.from_batches(nd._branch(85)([pa.RecordBatch.from_arrays(columns, ["node", "id", "n", "sig"])]))
    met = {}
    for child, i in zip(children.column("node").to_pylist(), children.column("id").to_pylist()):
        met.setdefault((child, i // 2), set()).add(i)
    assert len({pair for (_, pair), who in met.items() if len(who) == 2}) >= 0.95 * pairs


def test_odd_rows(odd_docs):
    rows = nd.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_shingles"] == 0 and by[2]["component_id"] == 2 and by[2]["kept"]
    assert by[7]["n_shingles"] == 2 and by[1]["component_id"] == 1
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    left = nd.drop_near_duplicates(odd_docs.withColumnRenamed("n_chars", "kept"))
    assert left.columns[-1] == "kept" and left.where("doc_id = 1").count() == 1 and left.where("doc_id IS NULL").count() == 2


def test_empty_table(make):
    assert nd.near_duplicates(make([])).count() == 0


def test_words_are_split_at_ascii_space_only(make):
    docs = make([(1, "A B C D E F G", None, None, None), (2, "a b\tc\x0bd\x0ce f G", None, None, None), (3, "a b c d", None, None, None), (4, "A  b c D ", None, None, None)])
    assert verdicts(nd.near_duplicates(docs)) == {1: (2, 1), 2: (2, 1), 3: (1, 3), 4: (1, 3)}


def test_shingles_match_plain_sets():
    texts = ["", "one", "one two", "a b c d e", "a b c d e f a b c d e f a b c d e", "x" * 2_000_000 + " y z", None]
    hashes, at = S.words(*S.text_bytes(pa.array(texts)), S.WHITESPACE)
    values, offsets = S.distinct(*S.shingles(hashes, at, 5))
    assert np.diff(offsets).tolist() == [len(shingle_set(t)) for t in texts]


def test_chunks_don_t_change_hashes(monkeypatch):
    texts = pa.array(["some words of differing lengths in here " * 50, "longword" * 300 + " tail", "last"])
    whole = S.words(*S.text_bytes(texts), S.WHITESPACE)
    monkeypatch.setattr(S, "CHUNK", 64)
    small = S.words(*S.text_bytes(texts), S.WHITESPACE)
    assert (whole[0] == small[0]).all() and (whole[1] == small[1]).all()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    labels, _ = components(spark, edges)
    assert {r["comp"] for r in labels.where("node <= 60").collect()} == {0} and labels.where("node = 101").first()["comp"] == 100


def test_rows_that_share_an_id_are_judged_by_their_own_texts(make):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (2, b, "en", "t", 1), (3, c, "en", "s", 1), (None, a, None, None, None), (None, a, None, None, None)]
    clashing = make(rows).selectExpr("*", "1 AS __id", "2 AS kept", "3 AS mark", "4 AS n", "5 AS component_id")
    left = nd.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    assert sorted((r["doc_id"] or 0, r["text"][0]) for r in left.collect()) == [(0, "a"), (0, "a"), (1, "a"), (2, "b"), (3, "c")]


def test_sets_of_either_width_meet(make, monkeypatch):
    rows = look_alikes(12, (125, 140))
    want = brute(rows, 85)
    docs = make([(i, t, None, None, None) for i, t in rows])
    for narrow in (0, 146, 10_000):  # all wide, some of each, all narrow
        monkeypatch.setattr(nd, "NARROW", narrow)
        assert verdicts(nd.near_duplicates(docs, 85)) == want
