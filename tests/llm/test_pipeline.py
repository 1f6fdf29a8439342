from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terracask.llm import langid

from .conftest import write
from .test_decontam import brute as leaks
from .test_mixing_sharding import brute_layout, reference_jump
from .test_near_dedup import brute as groups


def test_stages_against_brute_force(spark, make, prose, tmp_path):
    items = [(0, " ".join(prose[0].split()[:20])), (1, "nothing like this text is anywhere at all here")]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]
    rows += [(900, None, "en", "s0", 0), (901, "12 34 %%", "en", "s1", 1), (902, "x " + items[0][1] + " y z", None, None, None)]
    docs = make(rows)
    folder = write(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    kept = corpus_pipeline.identify_language(spark, docs, folder)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {900, 901}
    texts = [(r[0], r[1]) for r in rows if r[0] < 900 or r[0] == 902]
    single = corpus_pipeline.drop_near_duplicates(spark, kept, folder)
    alive = {i for i, (_, c) in groups(texts, 80).items() if i == c}
    assert {r["doc_id"] for r in single.collect()} == alive
    clean = corpus_pipeline.decontaminate(spark, single, folder)
    left = alive - {d for d, *_ in leaks([t for t in texts if t[0] in alive], items, 0.8)}
    assert {r["doc_id"] for r in clean.collect()} == left and 0 not in left
    mixed = corpus_pipeline.mix_sources(spark, clean, folder)
    assert mixed.columns == docs.columns
    laid = Counter(r[0] for r in brute_layout([(i, t, s) for i, t, _, s, _ in rows if i in left]))
    assert Counter(r["doc_id"] for r in mixed.collect()) == laid
    sharded = corpus_pipeline.shard(spark, mixed, folder)
    assert sharded.columns == [*docs.columns, "shard"]
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in whole) == laid
    assert all(r["shard"] == reference_jump(r["doc_id"], 16) for r in whole + sharded.collect())


def test_language_stage_judges_by_prediction(spark, make, tmp_path):
    rows = [(i, "the water and the house" if i % 2 else "das wasser und das haus", "en" if i % 2 else "de", "s", 1) for i in range(60)]
    docs = make([*rows, (100, "日", None, "s", 1), (101, "12 !", "en", "s", 1), (102, "water house", None, "s", 1)])
    score = {r["doc_id"]: r["score"] for r in langid.predict(docs, langid.fit(docs)).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept == {i for i, s in score.items() if s >= corpus_pipeline.LEAST_SCORE} and {*range(60), 102} <= kept and 101 not in kept
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, unlabelled, "").count() == docs.count()


CLASHES = ("weight", "tokens", "epoch", "start", "block", "place", "shard", "grown_shard", "score", "lang_pred", "__lang", "__score", "kept", "component_id", "mark", "n", "item_id", "__salt", "__id")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_clashing_columns(spark, make, prose, odd_docs, tmp_path, name, stage):
    docs = make([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]).unionByName(odd_docs)
    clashing = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    folder = write(spark, tmp_path, benchmark=spark.createDataFrame([(0, " ".join(prose[0].split()[:20]))], "item_id bigint, text string"))
    out = stage(spark, clashing, folder)
    assert out.columns == [*clashing.columns, *(["shard_"] if name == "sharding" else [])]
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHES)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, folder).collect())


def test_odd_rows_and_empty_table(spark, make, odd_docs, tmp_path):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    out = corpus_pipeline.run(spark, write(spark, tmp_path / "a", documents=odd_docs, benchmark=bench))
    assert {r["doc_id"] for r in out.where(F.col("doc_id").isNotNull()).collect()} <= {1, -5, 7}
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "b", documents=make([]), benchmark=bench)).count() == 0


def test_stages_are_as_asked():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
