"""A training-data pipeline over ``documents``: five stages, each one operator of ``terracask.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; ``shard`` adds the shard. Empty tables, null columns and repeated rows are
handled as each operator's docstring states, further columns are carried along whatever
their names; if ``shard`` is taken, the last stage's column gets underscores behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terracask.llm import decontam, langid, mixing, near_dedup, sharding
from terracask.llm.common import fresh, table, write_table

#: Near duplicates share at least 80 hundredths of their five-word shingles.
PERCENT = 80


#: The least probability, among the learnt languages, with which a document's language counts as known.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not known: without text or letters, or with a predicted
    language whose probability is below ``LEAST_SCORE``. The languages are those of the labels;
    without any label there is nothing to judge by, and all documents stay."""
    model = langid.fit(docs)
    if not model.langs:
        return docs
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    guessed = langid.predict(docs, model, out=lang, score=score)
    return guessed.where((guessed[lang] != langid.UNDETERMINED) & (guessed[score] >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group."""
    return near_dedup.drop_near_duplicates(docs, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents of sources over their weight are left out beyond it, those of
    sources under it are repeated, once per pass."""
    return mixing.mix(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each document, by its id."""
    return sharding.shard(docs).select(*docs.columns, fresh(docs, "shard"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = write_table(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Language identification has no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None
