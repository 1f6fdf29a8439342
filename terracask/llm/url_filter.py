"""Operator 9: URL filters by rules and by logistic regression on hashed n-grams.

Host and path are cut into character n-grams, hashed into a fixed number of buckets (present
or not) and scored by a logistic regression that is trained on a small labelled URL table,
``labelled_urls.tsv``. Each of its rows is learnt with ``VARIANTS`` further suffixes, schemes
and path shapes too, the same for both labels, so that these tell the model nothing. Rules of
(host, path prefix) come before the model; of those that fit, the longest wins.

Defined cases: a null URL, or one without ``://``, has empty host and path and is judged
by the model's intercept; empty host or path gives no n-grams of that part; URLs may be of any
length, their n-grams are cut in time linear in it; repeated rows are judged each; an empty
table gives an empty result; extra columns are carried along and keep their values: an output
whose name is taken gets underscores behind it.
"""

from __future__ import annotations

import functools
import random
from dataclasses import dataclass
from pathlib import Path

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, table

BUCKETS = 1 << 16
SIZES = (3, 4, 5)
LABELLED = Path(__file__).with_name("labelled_urls.tsv")
#: Rows that each labelled URL adds to the table that is learnt from, its documented bound.
VARIANTS = 16


@dataclass(frozen=True)
class Rule:
    """Fits ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

SUFFIXES = "com net org info example.com example.net example.org co.uk de fr es".split()
PREFIXES = ("", "", "www.", "m.", "blog.")
PATH_TAILS = ("", "/", ".html", "?page=2&ref=x", "?utm_source=feed", "#top")


def labelled_urls(path: Path = LABELLED) -> list[tuple[str, float]]:
    """The labelled table: URLs, 1.0 unwanted and 0.0 ordinary."""
    rows = (line.split("\t") for line in path.read_text(encoding="utf-8").splitlines())
    return [(url, float(label == "block")) for label, url in rows]


def varied(rows: list[tuple[str, float]], variants: int = VARIANTS, seed: int = 9) -> list[tuple[str, float]]:
    """The rows, and each of their hosts with other prefixes, suffixes and paths."""
    draw = random.Random(seed)
    out = list(rows)
    for url, label in rows:
        host, _, path = url.partition("://")[2].partition("/")
        stem = host.removeprefix("www.").rpartition(".")[0]
        for k in range(variants):
            new = "/" + draw.choice((path, "en", "de", "fr", "es", "item")) + f"/{draw.randint(1, 999)}" if k % 2 else "/" + draw.choice(("en", "de", "fr", "es")) + f"/{draw.randint(1, 99999)}"
            out.append((draw.choice(("http://", "https://")) + draw.choice(PREFIXES) + f"{stem}.{draw.choice(SUFFIXES)}{new}{draw.choice(PATH_TAILS)}", label))
    return out


def with_parts(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    rest = F.expr(f"CASE WHEN contains(`{url}`, '://') THEN substring(`{url}`, instr(`{url}`, '://') + 3) END")
    found = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    after = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return df.withColumns({host: ascii_lower(found), path: after})


def ngrams(characters: Column, mark: str) -> Column:
    """Character n-grams of a part, with its mark in front of each; none of an empty part.

    Characters come as an array: cutting a string at a place would walk to it from the start."""

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(characters) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(characters, i, n), "")))

    return F.when(F.size(characters) == 2, F.array().cast("array<string>")).otherwise(F.concat(*(of(n) for n in SIZES)))


def featurize(df: DataFrame, host: str = "host", path: str = "path", out: str = "features") -> DataFrame:
    """Adds the hashed n-grams that ``host`` and ``path`` have."""
    h, p, grams = (fresh(df, f"{out}__{c}") for c in ("host", "path", "grams"))
    cut = df.withColumns({c: F.split(F.concat(F.lit("^"), F.col(part), F.lit("$")), "") for c, part in ((h, host), (p, path))})
    with_grams = cut.withColumn(grams, F.concat(ngrams(F.col(h), "h:"), ngrams(F.col(p), "p:")))
    return HashingTF(numFeatures=BUCKETS, inputCol=grams, outputCol=out, binary=True).transform(with_grams).drop(grams, h, p)


def train(labelled: DataFrame, url: str = "url", label: str = "label") -> LogisticRegressionModel:
    """A logistic regression on the labelled table, which is small by contract."""
    ready = featurize(with_parts(labelled, url)).select("features", F.col(label).cast("double").alias("label")).coalesce(1)
    return LogisticRegression(maxIter=40, regParam=0.0001, tol=1e-6, standardization=False).fit(ready)


@functools.cache
def _built_in(session: SparkSession) -> LogisticRegressionModel:
    listed = "\n".join(f"{int(y)} {u}" for u, y in varied(labelled_urls()))
    rows = session.range(1).select(F.explode(F.split(F.lit(listed), "\n")).alias("row"))
    return train(rows.select(F.expr("substring(row, 3)").alias("url"), F.substring("row", 1, 1).alias("label")))


def matching_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls. The rules are few by contract."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def judge(df: DataFrame, model: LogisticRegressionModel, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability``."""
    host, path, out, guess, chance = (fresh(df, c) for c in ("host", "path", "features", "__guess", "__chance"))
    parts = featurize(with_parts(df, url, host, path), host, path, out)
    scored = model.copy().setFeaturesCol(out).setPredictionCol(guess).setRawPredictionCol("").setProbabilityCol(chance).transform(parts)
    rule, ruled = matching_rule(rules, F.col(host), F.col(path))
    verdict = F.coalesce(ruled, F.when(F.col(guess) == 1.0, "block").otherwise("allow"))
    named = {fresh(df, "rule"): rule, fresh(df, "verdict"): verdict, fresh(df, "block_probability"): vector_to_array(chance)[1]}
    return scored.withColumns(named).drop(out, guess, chance)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for the URL of every page."""
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), _built_in(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("block_probability", 6).alias("block_probability"))


QUERIES = {"op9_url_filter": op9_url_filter}
#: Training has no SQL form; tests hold the query against a plain Python version.
SQL: dict[str, str] = {}
