import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracask.llm import langid

from .conftest import write

DATA = "/root/testdata/sf0.001"


def test_forward_pass_sums_all_segmentations():
    counts = {"x": {"abab": 3, "bab": 1, "c": 2}, "y": {"ccab": 2, "ab": 5}}
    model = langid.learn(counts, ["a", "b", "ab", "bab", "abab", "cc"], rounds=2)

    def brute(word, k):
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, len(word) + 1):
            piece = model.ids.get(word[:n], 1 if n == 1 else 0)
            if piece:
                total += model.probabilities[piece, k] * brute(word[n:], k)
        return total

    words = ["abab", "c", "zabz", "ccababbab", "é"]
    got = model.score_words(words)
    for w, row in zip(words, got):
        for k in range(2):
            assert math.isclose(row[k], math.log(brute(w, k)), rel_tol=1e-9)
    assert [round(float(s), 9) for s in model.probabilities.sum(0)] == [1.0, 1.0]


def brute_word(model, word, k):
    """Forward sum over all segmentations, with exact fractions."""
    sums = [Fraction(1)] + [Fraction(0)] * len(word)
    for e in range(1, len(word) + 1):
        for i in range(e):
            piece = model.ids.get(word[i:e], 1 if i == e - 1 else 0)
            if piece:
                sums[e] += sums[i] * Fraction(float(model.probabilities[piece, k]))
    return sums[-1]


def log_of(x):
    return math.log(x.numerator) - math.log(x.denominator)


NAMES = ["a", "b", "ab", "bab", "abab", "cc", "abc" * 4, "a" * 17]


def test_long_words_are_whole(monkeypatch):
    monkeypatch.setattr(langid, "RUN", 16)
    model = langid.learn({"x": {"ab": 1, "abcabcabcabc": 2}, "y": {"aa": 3, "b" * 40: 1}}, NAMES)
    words = ["ab" * 30, "abc" * 33 + "q", "a" * 100, "q" * 33, "ab"]
    for w, row in zip(words, model.score_words(words)):
        for k in range(2):
            assert math.isclose(row[k], log_of(brute_word(model, w, k)), rel_tol=1e-9)
    assert math.isfinite(model.score_words(["q" * 20_000])[0][0])


def test_expected_counts_against_enumeration(monkeypatch):
    monkeypatch.setattr(langid, "RUN", 4)
    model = langid.learn({"x": {"abab": 3}, "y": {"babcc": 2}}, NAMES, rounds=1)

    def ways(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            piece = model.ids.get(word[:n], 1 if n == 1 else 0)
            if piece:
                yield from ([piece, *rest] for rest in ways(word[n:]))

    for short in (32, 2):  # in step, and one by one
        monkeypatch.setattr(langid, "SHORT", short)
        words, times = ["abab", "ccbabz", "abcabcabcabcab"], np.array([[2.0, 0.0], [1.0, 3.0], [0.0, 1.0]])
        want = np.zeros(model.probabilities.shape)
        for w, t in zip(words, times):
            for k in range(2):
                found = [(list(x), math.prod(model.probabilities[i, k] for i in x)) for x in ways(w)]
                whole = sum(p for _, p in found)
                for x, p in found:
                    for i in x:
                        want[i, k] += t[k] * p / whole
        assert np.allclose(model.expected(words, times), want, rtol=1e-9)


def test_letters_alone_are_words():
    assert langid.words_of("Ab1c ½ ² ① ٣ é_Ünï 日本 Ⅷ x²y") == ["ab", "c", "é", "ünï", "日本", "x", "y"]
    pieces = langid.load_pieces()
    assert max(map(len, pieces)) > 12 and all(p.isalpha() for p in pieces)


def test_every_language_is_learnt_and_equal_rows_count_once(make):
    rows = [(1, "immer derselbe satz", "de", "s", 1)] * 3000 + [(i, f"the number {chr(97 + i % 26)} text", "en", "s", 1) for i in range(3000)]
    df, langs = langid.sample(make(rows), "text", "lang", 40)
    got = [r["lang"] for r in df.collect()]
    assert langs == ["de", "en"] and got.count("de") == 1 and 20 <= got.count("en") <= 65


def test_query_against_brute_force(spark, make, tmp_path, monkeypatch):
    """Learning and prediction anew in plain Python, on a small table whose rows are all learnt from."""
    words = {"en": "the house and water with this that", "de": "das haus und wasser mit dieses dass", "fr": "la maison et eau avec cette que"}
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(w.split()) for _ in range(draw.randint(1, 9))), lang, "s", 1) for i, (lang, w) in enumerate(list(words.items()) * 25)]
    rows += [(90, "Maison ½ 12 WATER", None, None, None), (91, "½ 12", "en", None, None), (92, None, "de", None, None), (93, "das" * 15, None, None, None)]
    names = ["th", "e", "the", "ou", "se", "haus", "as", "d", "ass", "wa", "ter", "er", "mai", "on", "et", "a"]
    monkeypatch.setattr(langid, "load_pieces", lambda path: names)
    got = {r["doc_id"]: r for r in langid.op8_language_id(spark, write(spark, tmp_path, documents=make(rows))).collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    langs = sorted(words)
    counts = {x: Counter(w for i, t, l, *_ in rows if l == x and t and fold(i) for w in re.findall("[a-z]+", t.lower())) for x in langs}
    ids = {p: i for i, p in enumerate(names, 2)}
    probabilities = {}
    for x in langs:
        p = [0.0, 0.01, *(0.1 ** min(len(n) - 1, 2) for n in names)]
        p = [v / sum(p) for v in p]
        for _ in range(langid.ROUNDS):
            found = [0.0] + [langid.SMOOTHING] * (len(names) + 1)
            for w, times in counts[x].items():
                ends = [[(i, ids.get(w[i:e], 1 if i == e - 1 else 0)) for i in range(e)] for e in range(len(w) + 1)]
                fore, rear = [1.0] + [0.0] * len(w), [0.0] * len(w) + [1.0]
                for e in range(1, len(w) + 1):
                    fore[e] = sum(fore[i] * p[k] for i, k in ends[e])
                for e in range(len(w), 0, -1):
                    for i, k in ends[e]:
                        rear[i] += p[k] * rear[e]
                for e in range(1, len(w) + 1):
                    for i, k in ends[e]:
                        if k:
                            found[k] += times * fore[i] * p[k] * rear[e] / fore[-1]
            p = [v / sum(found) for v in found]
        probabilities[x] = p
    for i, t, *_ in rows:
        letters = re.findall("[a-z]+", (t or "").lower())
        assert got[i]["held_out"] == (fold(i) == 0)
        if not letters:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        logs = []
        for x in langs:
            total = 0.0
            for w in letters:
                sums = [1.0] + [0.0] * len(w)
                for e in range(1, len(w) + 1):
                    sums[e] = sum(sums[s] * probabilities[x][ids.get(w[s:e], 1 if s == e - 1 else 0)] for s in range(e))
                total += math.log(sums[-1])
            logs.append(total)
        best = max(logs)
        assert got[i]["lang_pred"] == langs[logs.index(best)] and abs(got[i]["score"] - 1 / sum(math.exp(v - best) for v in logs)) < 2e-6


@pytest.fixture(scope="module")
def guessed(spark):
    return langid.op8_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()


def test_held_out_accuracy(guessed):
    held = [r for r in guessed if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in guessed)


def test_odd_rows(spark, odd_docs, make, tmp_path):
    rows = langid.op8_language_id(spark, write(spark, tmp_path, documents=odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[8]["lang_pred"] == "und" and by[8]["score"] == 0
    assert by[7]["lang_pred"] in ("en", "de", "und")
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.op8_language_id(spark, write(spark, tmp_path / "n", documents=unlabelled)).collect()} == {"und"}
    assert langid.op8_language_id(spark, write(spark, tmp_path / "e", documents=make([]))).count() == 0
