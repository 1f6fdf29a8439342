"""Operator 8: language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces: its token strings of letters, whatever their
length (the tokenizer itself is not used and nothing of it is trained). Each language has a
probability for every piece. A word's probability is the sum, over all ways to cut it into
pieces, of the product of the pieces' probabilities, which a forward pass over the word gives
in one go; a text's is the product over its words. The probabilities are learnt by expectation
maximisation: forward and backward passes share each word among its segmentations, and the
expected counts of pieces, smoothed, are the next probabilities. Every single character is a
piece; characters that the vocabulary doesn't have share one.

Words are runs of letters (Unicode category L), lower-cased, and never cut. Short words are
passed over in step, all at once; words of more than ``SHORT`` letters one by one, rescaled as
they go. Frequent words are looked up in a bounded cache of word scores.

Learning takes about ``TRAIN_DOCS`` labelled documents of each language, those with the
smallest hashes of their rows, at least one and all of its words; equal rows count once. Words
are counted and shared out among pieces in Spark; the driver holds the expected counts, a number
per piece and language. The labels' values are few by contract. Prediction goes over every text
as a whole. The prior is uniform.

Defined cases: null text, or text without a letter, is ``und`` with score 0; null labels
are not learnt from; ties between languages go to the one first in the alphabet; without
any labelled text everything with a letter is ``und``; words and texts may be of any length;
repeated rows are predicted each; an empty table gives an empty result; extra columns are
carried along and keep their values: an output whose name is taken gets underscores behind it.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shingles as S
from .common import drop_path, fresh, table, write_table

#: Where the public vocabulary files are; a parameter, never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Labelled documents of a language that are learnt from, the bound of the sample.
TRAIN_DOCS = 400
ROUNDS = 4
SMOOTHING = 0.1
#: Letters of the words that are passed over in step.
SHORT = 32
#: Ends of a long word that are looked at together, and steps between rescalings.
RUN, RESCALE = 2048, 8
CACHE = 1 << 17
#: Words that are scored in step, and bytes of texts that are looked at together.
WORDS_AT_ONCE, BYTES_AT_ONCE = 1 << 13, 1 << 20
UNDETERMINED = "und"


def _numerals() -> str:
    """The characters that regular expressions take for word characters but that are no letters."""
    odd = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
    return "".join(re.escape(c) for c in odd)


#: A run of word characters that are no digits; and a run of letters, which takes longer to find.
RUN_OF = re.compile(r"[^\W\d_]+")
WORD = re.compile(rf"[^\W\d_{_numerals()}]+")


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces that are made of letters, lower-cased, in order."""
    vocabulary = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
    # byte-level vocabularies write each byte as a character: printable bytes as they are, others from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    found = set()
    for token in vocabulary:
        try:
            text = bytes(of[c] for c in token).decode().strip().lower()
        except (KeyError, UnicodeDecodeError):
            continue
        if WORD.fullmatch(text):
            found.add(text)
    return sorted(found)


# ---------------------------------------------------------------------- pieces

SLOT_BITS = 20
_SLOT_FACTORS = S.stream(81, 16) | S.U(1)


def _extend(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return keys * S.U(0x5851F42D4C957F2D) + codes + S.U(1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(S.U)


class Pieces:
    """Ids of pieces by hash tables: 0 is no piece, 1 a single character that is none, then the pieces."""

    def __init__(self, pieces: list[str]):
        self.names = pieces
        self.longest = max(map(len, pieces), default=1)
        self.keys = np.zeros(len(pieces) + 2, S.U)
        self.slots: list[np.ndarray] = []
        with np.errstate(over="ignore"):
            for n in range(1, self.longest + 1):
                at = [i for i, p in enumerate(pieces) if len(p) == n]
                keys = np.zeros(len(at), S.U)
                letters = _codes("".join(pieces[i] for i in at)).reshape(len(at), n)
                for j in range(n):
                    keys = _extend(keys, letters[:, j])
                self.keys[np.array(at, np.int64) + 2] = S.mix(keys)
            open_ = np.arange(2, len(self.keys))
            for factor in _SLOT_FACTORS:  # what collides in a table goes to the next
                if len(open_):
                    places = ((self.keys[open_] * factor) >> S.U(64 - SLOT_BITS)).astype(np.int64)
                    slots = np.zeros(1 << SLOT_BITS, np.int32)
                    slots[places[::-1]] = open_[::-1]
                    self.slots.append(slots)
                    open_ = open_[slots[places] != open_]
        if len(open_):
            raise ValueError("pieces collide in all tables")

    def ids(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Ids of the windows of ``length`` characters with these running hashes."""
        keys = S.mix(keys)
        out = np.zeros(len(keys), np.int32)
        for slots, factor in zip(self.slots, _SLOT_FACTORS):
            found = slots[(keys * factor) >> S.U(64 - SLOT_BITS)]
            out = np.where((self.keys[found] == keys) & (found > 0), found, out)
        return np.where(out == 0, 1, out) if length == 1 else out

    def windows(self, codes: np.ndarray, ends: list[int]) -> list[np.ndarray]:
        """For n = 1, 2, ...: ids of the windows of n characters within ``codes[:ends[n - 1]]``, by start."""
        out, keys = [], np.zeros(len(codes), S.U)
        with np.errstate(over="ignore"):
            for n, end in enumerate(ends, 1):
                count = max(0, end - n + 1)
                keys = _extend(keys[:count], codes[n - 1 : n - 1 + count])
                out.append(self.ids(keys, n))
        return out


class Model:
    """Probabilities of pieces by language: ``probabilities`` is id x language."""

    def __init__(self, langs: list[str], pieces: Pieces, probabilities: np.ndarray):
        self.langs, self.pieces, self.probabilities = langs, pieces, probabilities

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i + 2 for i, p in enumerate(self.pieces.names)}

    # ---------------------------------------------------------- words in step

    def _laid(self, words: list[str]):
        """Words, longest first, as codes with their starts and sizes, and their windows' ids."""
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        sizes = np.array([len(words[k]) for k in order], np.int64)
        codes = _codes("".join(words[k] for k in order))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        most = min(self.pieces.longest, int(sizes[0])) if len(sizes) else 0
        ids = self.pieces.windows(codes, [int(starts[np.searchsorted(-sizes, -n, "right")]) for n in range(1, most + 1)])
        return np.array(order, np.int64), sizes, starts[:-1], ids

    def _forward(self, sizes: np.ndarray, starts: np.ndarray, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Sums over the segmentations of each word's first 0, 1, ... letters, for words that have them."""
        p = self.probabilities
        alpha = [np.ones((len(sizes), p.shape[1]))]
        for e in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            active = int(np.searchsorted(-sizes, -e, "right"))
            now = np.zeros((active, p.shape[1]))
            for n in range(1, min(len(ids), e) + 1):
                piece = ids[n - 1][starts[:active] + (e - n)]
                hit = np.flatnonzero(piece)
                now[hit] += p[piece[hit]] * alpha[e - n][hit]
            alpha.append(now)
        return alpha

    def _backward(self, sizes: np.ndarray, starts: np.ndarray, ids: list[np.ndarray]) -> list[np.ndarray]:
        """The same for the letters from 0, 1, ... on."""
        p, top = self.probabilities, int(sizes[0]) if len(sizes) else 0
        beta: list[np.ndarray] = [np.zeros((0, 0))] * (top + 1)
        for i in range(top, -1, -1):
            now = np.zeros((int(np.searchsorted(-sizes, -i, "right")), p.shape[1]))
            now[int(np.searchsorted(-sizes, -(i + 1), "right")) :] = 1.0
            for n in range(1, min(len(ids), top - i) + 1):
                longer = int(np.searchsorted(-sizes, -(i + n), "right"))
                piece = ids[n - 1][starts[:longer] + i]
                hit = np.flatnonzero(piece)
                now[hit] += p[piece[hit]] * beta[i + n][hit]
            beta[i] = now
        return beta

    # --------------------------------------------------------- one long word

    def _chain(self, codes: np.ndarray, backward: bool = False, keep: bool = False) -> np.ndarray:
        """Logs of the sums over segmentations of a word's first letters (or of those from a letter
        on); of all places with ``keep``, else of the whole word only."""
        p, most, size = self.probabilities, self.pieces.longest, len(codes)
        held = np.zeros((most + RUN, p.shape[1]))
        held[most - 1] = 1.0
        logs = np.zeros(p.shape[1])
        out = [np.zeros((1, p.shape[1]))]
        for done in range(0, size, RUN):
            steps = min(RUN, size - done)
            # the places that these steps reach, and the letters of all windows that end (begin) there
            if backward:
                low, high = size - done - steps, min(size, size - done - 1 + most)
            else:
                low, high = max(0, done + 1 - most), done + steps
            ids = self.pieces.windows(codes[low:high], [high - low] * min(most, high - low))
            steps_ids = np.zeros((steps, most), np.int32)  # [step, most - n]: the window of n letters
            for n, found in enumerate(ids, 1):
                for_step = (size - done - 1 - np.arange(steps) if backward else done + 1 - n + np.arange(steps)) - low
                ok = (for_step >= 0) & (for_step < len(found))
                steps_ids[ok, most - n] = found[for_step[ok]]
            shares = p[steps_ids]
            raw, scale = np.empty((steps, p.shape[1])), np.empty((steps, p.shape[1]))
            for j in range(steps):
                raw[j] = held[j + most] = now = (shares[j] * held[j : j + most]).sum(0)
                scale[j] = logs
                if j % RESCALE == RESCALE - 1 or j == steps - 1:
                    held[j + 1 : j + 1 + most] /= now
                    logs = logs + np.log(now)
            if keep:
                out.append(np.log(raw) + scale)
            held[:most] = held[steps : steps + most].copy()
        return np.concatenate(out) if keep else logs

    # ------------------------------------------------------------- both kinds

    def score_words(self, words: list[str]) -> np.ndarray:
        """Word x language log probabilities, over all segmentations."""
        out = np.zeros((len(words), self.probabilities.shape[1]))
        every = [k for k, w in enumerate(words) if len(w) <= SHORT]
        for start in range(0, len(every), WORDS_AT_ONCE):
            short = every[start : start + WORDS_AT_ONCE]
            order, sizes, starts, ids = self._laid([words[k] for k in short])
            alpha = self._forward(sizes, starts, ids)
            at = np.array(short, np.int64)[order]
            for e in range(1, len(alpha)):
                longer = int(np.searchsorted(-sizes, -(e + 1), "right"))
                out[at[longer : len(alpha[e])]] = np.log(alpha[e][longer:])
        for k, w in enumerate(words):
            if len(w) > SHORT:
                out[k] = self._chain(_codes(w))
        return out

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected counts (id x language) of pieces in words that occur ``times`` (word x language)."""
        p = self.probabilities
        pieces, counts = [np.zeros(0, np.int32)], [np.zeros((0, p.shape[1]))]
        short = [k for k, w in enumerate(words) if len(w) <= SHORT]
        order, sizes, starts, ids = self._laid([words[k] for k in short])
        if len(order):
            alpha, beta = self._forward(sizes, starts, ids), self._backward(sizes, starts, ids)
            share = times[np.array(short, np.int64)[order]] / beta[0]
            for e in range(1, len(alpha)):
                for n in range(1, min(len(ids), e) + 1):
                    piece = ids[n - 1][starts[: len(alpha[e])] + (e - n)]
                    hit = np.flatnonzero(piece)
                    pieces.append(piece[hit])
                    counts.append(share[hit] * alpha[e - n][hit] * p[piece[hit]] * beta[e][hit])
        for k, w in enumerate(words):
            if len(w) > SHORT:
                codes = _codes(w)
                fore, rear = self._chain(codes, keep=True), self._chain(codes, backward=True, keep=True)[::-1]
                for n, found in enumerate(self.pieces.windows(codes, [len(codes)] * min(self.pieces.longest, len(codes))), 1):
                    hit = np.flatnonzero(found)
                    pieces.append(found[hit])
                    counts.append(times[k] * p[found[hit]] * np.exp(fore[hit] + rear[hit + n] - fore[-1]))
        flat, held = np.concatenate(pieces), np.concatenate(counts)
        return np.stack([np.bincount(flat, weights=held[:, k], minlength=len(p)) for k in range(p.shape[1])], 1) if p.shape[1] else np.zeros(p.shape)


# -------------------------------------------------------------------- learning


def _start(langs: list[str], pieces: Pieces) -> Model:
    first = np.array([0.0, 0.01, *(0.1 ** min(len(p) - 1, 2) for p in pieces.names)])
    return Model(langs, pieces, np.repeat((first / first.sum())[:, None], len(langs), 1))


def _next(model: Model, counts: np.ndarray, smoothing: float) -> Model:
    """The model of these expected counts."""
    found = counts + smoothing
    found[0] = 0.0
    return Model(model.langs, model.pieces, found / found.sum(0))


def learn(counts: dict[str, dict[str, int]], names: list[str], rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Model:
    """A model from word counts by language, by expectation maximisation, here and now."""
    langs = sorted(counts)
    words = sorted({w for lang in langs for w in counts[lang]})
    times = np.array([[counts[lang].get(w, 0) for lang in langs] for w in words], float).reshape(len(words), len(langs))
    model = _start(langs, Pieces(names))
    for _ in range(rounds):
        model = _next(model, model.expected(words, times), smoothing)
    return model


def words_of(text: str) -> list[str]:
    found = RUN_OF.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ((run,) if run.isalpha() else WORD.findall(run))]


def sample(labelled: DataFrame, text: str, lang: str, train_docs: int) -> tuple[DataFrame, list[str]]:
    """(lang, text) of about ``train_docs`` rows of each language, at least one, and the languages.

    A row is taken if the hash of all its columns is below its language's bound; equal rows are one."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.shiftrightunsigned(F.xxhash64(*(F.col(c) for c in labelled.columns)), 1).alias("h"))
    bound = F.lit(None).cast("bigint")
    langs = []
    for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).collect():  # a row per language
        langs.append(r["lang"])
        share = (1 << 63) - 1 if r["n"] <= train_docs else int(train_docs / r["n"] * (1 << 63))
        bound = F.when(F.col("lang") == r["lang"], F.lit(max(share, r["least"]))).otherwise(bound)
    return rows.where(F.col("h") <= bound).dropDuplicates(["lang", "h"]).select("lang", "text"), sorted(langs)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Model:
    """Learns from labelled rows: about ``train_docs`` documents of each language."""
    spark = labelled.sparkSession
    chosen, langs = sample(labelled, text, lang, train_docs)
    model = _start(langs, Pieces(load_pieces(vocabulary)))
    if not langs:
        return model
    counted = chosen.mapInArrow(_count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words, path = write_table(spark, counted, "words")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)  # bounded by vocabulary and languages
        shares = words.mapInArrow(_share_out(shared), "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        counts = np.zeros(model.probabilities.shape)
        for lang_, piece, n in shares.collect():  # a row per language and piece
            counts[piece, lang_] = n
        model = _next(model, counts, smoothing)
    drop_path(spark, path)
    return model


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in S.slices(whole, "text", BYTES_AT_ONCE):
            counts: Counter = Counter()
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.update((name, w) for w in words_of(text))
            langs, words = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"]
            )


def _share_out(shared):
    """Counts of words to the expected counts of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        places = {lang: k for k, lang in enumerate(model.langs)}
        total = np.zeros(model.probabilities.shape)
        for whole in batches:
            for batch in S.slices(whole, "word", 1 << 16):
                times = np.zeros((batch.num_rows, len(places)))
                times[np.arange(batch.num_rows), [places[x] for x in batch.column("lang").to_pylist()]] = batch.column("n").to_numpy()
                total += model.expected(batch.column("word").to_pylist(), times)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[piece, lang])], ["lang", "piece", "n"])

    return run


# ------------------------------------------------------------------ prediction


class Scorer:
    """Predicts texts with a bounded cache of the scores of short words."""

    def __init__(self, model: Model):
        self.model = model
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)))

    def _place(self, counts: list[Counter]) -> np.ndarray:
        """Sees to it that all words of ``counts`` have a place; the scores by place."""
        if len(self.places) > CACHE:
            self.places, self.scores = {}, self.scores[:0]
        new = {w for c in counts for w in c if w not in self.places}
        short, long = [w for w in new if len(w) <= SHORT], [w for w in new if len(w) > SHORT]
        if short:
            self.places.update(zip(short, range(len(self.scores), len(self.scores) + len(short))))
            self.scores = np.concatenate([self.scores, self.model.score_words(short)])
        if not long:
            return self.scores
        self.long = {w: len(self.scores) + k for k, w in enumerate(long)}  # for this batch alone
        return np.concatenate([self.scores, self.model.score_words(long)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        counts = [Counter(words_of(t)) if t else Counter() for t in texts]
        langs, scores = [], []
        self.long: dict[str, int] = {}
        table_ = self._place(counts) if self.model.langs else self.scores
        place = self.places.__getitem__
        for c in counts:
            if not c or not self.model.langs:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            at = np.fromiter((self.long[w] if w in self.long else place(w) for w in c) if self.long else map(place, c), np.int64, len(c))
            total = np.fromiter(c.values(), np.float64, len(c)) @ table_[at]
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(1.0 / np.exp(np.maximum(total - total[best], -700.0)).sum()))
        return langs, scores


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its probability among the learnt ones."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by vocabulary and languages
    out, score = fresh(df, out), fresh(df, score)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in S.slices(whole, text, BYTES_AT_ONCE):
                langs, scores = scorer.predict(batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    return df.mapInArrow(run, schema)


def fold(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(fold() != 0))
    guessed = predict(docs.select("doc_id", "text", F.coalesce(fold() == 0, F.lit(False)).alias("held_out")), model)
    return guessed.select("doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))


QUERIES = {"op8_language_id": op8_language_id}
#: Expectation maximisation has no SQL form; tests check held-out accuracy and brute force sums.
SQL: dict[str, str] = {}
