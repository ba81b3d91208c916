"""Toxicity by multiple-instance learning: sentences score, noisy-or combines them.

Only documents have labels. A document is toxic unless it is innocent of every
sentence (and of a small leak): 1 - (1 - leak) * product(1 - p). A sentence's p is
logistic in its words less what any sentence is granted: (q - ``MILD``) / (1 - ``MILD``)
for a logistic q, zero below. Sentences of one document with the same weighted words
are one piece of evidence and count once. Fit and score share this over all sentences,
wherever they stand, so slight doubts about very many clean sentences don't add up. The
weights that maximise the likelihood of the document labels also say which ones offend.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import beside_helpers, map_rows

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE_DOCS = 12_000
#: Word features that may carry a weight: those whose documents differ most by label.
FEATURES = 2_000
#: Least difference of a feature, in standard errors, and least documents with it.
MIN_Z, MIN_DOCS = 4.0, 3
#: Lengths of word beginnings that are features beside the word; they join its inflections.
STEMS = range(4, 9)
ROUNDS = 24
THRESHOLD = 0.7
#: Logistic probability up to which a sentence counts as clean: more likely so than not.
MILD = 0.5
#: Counts of features that a task holds before it hands them on.
COUNTED = 150_000
#: Words of which a worker remembers the weight.
WORDS_KNOWN = 150_000

_FLOOR, _GRANTED = math.log(MILD / (1 - MILD)), math.log1p(-MILD)

_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    """The word, and its proper beginnings, marked by a plus sign."""
    return [word, *(word[:n] + "+" for n in STEMS if len(word) > n)]


def sentences_of(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split((text or "").lower()) if s and not s.isspace()]


def training_rows(labels: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """Up to ``limit`` labelled documents outside the held-out third, by a hash of the id.

    A doc_id that is labelled more than once is toxic if any label says so;
    null ids and labels take no part.
    """
    return (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, limit: int = SAMPLE_DOCS) -> dict:
    """Weights by feature, with ``bias`` and ``leak`` (as logits), from document labels.

    The sample's ids are broadcast (at most ``limit``), its words counted where
    they are, and its few weighty features written; each round sums gradients
    of whole documents. Without labels, or with one class alone, no feature has
    weight and the leak is the smoothed share of toxic documents.
    """
    spark = docs.sparkSession
    chosen = training_rows(labels, limit)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "__toxic")

    def counts(rows):
        seen: dict[str, list[int]] = {}
        for text, toxic in rows:
            words = set(_WORD.findall((text or "").lower()))
            for feature in {f for w in words for f in features_of(w)}:
                seen.setdefault(feature, [0, 0])[toxic] += 1
            if len(seen) > COUNTED:
                yield from ((f, *n) for f, n in seen.items())
                seen = {}
            seen.setdefault("", [0, 0])[toxic] += 1  # all documents
        yield from ((f, *n) for f, n in seen.items())

    counted = (
        map_rows(sample, "feature string, clean long, toxic long", counts)
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counted = stage(counted, "feature-counts")
    n0, n1 = next(((r.clean, r.toxic) for r in counted.filter("feature = ''").collect()), (0, 0))
    leak = math.log((n1 + 1) / (n0 + 2))
    if not n0 or not n1:
        return {"weights": {}, "bias": -20.0, "leak": leak}
    share = (F.col("clean") + F.col("toxic") + 1.0) / (n0 + n1 + 2.0)
    z = (F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    picked = (
        counted.filter((F.col("feature") != "") & (F.col("clean") + F.col("toxic") >= MIN_DOCS))
        .withColumn("z", z)
        .filter(F.abs("z") >= MIN_Z)
        .orderBy(F.desc(F.abs("z")), "feature")
        .limit(FEATURES)
        .collect()
    )
    names = [r.feature for r in picked]
    number = {f: i for i, f in enumerate(names)}
    sent = spark.sparkContext.broadcast(number)

    def bags(rows):
        place = sent.value
        for text, toxic in rows:
            found = {}
            for sentence in sentences_of(text):
                ids = {w: [place[f] for f in features_of(w) if f in place] for w in set(_WORD.findall(sentence))}
                words = frozenset(w for w in ids if ids[w])
                if words and words not in found:
                    found[words] = sorted({i for w in words for i in ids[w]})
            yield toxic, list(found.values())

    table = stage(map_rows(sample, "toxic int, bags array<array<int>>", bags), "sentence-bags")
    start = np.array([math.log((r.toxic + 0.5) / (n1 + 1) / ((r.clean + 0.5) / (n0 + 1))) for r in picked])
    values = np.concatenate([np.clip(start, -2, 4) / 2, [_FLOOR, -3.0]])  # then the bias and the leak
    pace, before = np.full(len(values), 0.3), np.zeros(len(values))
    for _ in range(rounds):
        slope = _gradient(table, values) / (n0 + n1)
        slope[:-2] += 1e-4 * values[:-2]
        turn = np.sign(slope) * np.sign(before)
        pace = np.clip(pace * np.where(turn > 0, 1.3, np.where(turn < 0, 0.5, 1.0)), 1e-4, 1.0)
        before = np.where(turn < 0, 0, slope)
        values = np.clip(values - np.sign(before) * pace, -12, 12)
    return {"weights": dict(zip(names, values[:-2].tolist())), "bias": float(values[-2]), "leak": float(values[-1])}


def _gradient(table: DataFrame, values: np.ndarray) -> np.ndarray:
    """Of the negative log likelihood; each task sends one row per number that moved."""
    n = len(values) - 2

    def run(rows):
        total = np.zeros(n + 2)
        for toxic, bags in rows:
            logits = np.array([values[ids].sum() for ids in bags]) + values[n]
            bags = [ids for ids, logit in zip(bags, logits) if logit > _FLOOR]
            every = np.append(logits[logits > _FLOOR], values[n + 1])
            innocent = float(-np.logaddexp(0, every).sum()) - len(bags) * _GRANTED  # log of 1 - p
            pull = 1 / (1 + np.exp(-every))
            if toxic:
                pull = pull * -(math.exp(innocent) / max(1e-12, -math.expm1(min(0.0, innocent))))
            for ids, step in zip(bags, pull):
                total[ids] += step
            total[n] += pull[:-1].sum()
            total[n + 1] += pull[-1]
        yield from ((int(i), float(total[i])) for i in np.flatnonzero(total))

    out = np.zeros(n + 2)
    for place, slope in map_rows(table, "place int, slope double", run).groupBy("place").agg(F.sum("slope")).collect():
        out[place] = slope
    return out


class Scorer:
    """Scores of sentences and texts; remembers the weight of words."""

    def __init__(self, model: dict):
        self.weights, self.bias, self.leak = model["weights"], model["bias"], model["leak"]
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= WORDS_KNOWN:
                self.known.clear()
            get = self.weights.get
            found = self.known[word] = sum(get(f, 0.0) for f in features_of(word))
        return found

    def sentence(self, sentence: str, seen: set[frozenset[str]] | None = None) -> float:
        """Log of 1 - p; each word counts once. Zero without a word of weight, or if ``seen``
        holds its weighted words; they are added to it."""
        known, weight = self.known, self.weight
        words = set(_WORD.findall(sentence))
        found = [known[w] if w in known else weight(w) for w in words]
        logit = self.bias + sum(found)
        if logit <= _FLOOR or not any(found):
            return 0.0
        if seen is not None:
            weighted = frozenset(w for w, value in zip(words, found) if value)
            if weighted in seen:
                return 0.0
            seen.add(weighted)
        return min(0.0, _log_innocent(logit) - _GRANTED)

    def text(self, text: str | None) -> tuple[float, int, int, float]:
        """Score, sentences, and the place (from 0, or -1) and score of the worst sentence."""
        worst, place, n, total = 0.0, -1, 0, _log_innocent(self.leak)
        seen: set[frozenset[str]] = set()
        for n, sentence in enumerate(sentences_of(text), 1):
            innocent = self.sentence(sentence, seen)
            if place < 0 or innocent < worst:
                worst, place = innocent, n - 1
            total += innocent
        return -math.expm1(total), n, place, -math.expm1(worst)


def _log_innocent(logit: float) -> float:
    return -(max(logit, 0.0) + math.log1p(math.exp(-abs(logit))))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with __score, __sentences, __worst (place) and __worst_score.

    Null and empty texts have no sentence and score the leak. Texts are read
    whole; the model (at most ``FEATURES`` numbers) is broadcast; no shuffle;
    repeated rows score alike; other columns pass through.
    """
    place = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        scorer = Scorer(sent.value)
        for row in rows:
            yield (*row, *scorer.text(row[place]))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs, f"{kinds}, __score double, __sentences long, __worst long, __worst_score double", run)


def offending(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """doc_id, place (from 0), sentence (lower case) and score of the sentences that offend."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        scorer = Scorer(sent.value)
        for doc_id, text in rows:
            for place, sentence in enumerate(sentences_of(text)):
                p = -math.expm1(scorer.sentence(sentence))
                if p >= least:
                    yield doc_id, place, sentence.strip(), p

    kind = next(f.dataType.simpleString() for f in docs.schema if f.name.lower() == "doc_id")
    return map_rows(
        docs.select("doc_id", "text"), f"doc_id {kind}, place long, sentence string, score double", run
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and n_sentences, worst_sentence, worst_score."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("__sentences").alias("n_sentences"),
        F.col("__worst").alias("worst_sentence"),
        F.col("__worst_score").alias("worst_score"),
    )


@beside_helpers
def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``; columns are those of ``docs``."""
    scored = score(docs, fit(docs, labels))
    return scored.filter(F.col("__score") < threshold).select(*[f"`{c}`" for c in docs.columns])
