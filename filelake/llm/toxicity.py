"""Toxicity by multiple-instance learning: sentences are scored, noisy-or makes the document's score."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake.llm import scratch

# Most labelled documents of each class that the classifier is fitted on, picked by a hash of the id.
MAX_TOXIC = 4_000
MAX_CLEAN = 8_000
# Most features of a model, and the documents of a class that a feature must occur in.
MAX_FEATURES = 20_000
MIN_DOCUMENTS = 3
# Association with the label that a feature needs: a likelihood ratio at the 0.1 % level.
MIN_RATIO = 10.83
PREFIXES = (3, 4, 5, 6, 7)
# What the ordinary sentences of a document may add to the exponent of the noisy-or.
NOISE = 0.3
# Distinct words whose weight a worker remembers.
REMEMBERED = 400_000

SENTENCE_END = re.compile(r"[.!?\n]+")
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features(word: str) -> list[str]:
    """The word without marks at its ends, and its beginnings, which inflected words share."""
    core = EDGES.sub("", word)
    if len(core) < 2:
        return []
    return [core, *(core[:n] + "*" for n in PREFIXES if len(core) > n)]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    # Falling scores of sentences of clean documents, and what those so far add to the exponent, a sentence; see ``_noise``.
    noise: tuple[np.ndarray, np.ndarray] | None = None

    def scorer(self):
        """Function from a whole text to the scores of its sentences that hold a feature, and those that count.

        Each scored sentence comes as ``(number, probability)``; of equal sentences the first one counts, as
        saying it again is no new evidence.
        """
        known: dict[str, float] = {}
        weights, bias = self.weights, self.bias

        def weight(word: str) -> float:
            if len(known) >= REMEMBERED:
                known.clear()
            total = known[word] = sum(weights.get(f, 0.0) for f in features(word))
            return total

        def score(text: str | None) -> tuple[list[tuple[int, float]], list[float]]:
            found, once = [], {}
            for i, s in enumerate(SENTENCE_END.split((text or "").lower())):
                total = 0.0
                for w in s.split():
                    x = known.get(w)
                    total += weight(w) if x is None else x
                if total:
                    p = _sigmoid(bias + total)
                    found.append((i, p))
                    once[s.strip()] = p
            return found, list(once.values())

        return score

    def document(self, scored: list[tuple[int, float]], counted: list[float]) -> float:
        """Noisy-or over the sentences from the gate on, and the bias once; at least the worst sentence's score."""
        gate = self.gate(len(counted))
        log_clean = math.log1p(-_sigmoid(self.bias)) + sum(math.log1p(-min(p, 1 - 1e-12)) for p in counted if p >= gate)
        return min(1.0, max(0.0, -math.expm1(log_clean), max(counted, default=0.0)))

    def gate(self, sentences: int) -> float:
        """Least score that is evidence in a document with so many scored sentences.

        Under noisy-or, weak scores of ordinary sentences add up to any score in a long enough text. From the gate on,
        as many sentences of clean documents add at most ``NOISE`` to the exponent. It is never above one half, as a
        sentence that is toxic by itself must count.
        """
        if self.noise is None or not sentences:
            return 0.0
        falling, added = self.noise
        at = int(np.searchsorted(added, NOISE / sentences, side="right"))
        return min(0.5, float(falling[at]) * (1 + 1e-9)) if at < len(falling) else 0.0


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out() -> pa.RecordBatch:
        rows = [(f, n, y) for y, c in counts.items() for f, n in c.items()]
        for c in counts.values():
            c.clear()
        f, n, y = zip(*rows) if rows else ((), (), ())
        return pa.record_batch({"feature": pa.array(f, pa.string()), "n": pa.array(n, pa.int64()), "y": pa.array(y, pa.int32())})

    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            counts[y].update({f for w in set((text or "").lower().split()) for f in features(w)})
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield out()
    yield out()


def _select(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """The features most associated with the label, by the likelihood ratio of their document counts."""
    counts = sample.mapInArrow(_count, "feature string, n long, y int").groupBy("feature").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).cast("double").alias("b"),
    )
    a, b, total = F.col("a"), F.col("b"), float(n_toxic + n_clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    share = n_toxic / total
    rest_a, rest_b = n_toxic - a, n_clean - b
    ratio = 2 * (
        part(a, (a + b) * share) + part(b, (a + b) * (1 - share))
        + part(rest_a, (rest_a + rest_b) * share) + part(rest_b, (rest_a + rest_b) * (1 - share))
    )
    best = counts.filter((a >= MIN_DOCUMENTS) | (b >= MIN_DOCUMENTS)).withColumn("ratio", ratio)
    rows = best.filter(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES).collect()
    return [r["feature"] for r in rows]


def _sparse(index: dict[str, int]):
    """Features of each document's different sentences, as numbers; sentences without any are left out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            rows = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                flat, sizes = [], []
                for s in dict.fromkeys(s.strip() for s in SENTENCE_END.split((text or "").lower())):
                    own: list[int] = []
                    for w in s.split():
                        if w not in known:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[w] = [index[f] for f in features(w) if f in index]
                        own += known[w]
                    if own:
                        flat += own
                        sizes.append(len(own))
                rows.append((y, sizes, flat))
            y, sizes, flat = zip(*rows)
            yield pa.record_batch({
                "y": pa.array(y, pa.int32()),
                "sizes": pa.array(sizes, pa.list_(pa.int32())), "flat": pa.array(flat, pa.list_(pa.int32())),
            })

    return of


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return pa.chunked_array([c.flatten() for c in lists.chunks], pa.int32()).to_numpy()


def _fit(data: pa.Table, n_features: int, weight: dict[int, float], steps: int = 300, l2: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the document labels under noisy-or."""
    y = data.column("y").to_numpy().astype(float)
    scored = pc.list_value_length(data.column("sizes")).to_numpy()
    of_doc = np.repeat(np.arange(len(y), dtype=np.int32), scored)
    sizes = _flat(data.column("sizes"))
    of_sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    feature = _flat(data.column("flat"))
    importance = np.array([weight[int(v)] for v in y])
    w, bias = np.zeros(n_features), -6.0
    past_w, past_b = np.full(n_features, 1e-6), 1e-6
    for _ in range(steps):
        z = bias + np.bincount(of_sentence, w[feature], len(sizes))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + math.exp(-bias))
        clean = np.exp(np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + math.log1p(-p0))
        toxic = np.maximum(1 - clean, 1e-9)
        # Derivative of the log-likelihood by a sentence's z: p (1-P)/P in a toxic document, -p in a clean one.
        factor = importance * np.where(y == 1, clean / toxic, -1.0)
        by_sentence = p * factor[of_doc]
        grad_w = np.bincount(feature, by_sentence[of_sentence], n_features) - l2 * w
        grad_b = by_sentence.sum() + factor.sum() * p0
        past_w += grad_w**2
        past_b += grad_b**2
        w += 0.5 * grad_w / np.sqrt(past_w)
        bias += 0.5 * grad_b / math.sqrt(past_b)
    return w, float(bias)


def _noise(data: pa.Table, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Falling scores of the sample's sentences of clean documents, and the running mean of what they add."""
    sizes = _flat(data.column("sizes"))
    scored = pc.list_value_length(data.column("sizes")).to_numpy()
    clean = np.repeat(data.column("y").to_numpy() == 0, scored)
    of_sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    z = bias + np.bincount(of_sentence, weights[_flat(data.column("flat"))], len(sizes))
    p = np.sort(1 / (1 + np.exp(-np.clip(z[clean], -30, 30))))[::-1]
    # Sentences of a half or more count anyway.
    added = np.cumsum(np.where(p < 0.5, -np.log1p(-np.minimum(p, 0.5)), 0.0)) / max(len(p), 1)
    some = p > 1e-4
    return (p[some], added[some]) if some.any() else None


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
) -> Model:
    """Model from the documents that ``labels (<id_col>, <label_col>)`` marks 0 or 1.

    Fitted on at most ``max_toxic`` and ``max_clean`` labelled ids, those with the smallest hash; weights
    restore the shares of the classes among all labels. Other labels and null ids are left out, an id with
    both labels counts as toxic, null texts count as empty. Of several documents with one id, the one whose text has the
    smallest hash is used, so the sample has no more rows than ids.
    Without labels of both classes the model knows no feature and scores everything near zero.
    """
    marked = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y"))
        .filter("y in (0, 1) and __id is not null")
        .groupBy("__id").agg(F.max("y").alias("y"))
        .withColumn("h", F.xxhash64(F.col("__id").cast("string")))
    )
    whole = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    if not whole.get(0) or not whole.get(1):
        return Model({}, -12.0)
    limit = {1: max_toxic, 0: max_clean}
    taken = {y: min(limit[y], whole[y]) for y in limit}
    picked = None
    for y in (0, 1):
        part = marked.filter(F.col("y") == y)
        part = part.orderBy("h", "__id").limit(limit[y]) if whole[y] > limit[y] else part
        picked = part if picked is None else picked.union(part)
    # At most max_toxic + max_clean ids, so the broadcast is bounded and the texts stay where they are.
    ids = F.broadcast(picked.select("__id", "y"))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    one = texts.join(ids, "__id").groupBy("__id").agg(F.max("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    sample, path = scratch.put(one.select("text", "y"), "toxicity-sample")
    chosen = _select(sample, taken[1], taken[0])
    index = {f: i for i, f in enumerate(chosen)}
    data = sample.mapInArrow(_sparse(index), "y int, sizes array<int>, flat array<int>").toArrow()
    scratch.drop(docs.sparkSession, path)
    weights, bias = _fit(data, len(chosen), {y: whole[y] / taken[y] for y in taken})
    kept = {f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 1e-6}
    return Model(kept, bias, _noise(data, weights, bias))


def score_of(text: Column, spark: SparkSession, model: Model, flag: float | None = None) -> Column:
    """Score of a column of whole texts; with ``flag``, a struct with the ``sentences`` that reach it."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        of = sent.value.scorer()
        return pd.Series([sent.value.document(*of(t)) for t in texts], dtype=float)

    @F.pandas_udf("score double, sentences array<struct<number:int,score:double>>")
    def located(texts: pd.Series) -> pd.DataFrame:
        of = sent.value.scorer()
        total, places = [], []
        for text in texts:
            found, counted = of(text)
            total.append(sent.value.document(found, counted))
            places.append([{"number": i, "score": p} for i, p in found if p >= flag])
        return pd.DataFrame({"score": pd.Series(total, dtype=float), "sentences": places})

    return scores(text) if flag is None else located(text)


def score(docs: DataFrame, model: Model, text_col: str = "text", flag: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from one half on) and ``sentences``.

    ``sentences`` lists the offending ones, ``(number, score)`` of sentences with a score of ``flag`` or
    more, in order of the text. Whole texts are read. A null or empty text is one sentence without words
    and gets the model's lowest score. The columns replace any of the same name; rows are scored one by
    one, so repeated rows and ties get equal scores; no rows give no rows.
    """
    scored = score_of(F.col(text_col), docs.sparkSession, model, flag)
    out = docs.withColumn("__scored", scored)
    return out.withColumns({
        "score": F.col("__scored.score"),
        "predicted": (F.col("__scored.score") >= 0.5).cast("int"),
        "sentences": F.col("__scored.sentences"),
    }).drop("__scored")
