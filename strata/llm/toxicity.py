"""Toxicity severity by cumulative-link ordinal regression.

``P(grade <= k) = sigmoid(threshold_k - w.x)``: one sparse weight vector ``w``
for all grades, ordered thresholds between them.  Features are the distinct words of a text (letters
only, lower-cased) and the words' beginnings of ``STEMS`` letters, which tie
inflected forms together, and the same again for those that occur twice or
more, by their 64-bit fingerprints.  The fit takes a bounded,
hash-chosen sample of at most ``max_labelled`` labelled documents, lets Spark
count features by grade and keeps the ``max_features`` whose use differs most, and runs
accelerated proximal gradient steps with an L1 penalty, so most weights are
zero.  Scoring reads every document whole, in place, without a shuffle; the
model (at most ``max_features`` weights) travels with the tasks.

The result is the expected severity ``sum_k k * P(grade = k)``, the likeliest side of
the first threshold (``toxic``: P(grade >= 1) is at least ``reject``) and the grade.

Defined results: null and empty texts have no features and get the score of
the thresholds alone; labels without grade or document are ignored, several
labels of one document count with the highest grade; without labelled
documents both of grade 0 and above nothing can be learnt and every severity is
0; repeated rows are scored each; an empty table gives an empty result; other columns are
ignored by ``severity`` and passed through by ``drop_toxic``."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.words import bounded, spread, split_words, texts_of
from strata.session import scratch_path

MAX_LABELLED = 8000
MAX_FEATURES = 4096
MIN_DOCS = 3
MIN_Z = 3.0
PENALTY = 0.0001
STEPS = 400
STEMS = (4, 5, 6)
REJECT = 0.5
LETTERS = re.compile(r"[^\W\d_]+")


def fingerprint(word: str) -> int:
    """Even, and within a signed 64-bit column; the odd number above stands for a second occurrence."""
    return xxhash.xxh64_intdigest(word) >> 2 << 1


def word_features(word: str) -> list[int]:
    """The word and its beginnings (marked, so that none is a word)."""
    return [fingerprint(word)] + [fingerprint(word[:n] + "-") for n in STEMS if len(word) >= n]


def chunk_features(chunk: str) -> list[int]:
    low = chunk.lower()
    return word_features(low) if low.isalpha() else [f for w in LETTERS.findall(low) for f in word_features(w)]


def text_features(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, sorted; with ``known`` (sorted) only those features."""
    offsets, codes, chunks = split_words(texts)
    found = list(map(chunk_features, chunks))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((f for o in found for f in o), np.int64, int(lengths.sum()))
    if known is not None:  # before the words are spread over the texts: few are left
        first = flat >> 1 << 1
        at = np.searchsorted(known, first)
        use = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == first) if len(known) else np.zeros(len(flat), bool)
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[use], minlength=len(lengths))
        flat = flat[use]
    offsets, values = spread(codes, offsets, lengths, flat)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    twice = np.zeros(len(text), bool)
    twice[1:] = ~new[1:] & new[:-1]
    return np.concatenate([text[new], text[twice]]), np.concatenate([values[new], values[twice] + 1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    """Weights by feature and ordered thresholds (one fewer than grades)."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score (rows) and threshold (columns)."""
        return sigmoid(score[:, None] - np.array(self.thresholds, float)[None, :])


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, grades: np.ndarray, penalty: float = PENALTY,
                steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the L1-penalised cumulative-link model on 0/1
    features given as (row, column) pairs.  ``grades`` run from 0."""
    k = int(grades.max())
    share = np.array([np.clip(np.mean(grades <= j), 1e-6, 1 - 1e-6) for j in range(k)])
    theta = np.log(share / (1 - share))
    free = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])  # first threshold, log gaps
    w = np.zeros(n_cols)
    per_row = max(1.0, float(np.bincount(rows, minlength=n_rows).max(initial=1)))
    rate, fast = 4.0 / (np.sqrt(per_row) + 1), 1.0
    look_w, look_f = w.copy(), free.copy()
    order = np.argsort(cols, kind="stable")
    by_row, by_col = rows[order], cols[order]

    def loss(w: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        theta = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        score = np.bincount(rows, weights=w[cols], minlength=n_rows)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = sigmoid(edge[grades + 1] - score), sigmoid(edge[grades] - score)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_score = (d_hi - d_lo) / n_rows
        g_theta = np.array([np.sum(d_lo[grades == j + 1]) - np.sum(d_hi[grades == j]) for j in range(k)]) / n_rows
        back = np.cumsum(g_theta[::-1])[::-1]
        g_free = back * np.concatenate([[1.0], np.exp(free[1:])])
        return -float(np.mean(np.log(p))), np.bincount(by_col, weights=g_score[by_row], minlength=n_cols), g_free

    for _ in range(steps):
        value, g_w, g_f = loss(look_w, look_f)
        while True:  # halve the step until the quadratic bound holds
            new_w = look_w - rate * g_w
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
            new_f = look_f - rate * g_f
            d_w, d_f = new_w - look_w, new_f - look_f
            bound = value + g_w @ d_w + g_f @ d_f + (d_w @ d_w + d_f @ d_f) / (2 * rate)
            if rate < 1e-6 or loss(new_w, new_f)[0] <= bound + 1e-12:
                break
            rate /= 2
        faster = (1 + np.sqrt(1 + 4 * fast * fast)) / 2
        look_w = new_w + (fast - 1) / faster * (new_w - w)
        look_f = new_f + (fast - 1) / faster * (new_f - free)
        done = np.abs(new_w - w).max(initial=0) < 1e-5 and np.abs(new_f - free).max() < 1e-5
        w, free, fast, rate = new_w, new_f, faster, rate * 1.1
        if done:
            break
    return w, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each labelled document."""
    for batch in bounded(batches):
        text, values = text_features(texts_of(batch.column("text")))
        order = np.argsort(text, kind="stable")
        ends = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), lists], ["doc_id", "grade", "features"])


def _places(chosen: np.ndarray) -> Callable:
    """Each document's chosen features, as raw 32-bit places among them (``chosen`` is sorted)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.flatnonzero(np.isin(chosen, f.values.to_numpy(zero_copy_only=False))).astype("<i4").tobytes() for f in batch.column("features")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(raw, pa.binary())], ["doc_id", "grade", "places"])
    return run


def choose_features(rows: DataFrame, max_features: int = MAX_FEATURES) -> np.ndarray:
    """The features whose share of documents differs most between grade 0 and
    the rest (two-sample z), counted in Spark; at most ``max_features``, sorted."""
    n1, n0 = rows.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") == 0)).first()
    if not n1 or not n0:
        return np.empty(0, np.int64)
    counts = rows.select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("grade") > 0).alias("c1"), F.count_if(F.col("grade") == 0).alias("c0")).filter(F.col("c1") + F.col("c0") >= MIN_DOCS)
    p = (F.col("c1") + F.col("c0")) / (n1 + n0)
    z = F.abs(F.col("c1") / n1 - F.col("c0") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n1 + 1 / n0))
    best = counts.withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(max_features)
    return np.array(sorted(r["feature"] for r in best.select("feature").collect()), np.int64)


def fit_places(names: np.ndarray, found: list[np.ndarray], labels: list[int], penalty: float = PENALTY) -> OrdinalModel:
    """The model of documents given by the places of their features in ``names`` and their grades."""
    levels = sorted(set(labels))
    grades = np.array([levels.index(x) for x in labels])
    at = np.repeat(np.arange(len(found)), [len(f) for f in found])
    w, theta = fit_ordinal(at, np.concatenate(found).astype(np.int64), len(found), len(names), grades, penalty)
    return OrdinalModel({int(c): float(x) for c, x in zip(names, w) if x}, theta.tolist())


def fit(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on at most ``max_labelled`` labelled documents, those with the
    smallest hash of their id; ``grade`` is an integer column of ``labels``."""
    ship_package(docs.sparkSession)
    graded = labels.select(F.col(id_col).cast("long").alias("doc_id"), grade.cast("int").alias("grade")).dropna()
    sample = graded.groupBy("doc_id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the sample has max_labelled rows at most, so it is broadcast; one row per document is used
    rows = texts.join(F.broadcast(sample), "doc_id").mapInArrow(_features, "doc_id long, grade int, features array<long>")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("features", "grade")).alias("one")).select("doc_id", "one.*")
    path = scratch_path(docs.sparkSession, "labelled")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    chosen = choose_features(rows, max_features)
    if not rows.filter("grade = 0").limit(1).count() or not rows.filter("grade > 0").limit(1).count():
        return OrdinalModel()
    small = rows.mapInArrow(_places(chosen), "doc_id long, grade int, places binary").orderBy("doc_id").collect()
    return fit_places(chosen, [np.frombuffer(r["places"], "<i4") for r in small], [r["grade"] for r in small])


def score_texts(model: OrdinalModel, texts: pa.Array) -> np.ndarray:
    """``w.x`` of each text."""
    known = np.unique(np.array(sorted(model.weights), np.int64) >> 1 << 1)
    text, values = text_features(texts, known)
    get = model.weights.get
    x = np.fromiter((get(f, 0.0) for f in values.tolist()), float, len(values))
    return np.bincount(text, weights=x, minlength=len(texts))


def _score(model: OrdinalModel, reject: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            above = model.above(score_texts(model, texts_of(batch.column("text"))))
            grade = (above >= reject).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1), pa.float64()), pa.array(grade, pa.int32()), pa.array(grade > 0)],
                ["doc_id", "expected_severity", "grade", "toxic"])
    return run


def _keep(model: OrdinalModel, reject: float, text: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text):
            above = model.above(score_texts(model, texts_of(batch.column(text))))
            yield batch.filter(pa.array((above >= reject).sum(axis=1) == 0))
    return run


def severity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected_severity, grade, toxic."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_score(model, reject), "doc_id long, expected_severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all their columns as they are."""
    ship_package(docs.sparkSession)
    return docs.mapInArrow(_keep(model, reject, text_col), docs.schema)
