"""Toxicity by non-negative positive-unlabelled learning.

The classifier learns from confirmed toxic texts and from texts without any
label. With the class prior p, the risk of a scorer is
``p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives))``: the second
part is what the unlabelled rows would cost as negatives, corrected by the
share of positives among them, and never less than zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import NOT_ALNUM, Words, chunks, mix
from tidemark.llm.sampling import chance
from tidemark.llm.ship import ship

_BITS = 20
_LOW = (1 << _BITS) - 1
_PREFIXES = (4, 5, 6, 7, 8)
# A feature counts by its rate per 50 words, so that long texts are not toxic by
# chance; the extra words keep very short ones in bounds, as does the cap.
_PER, _EXTRA, _CAP = 50.0, 10.0, 3.0


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and of the features it may use."""

    positives: int = 1500  # the documented bounds of the training sample
    unlabelled: int = 3000
    features: int = 512
    least_rows: int = 4
    least_ratio: float = 3.0
    least_z: float = 4.5
    rounds: int = 800
    rate: float = 0.05
    weight_decay: float = 2e-4
    seed: int = 11


@dataclass
class Model:
    """Sparse weights of hashed features and the constant term."""

    features: np.ndarray
    weights: np.ndarray
    constant: float


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature) of every word and word beginning of a chunk, repeats included, and words a row."""
    words = Words(raw, offsets, NOT_ALNUM)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.rows))
    length = words.ends - words.starts
    rows, found = [row], [words.hashes]
    for size in _PREFIXES:
        long = np.flatnonzero(length >= size)
        start = words.starts[long]
        rows.append(row[long])
        found.append(mix(words.hasher(start, start + size) ^ np.uint64(size)))
    feature = np.concatenate(found) >> np.uint64(64 - _BITS)
    return np.concatenate(rows), feature.astype(np.int64), np.diff(words.rows)


def _rate(count: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.minimum(_CAP, _PER * count / (n_words + _EXTRA))


def _sampled(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            row, feature, n_words = features(raw, offsets)
            distinct, count = np.unique(row << _BITS | feature, return_counts=True)
            bounds = np.searchsorted(distinct >> _BITS, np.arange(last - first + 1))
            rate = _rate(count, n_words[distinct >> _BITS]).astype("<f2")
            low = (distinct & _LOW).astype("<i4")
            spans = list(zip(bounds[:-1], bounds[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("positive").slice(first, last - first),
                    pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([rate[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["positive", "found", "rate"],
            )


def nn_pu(x_p: np.ndarray, x_u: np.ndarray, prior: float, how: Settings) -> tuple[np.ndarray, float]:
    """Weights and constant of the logistic scorer of least non-negative PU risk."""
    w, b = np.zeros(x_p.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for turn in range(1, how.rounds + 1):
        z_p, z_u = x_p @ w + b, x_u @ w + b
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        s_p, s_u = sigmoid(z_p), sigmoid(z_u)
        d_u, d_p = s_u / len(s_u), -prior * s_p / len(s_p)
        if negative < 0:  # below zero it is overfitting: step back up instead
            d_u, d_p = -d_u, -d_p
        else:
            d_p = d_p + prior * (s_p - 1) / len(s_p)
        grad = np.append(x_p.T @ d_p + x_u.T @ d_u + how.weight_decay * w, d_p.sum() + d_u.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        step = how.rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, how: Settings = Settings()) -> Model:
    """Learn from ``docs`` (doc_id, text) and the toxic rows of ``labels`` (doc_id, toxic).

    Only rows where ``train_on`` (a condition on doc_id) holds are learned from;
    the sample is bounded by ``positives`` and ``unlabelled`` texts, picked by a
    hash. The class prior is the share of toxic rows among those labels. A doc
    labelled twice counts as toxic if any label says so. Without a toxic text
    the model scores nothing.
    """
    ship(docs.sparkSession)
    known = labels.where(train_on & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") > 0).cast("long"))).first()
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), -30.0)
    if not n_toxic:
        return nothing
    prior = min(max(n_toxic / n_known, 1e-4), 0.99)
    # No more rows than the sample's bound are broadcast.
    toxic = known.where((F.col("toxic") > 0) & (chance(how.seed, "doc_id") < how.positives / n_toxic))
    toxic = F.broadcast(toxic.select("doc_id").limit(2 * how.positives))
    learn = docs.where(train_on & F.col("text").isNotNull()).select("doc_id", "text")
    n_learn = max(1, learn.count())
    positives = learn.join(toxic, "doc_id", "left_semi").select(F.lit(True).alias("positive"), "text")
    others = learn.where(chance(how.seed + 1, "doc_id") < how.unlabelled / n_learn)
    others = others.select(F.lit(False).alias("positive"), "text").limit(2 * how.unlabelled)
    sample = positives.unionAll(others).mapInArrow(_sampled, "positive boolean, found binary, rate binary").collect()
    sample.sort(key=lambda r: (r["found"], r["rate"]))  # rows arrive in any order
    found = {True: [], False: []}
    for r in sample:
        found[r["positive"]].append((np.frombuffer(r["found"], "<i4"), np.frombuffer(r["rate"], "<f2")))
    if not found[True] or not found[False]:
        return nothing
    counts = {
        kind: np.bincount(np.concatenate([features for features, _ in rows]), minlength=1 << _BITS)
        for kind, rows in found.items()
    }
    rate_p, rate_u = counts[True] / len(found[True]), counts[False] / len(found[False])
    spread = np.sqrt(rate_u * (1 - rate_u) / len(found[True]) + 0.25 / len(found[True]) ** 2)
    z = (rate_p - rate_u) / spread
    good = (counts[True] >= how.least_rows) & (rate_p >= how.least_ratio * rate_u) & (z >= how.least_z)
    chosen = np.flatnonzero(good)
    chosen = np.sort(chosen[np.argsort(-z[chosen], kind="stable")][: how.features])
    place = np.full(1 << _BITS, -1)
    place[chosen] = np.arange(len(chosen))

    def matrix(rows):
        x = np.zeros((len(rows), len(chosen)), dtype=np.float32)
        for i, (row, rate) in enumerate(rows):
            at = place[row]
            x[i, at[at >= 0]] = rate[at >= 0]
        return x

    w, b = nn_pu(matrix(found[True]), matrix(found[False]), prior, how)
    return Model(chosen, w, b)


def _scored(batches, model: Model, text: int, kept: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    weight = np.zeros(1 << _BITS)
    weight[model.features] = model.weights
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column(text)):
            row, feature, n_words = features(raw, offsets)
            live = np.flatnonzero(weight[feature])
            distinct, count = np.unique(row[live] << _BITS | feature[live], return_counts=True)
            part = weight[distinct & _LOW] * _rate(count, n_words[distinct >> _BITS])
            z = np.bincount(distinct >> _BITS, part, minlength=last - first)
            score = 1 / (1 + np.exp(-np.clip(z + model.constant, -30, 30)))
            columns = [c.slice(first, last - first) for c in batch.columns[:kept]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=names)


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns of ``keep`` and the score (0 to 1) of every whole text.

    Null and empty texts have the score of a text without any known word. Each
    row is scored for itself; an empty table gives no row. ``name`` must not be
    in ``keep``.
    """
    ship(docs.sparkSession)
    keep = list(keep)
    rows = docs.select(*keep, *([] if "text" in keep else [F.col("text").alias("_text")]))
    schema = docs.select(*keep).schema.add(name, "double")
    text = keep.index("text") if "text" in keep else len(keep)
    return rows.mapInArrow(lambda batches: _scored(batches, model, text, len(keep), [*keep, name]), schema)
