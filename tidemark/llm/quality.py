"""Quality by weak labels: overlapping heuristics, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good, bad or nothing on a text. Expectation-maximisation
over the counts of all vote patterns, which are few whatever the corpus,
estimates how often each labeller votes what on good and on bad texts. The
posterior of its pattern is a text's soft label, and a linear model over
hashed features learns it from a bounded sample, so that the score also sees
what no labeller looks at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import Words, chunks, mix
from tidemark.llm.sampling import chance
from tidemark.llm.ship import ship

GOOD, BAD, NONE = 1, 2, 0
_BITS = 18


@dataclass(frozen=True)
class Settings:
    sample: int = 6000  # the documented bound of the training sample
    rounds: int = 200
    prior: float = 0.8
    rate: float = 0.05
    steps: int = 300
    weight_decay: float = 1e-4
    seed: int = 13


def _classes() -> np.ndarray:
    """One class for every byte."""
    found = np.full(256, _OTHER, dtype=np.uint8)
    found[128:] = _LETTER
    members = {
        _LETTER: "abcdefghijklmnopqrstuvwxyz",
        _UPPER: "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        _DIGIT: "0123456789",
        _SYMBOL: "#*$&|~^<>{}=_\\%@+",
        _PERIOD: ".",
        _LOUD: "!?",
        _STOP: ",;:'\"()-",
        _SPACE: " \t\n\v\f\r",
    }
    for kind, characters in members.items():
        found[[ord(c) for c in characters]] = kind
    return found


_OTHER, _LETTER, _UPPER, _DIGIT, _SYMBOL, _PERIOD, _LOUD, _STOP, _SPACE = range(9)
_CLASS = _classes()
_CLOSING = np.isin(_CLASS, [_PERIOD, _LOUD])
_PLAIN = ~np.isin(_CLASS, [_OTHER, _SYMBOL, _SPACE]) & ~np.isin(np.arange(256), [ord("("), ord("-")])


def measures(raw: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Numbers about each row of a chunk that the labellers and features read, and its words.

    The words are distinct numbers row << _BITS | hashed word.
    """
    rows = len(offsets) - 1
    of_byte = np.repeat(np.arange(0, rows * 16, 16), np.diff(offsets))
    n = np.bincount(of_byte + _CLASS[raw], minlength=rows * 16).reshape(rows, 16).astype(np.float64)
    words = Words(raw, offsets)
    n_words = np.diff(words.rows).astype(np.float64)
    solid = np.maximum(np.diff(offsets) - n[:, _SPACE], 1)
    letters = n[:, _LETTER] + n[:, _UPPER]
    row = np.repeat(np.arange(rows), np.diff(words.rows))
    found = np.unique(row << _BITS | (words.hashes >> np.uint64(64 - _BITS)).astype(np.int64))
    last = raw[words.ends - 1] if len(row) else raw[:0]

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=rows) / np.maximum(n_words, 1)

    odd = ~_PLAIN[last]
    again = np.zeros(len(row), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    # Lines: bounds at line ends and at the bounds of rows.
    breaks = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, offsets]))
    starts, ends = breaks[:-1], breaks[1:]
    long = ends - starts > 20
    starts, ends = starts[long], ends[long]
    line_row = np.searchsorted(offsets, starts, side="right") - 1
    lines = np.bincount(line_row, minlength=rows).astype(np.float64)
    hashes = words.hasher(starts, ends - (raw[ends - 1] == 10)) if len(starts) else np.zeros(0, np.uint64)
    _, own = np.unique(hashes ^ mix(line_row.astype(np.uint64)), return_index=True)
    own = np.bincount(line_row[own], minlength=rows)
    return {
        "words": n_words,
        "word_length": solid / np.maximum(n_words, 1),
        "ordinary": (letters + n[:, _PERIOD] + n[:, _LOUD] + n[:, _STOP]) / solid,
        "upper": n[:, _UPPER] / np.maximum(letters, 1),
        "digits": n[:, _DIGIT] / solid,
        "symbols": n[:, _SYMBOL] / solid,
        "loud": n[:, _LOUD] / np.maximum(n_words, 1),
        "endings": per_word(_CLOSING[last]),
        "marked": per_word(odd),
        "single": per_word(odd & (words.ends - words.starts == 1)),
        "distinct": np.bincount(found >> _BITS, minlength=rows) / np.maximum(n_words, 1),
        "repeated_words": per_word(again),
        "repeated_lines": np.where(lines > 0, 1 - own / np.maximum(lines, 1), 0.0),
    }, found


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """Votes (labellers x rows) of the heuristics."""

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, NONE)).astype(np.int64)

    some, several, longer = (m["words"] >= n for n in (3, 8, 20))
    return np.stack(
        [
            vote(m["symbols"] > 0.02, m["symbols"] < 0.002),
            vote(several & (m["ordinary"] < 0.85), m["ordinary"] > 0.93),
            vote(some & (m["marked"] > 0.1), m["marked"] < 0.02),
            vote(some & (m["single"] > 0.15), m["single"] < 0.02),
            vote(some & (m["upper"] > 0.3), several & (m["upper"] < 0.12)),
            vote(some & (m["loud"] > 0.15), several & (m["loud"] < 0.05)),
            vote(several & (m["endings"] > 0.6), several & (m["endings"] > 0.02) & (m["endings"] < 0.35)),
            vote(longer & (m["distinct"] < 0.2), longer & (m["distinct"] > 0.5)),
            vote(m["repeated_words"] > 0.3, several & (m["repeated_words"] < 0.1)),
            vote(m["repeated_lines"] > 0.4, several & (m["repeated_lines"] < 0.1)),
            vote(some & ((m["word_length"] < 2.2) | (m["word_length"] > 16)), (m["word_length"] > 3) & (m["word_length"] < 12)),
        ]
    )


LABELLERS = 11
MEASURES = 13


def patterns(given: np.ndarray) -> np.ndarray:
    """One number for the votes of each row."""
    return (given * 3 ** np.arange(LABELLERS)[:, None]).sum(axis=0)


def unpacked(pattern: np.ndarray) -> np.ndarray:
    return np.stack([pattern // 3**i % 3 for i in range(LABELLERS)])


def accuracies(pattern: np.ndarray, count: np.ndarray, how: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """EM: (chance of each vote by class, good first: labellers x votes x 2, posterior of good by pattern).

    Labellers are taken as independent within a class, and no vote tells
    nothing. The start believes each of them somewhat, which fixes which class
    is the good one.
    """
    given = unpacked(pattern)
    # A good text seldom gets a bad vote, a bad one gets some of them.
    chance_of = np.ones((LABELLERS, 3, 2))
    chance_of[:, GOOD] = [0.99, 0.75]
    chance_of[:, BAD] = [0.01, 0.25]
    prior = how.prior
    for _ in range(how.rounds):
        log = np.log([prior, 1 - prior])[None] + sum(np.log(chance_of[i][given[i]]) for i in range(LABELLERS))
        p = np.exp(log - log.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weight = p * count[:, None]
        moved = np.ones_like(chance_of)
        for i in range(LABELLERS):
            voted = {vote: weight[given[i] == vote].sum(axis=0) + 0.5 for vote in (GOOD, BAD)}
            for vote in (GOOD, BAD):
                moved[i, vote] = voted[vote] / (voted[GOOD] + voted[BAD])
        prior = (weight[:, 0].sum() + 1) / (weight.sum() + 2)
        ended = np.abs(moved - chance_of).max() < 1e-9
        chance_of = moved
        if ended:
            break
    return chance_of, p[:, 0]


def _buckets(m: dict[str, np.ndarray]) -> np.ndarray:
    """The hashed features of the measures (rows x measures)."""
    found = []
    for i, (name, values) in enumerate(m.items()):
        scaled = np.log2(values + 1) * 2 if name in ("words", "word_length") else np.sqrt(np.maximum(values, 0)) * 12
        bucket = mix(np.clip(scaled, 0, 60).astype(np.uint64) + np.uint64(100 * (i + 1)))
        found.append((bucket >> np.uint64(64 - _BITS)).astype(np.int64))
    return np.stack(found, axis=1)


def _voted(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [patterns(votes(measures(raw, offsets)[0])) for _, _, raw, offsets in chunks(batch.column("text"))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int32))], names=["pattern"])


def _sampled(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            m, distinct = measures(raw, offsets)
            buckets = _buckets(m)
            bounds = np.searchsorted(distinct >> _BITS, np.arange(last - first + 1))
            low, buckets = (distinct & ((1 << _BITS) - 1)).astype("<i4"), buckets.astype("<i4")
            # The measures' features come first, as many in every row.
            found = [
                row.tobytes() + low[a:b].tobytes()
                for row, a, b in zip(buckets, bounds[:-1], bounds[1:], strict=True)
            ]
            pattern = patterns(votes(m)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pattern), pa.array(found, pa.binary())], names=["pattern", "found"]
            )


def _fit_scorer(rows: list[np.ndarray], target: np.ndarray, how: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels by Adam; the words of a row count by their mean, measures in full."""
    weights, constant = np.zeros(1 << _BITS), 0.0
    flat = np.concatenate(rows)
    sizes = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    nth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    value = np.where(nth < MEASURES, 1.0, 1 / np.sqrt(np.maximum(sizes - MEASURES, 1))[row])
    used, flat = np.unique(flat, return_inverse=True)
    w = np.zeros(len(used))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for turn in range(1, how.steps + 1):
        z = np.bincount(row, w[flat] * value, len(rows)) + constant
        gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        grad = np.bincount(flat, gap[row] * value, len(used)) + how.weight_decay * w / len(rows)
        grad = np.append(grad, gap.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        step = how.rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-9)
        w, constant = w - step[:-1], constant - step[-1]
    weights[used] = w
    return weights, constant


def _scored(batches, model, posterior) -> Iterator[pa.RecordBatch]:
    weights, constant = model.value
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            m, distinct = measures(raw, offsets)
            pattern, buckets = patterns(votes(m)), _buckets(m)
            row = distinct >> _BITS
            sizes = np.maximum(np.bincount(row, minlength=last - first), 1)
            z = np.bincount(row, weights[distinct & ((1 << _BITS) - 1)], last - first) / np.sqrt(sizes)
            z += weights[buckets].sum(axis=1) + constant
            given = unpacked(pattern)
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.slice(first, last - first) for c in batch.columns[:-1]),
                    pa.array((given == GOOD).sum(axis=0).astype(np.int32)),
                    pa.array((given == BAD).sum(axis=0).astype(np.int32)),
                    pa.array([posterior.get(int(p), 0.0) for p in pattern], pa.float64()),
                    pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))),
                ],
                names=[*batch.schema.names[:-1], "good_votes", "bad_votes", "posterior", "score"],
            )


def classify(docs: DataFrame, keep: Sequence[str] = ("doc_id",), how: Settings = Settings()) -> DataFrame:
    """The columns of ``keep`` (others than text), good_votes, bad_votes, posterior and score of every whole text.

    ``posterior`` is the label model's chance that the text is good given its
    votes, ``score`` the linear model's. The votes of all rows are counted; the
    linear model sees at most about ``sample`` of the different texts, picked by
    a hash, so copies count once in it. Null counts as empty. Each row
    is scored for itself; an empty table gives no row.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counted = rows.select("text").mapInArrow(_voted, "pattern int").groupBy("pattern").count()
    counted = {r["pattern"]: r["count"] for r in counted.collect()}  # at most 3 ** LABELLERS rows
    schema = rows.select(*keep).schema
    for name, kind in (("good_votes", "integer"), ("bad_votes", "integer"), ("posterior", "double"), ("score", "double")):
        schema = schema.add(name, kind)
    if not counted:
        return spark.createDataFrame([], schema)
    seen = np.array(sorted(counted))
    _, good = accuracies(seen, np.array([counted[p] for p in seen.tolist()], dtype=np.float64), how)
    posterior = dict(zip(seen.tolist(), good.tolist(), strict=True))
    share = how.sample / sum(counted.values())
    picked = chance(how.seed, "text")
    sample = rows.where(picked < share).select("text").distinct().orderBy(picked, "text").limit(2 * how.sample)
    sample = sample.mapInArrow(_sampled, "pattern int, found binary").collect()
    sample.sort(key=lambda r: r["found"])
    weights, constant = np.zeros(1 << _BITS), 0.0
    if sample:
        found = [np.frombuffer(r["found"], "<i4") for r in sample]
        weights, constant = _fit_scorer(found, np.array([posterior[r["pattern"]] for r in sample]), how)
    model = spark.sparkContext.broadcast((weights.astype(np.float32), constant))
    return rows.mapInArrow(lambda batches: _scored(batches, model, posterior), schema)
