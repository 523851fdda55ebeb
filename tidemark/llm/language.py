"""Language identification by a byte convolutional network trained in numpy.

Bytes are embedded, filters of several widths run over them, each filter keeps
its maximum over a window of fixed length, and a softmax layer reads the
maxima. A text is the mean of its windows' probabilities; windows overlap by
one filter width, so every byte sequence of the whole text is seen.

When predicting, a filter of width w over embedded bytes is a sum of table
look-ups by byte pairs, so the convolution costs a few gathers a byte.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import chunks
from tidemark.llm.sampling import chance
from tidemark.llm.ship import ship

UNDETERMINED = "und"
_BLOCK = 256
_LEAST_JUNK = 32  # bytes: shorter texts do not tell whether they are junk


@dataclass(frozen=True)
class Settings:
    """Shape of the network, and the bound of what it is trained on."""

    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    window: int = 256
    windows_per_language: int = 1500  # the documented bound of the training sample
    windows_per_text: int = 8
    epochs: int = 6
    batch: int = 64
    rate: float = 0.004
    seed: int = 7


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    window: int


def _forward(model: Model, rows: np.ndarray):
    """Features (maxima above zero), and per width the patches and where the maxima are."""
    seen = model.embed[rows]
    n, length, size = seen.shape
    kept, parts = [], []
    for kernel, bias in zip(model.kernels, model.biases, strict=True):
        width = kernel.shape[0] // size
        stride = seen.strides
        patches = np.lib.stride_tricks.as_strided(
            seen, (n, length - width + 1, width * size), (stride[0], stride[1], stride[2])
        )
        response = patches.reshape(-1, width * size) @ kernel
        response = response.reshape(n, length - width + 1, -1)
        at = response.argmax(axis=1)
        top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + bias
        kept.append((width, at, patches))
        parts.append(top)
    raw = np.concatenate(parts, axis=1)
    return np.maximum(raw, 0), raw > 0, kept


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], how: Settings) -> Model:
    """Fit the network to windows (n x window bytes) by Adam on the cross entropy."""
    rng = np.random.default_rng(how.seed)

    def start(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    total = how.filters * len(how.widths)
    model = Model(
        languages,
        rng.normal(0, 1, (256, how.embedding)).astype(np.float32),
        [start(w * how.embedding, how.filters) for w in how.widths],
        [np.zeros(how.filters, np.float32) for _ in how.widths],
        start(total, len(languages)),
        np.zeros(len(languages), np.float32),
        how.window,
    )
    weights = [model.embed, *model.kernels, *model.biases, model.out, model.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    turn = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), how.batch):
            pick = order[begin : begin + how.batch]
            x, y = rows[pick], labels[pick]
            features, live, kept = _forward(model, x)
            logits = features @ model.out + model.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ model.out.T) * live
            d_embed = np.zeros_like(model.embed)
            d_kernels, d_biases = [], []
            for i, (width, at, patches) in enumerate(kept):
                g = back[:, i * how.filters : (i + 1) * how.filters]
                hit = patches[np.arange(len(y))[:, None], at]
                d_kernels.append(np.einsum("bf,bfk->kf", g, hit))
                d_biases.append(g.sum(axis=0))
                spread = (g[:, :, None] * model.kernels[i].T[None]).reshape(-1, how.embedding)
                where = at[:, :, None] + np.arange(width)
                np.add.at(d_embed, np.take_along_axis(x, where.reshape(len(y), -1), axis=1).reshape(-1), spread)
            grads = [d_embed, *d_kernels, *d_biases, features.T @ p, p.sum(axis=0)]
            turn += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= how.rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return model


class Predictor:
    """Applies a model to windows through tables over byte pairs."""

    def __init__(self, model: Model):
        size = model.embed.shape[1]
        self.model, self.tables = model, []
        for kernel in model.kernels:
            width = kernel.shape[0] // size
            # What each byte adds at each place of the filter; pairs of places are merged.
            single = [model.embed @ kernel[k * size : (k + 1) * size] for k in range(width)]
            steps = []
            for k in range(0, width - 1, 2):
                steps.append((k, (single[k][:, None, :] + single[k + 1][None]).reshape(65536, -1)))
            self.tables.append((width, steps, single[-1] if width % 2 else None))
        self.overlap = max(width for width, _, _ in self.tables) - 1

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        found = []
        for begin in range(0, len(rows), _BLOCK):
            block = np.ascontiguousarray(rows[begin : begin + _BLOCK].T).astype(np.intp)
            pair = block[:-1] * 256 + block[1:]
            parts = []
            for (width, steps, last), bias in zip(self.tables, self.model.biases, strict=True):
                n = len(block) - width + 1
                response = steps[0][1][pair[:n]]
                for k, table in steps[1:]:
                    response += table[pair[k : k + n]]
                if last is not None:
                    response += last[block[width - 1 :]]
                parts.append(np.maximum(response.max(axis=0) + bias, 0))
            logits = np.concatenate(parts, axis=1) @ self.model.out + self.model.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            found.append(p / p.sum(axis=1, keepdims=True))
        return np.concatenate(found)

    def texts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of the windows of each row of a chunk."""
        window = self.model.window
        sizes = np.diff(offsets)
        step = window - self.overlap
        count = np.maximum(1, -(-(sizes - self.overlap) // step))
        row = np.repeat(np.arange(len(sizes)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        total = np.zeros((len(sizes), len(self.model.languages)))
        for begin in range(0, len(row), 4 * _BLOCK):
            part = slice(begin, begin + 4 * _BLOCK)
            at = (offsets[row[part]] + nth[part] * step)[:, None] + np.arange(window)
            inside = at < offsets[row[part] + 1][:, None]
            windows = np.where(inside, raw[np.minimum(at, max(0, len(raw) - 1))] if len(raw) else 0, 0)
            np.add.at(total, row[part], self.probabilities(windows.astype(np.uint8)))
        return total / count[:, None]


@lru_cache(maxsize=2)
def _predictor(model: bytes) -> Predictor:
    return Predictor(pickle.loads(model))


def junk(windows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` windows in no language: letters of given windows in another order, and random ones.

    Letters change places inside words or over the whole window; random ones
    are keys, base64, hexadecimal digits, and neighbouring code points.
    """
    size = windows.shape[1]
    made = np.zeros((n, size), dtype=np.uint8)
    keys = (b"abcdefghijklmnopqrstuvwxyz     ", b"0123456789abcdef")
    base64 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for i in range(n):
        kind = i % 10
        if kind < 7:
            given = windows[rng.integers(len(windows))].tobytes().rstrip(b"\0").decode("utf-8", "ignore")
            parts = [given] if kind < 3 else given.split(" ")
            part = " ".join("".join(rng.permutation(list(p))) for p in parts).encode()
        elif kind == 7:
            chosen = np.frombuffer(keys[int(rng.integers(4) == 0)], np.uint8)
            part = chosen[rng.integers(0, len(chosen), size)].tobytes()
        elif kind == 8:
            part = np.frombuffer(base64, np.uint8)[rng.integers(0, 64, size)].tobytes()
        else:
            first = int(rng.integers(0x250, 0xD000))
            points = np.where(rng.random(size) < 0.15, 32, first + rng.integers(0, 90, size))
            part = "".join(map(chr, points)).encode()
        # Every third is short, as texts and last windows can be.
        part = part[: size if i % 3 else rng.integers(min(_LEAST_JUNK, size), size + 1)]
        made[i, : len(part)] = np.frombuffer(part, np.uint8)
    return made


def fit(docs: DataFrame, train_on: Column, how: Settings = Settings(), reject: bool = False) -> Model | None:
    """Learn from the rows of ``docs`` (text, lang) where ``train_on`` holds.

    With ``reject``, ``und`` is learned as one more language, from ``junk``.

    The sample is bounded: about ``windows_per_language`` windows of each
    language, twice as many at most, at random places of different texts picked
    by a hash of the whole text.
    None if no such row has a language and a text.
    """
    rows = docs.where(train_on & F.col("lang").isNotNull() & (F.length("text") > 0)).select("text", "lang")
    counted = {str(r["lang"]): r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counted:
        return None
    languages = sorted(counted)
    each = {lang: min(how.windows_per_text, max(1, -(-how.windows_per_language // n))) for lang, n in counted.items()}
    wanted = [(lang, each[lang], 1.2 * how.windows_per_language / (each[lang] * n)) for lang, n in counted.items()]
    # A row a language.
    wanted = F.broadcast(rows.sparkSession.createDataFrame(wanted, "lang string, each int, share double"))
    picked = rows.select(F.col("lang").cast("string").alias("lang"), "text").join(wanted, "lang")
    picked = picked.where(chance(how.seed, "text") < F.col("share")).dropDuplicates(["lang", "text"])
    picked = picked.select("lang", "text", F.explode(F.sequence(F.lit(1), F.col("each"))).alias("turn"))
    room = F.greatest(F.length("text") - how.window // 4, F.lit(1))
    begin = F.pmod(F.xxhash64("turn", "text"), room).cast("int") + 1
    part = F.substring("text", begin, F.lit(how.window)).cast("binary")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("turn", "text"), "turn"))
    sample = picked.select("lang", part.alias("part"), nth.alias("nth")).where(F.col("nth") <= 2 * how.windows_per_language)
    found = sample.select("lang", "part").collect()
    windows = np.zeros((len(found), how.window), dtype=np.uint8)
    for i, row in enumerate(found):
        part = row["part"][: how.window]
        windows[i, : len(part)] = np.frombuffer(part, dtype=np.uint8)
    labels = np.array([languages.index(str(r["lang"])) for r in found], dtype=np.intp)
    # The rows arrive in any order; a fixed one makes the training repeatable.
    order = np.lexsort((*windows[:, :16].T, labels))
    windows, labels = windows[order], labels[order]
    if reject and len(windows):
        more = junk(windows, min(2 * how.windows_per_language, len(windows)), np.random.default_rng(how.seed))
        windows = np.concatenate([windows, more])
        labels = np.concatenate([labels, np.full(len(more), len(languages), dtype=np.intp)])
        languages = [*languages, UNDETERMINED]
    return train(windows, labels, languages, how)


def _predicted(batches, model: bytes, text: int, kept: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    predictor = _predictor(model)
    languages = np.array(predictor.model.languages, dtype=object)
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column(text)):
            p = predictor.texts(raw, offsets)
            best = p.argmax(axis=1)
            columns = [c.slice(first, last - first) for c in batch.columns[:kept]]
            lettered = batch.column(batch.num_columns - 1).slice(first, last - first).to_numpy(zero_copy_only=False)
            lang = np.where(lettered, languages[best], UNDETERMINED)
            score = np.where(lettered, np.minimum(p.max(axis=1), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lang, pa.string()), pa.array(score)], names=names
            )


def predict(
    docs: DataFrame,
    model: Model | None,
    keep: Sequence[str] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns of ``keep``, and the language and score of every whole text.

    A null text and one without a letter are ``und`` with score 0, and so is
    every text if there is no model. Each row is predicted for itself; an empty
    table gives no row. ``names`` must not be in ``keep``.
    """
    ship(docs.sparkSession)
    keep, language, score = list(keep), *names
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias(language), F.lit(0.0).alias(score))
    kept = docs.select(*keep)
    extra = [] if "text" in keep else [F.col("text").alias("_text")]
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_lettered")
    rows = docs.select(*keep, *extra, lettered)
    schema = kept.schema.add(language, "string").add(score, "double")
    text = keep.index("text") if "text" in keep else len(keep)
    sent, columns = pickle.dumps(model), [*keep, language, score]
    return rows.mapInArrow(lambda batches: _predicted(batches, sent, text, len(keep), columns), schema)
