"""Secret scan: fixed patterns, and a character convolutional network over every candidate.

A candidate is a run of key characters with a letter and a digit. The network
reads the candidate and the characters around it: embedded characters, which
differ inside and outside the candidate, filters of several widths, their
maxima, and a logistic output. It learns from labelled findings: all candidates
of the corpus, inside a fixed pattern or outside of all, and made ones of known
kinds. Tasks learn from a shard each, and their weights are averaged after every
epoch. Held-out findings calibrate its scores and set the highest thresholds
that still find the wanted share of secrets.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrow_text import chunks, lowered
from tidemark.llm.sampling import chance
from tidemark.llm.ship import ship
from tidemark.scale import materialise, temporary

KINDS = ("assign", "access", "hex", "learned")
# The patterns, and the least length of what they must find.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_LEAST_ASSIGN, _LEAST_ACCESS, _LEAST_HEX = 8, 16, 32
# The first four letters of each word of the first pattern, in lower case.
_HEADS = [int.from_bytes(head, "little") for head in (b"pass", b"secr", b"toke", b"apik", b"api_")]
_AKIA = int.from_bytes(b"AKIA", "little")

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(string.digits.encode())] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(string.ascii_letters.encode())] = True
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
_KEY = _DIGIT | _LETTER
_KEY[list(b"+/_.=-")] = True
LEAST_CANDIDATE = 10
# The window: characters before, first and last of the candidate, after.
_BEFORE, _HEAD, _TAIL, _AFTER = 28, 32, 12, 8
WINDOW = _BEFORE + _HEAD + _TAIL + _AFTER
_INSIDE = 256


@dataclass(frozen=True)
class Settings:
    """Shape of the network, and how it learns."""

    widths: tuple[int, ...] = (3, 6)
    filters: int = 32
    embedding: int = 8
    made: int = 6000  # made findings, and about as many of the corpus in a shard
    epochs: int = 6
    batch: int = 64
    rate: float = 0.004
    held_out: float = 0.3
    recall: float = 0.95
    least_held: int = 30
    seed: int = 31


@dataclass
class Network:
    embed: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    constant: np.ndarray
    scale: float = 1.0
    offset: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)
    # Findings of the corpus that the weights, and the thresholds, come from.
    learned: int = 0
    held: int = 0

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.kernels, *self.biases, self.out, self.constant]


def _peaks(net: Network, codes: np.ndarray):
    """Filter maxima of each window, and for every width the patches and where the maxima lie."""
    seen = net.embed[codes]
    size = seen.shape[2]
    tops, places = [], []
    for kernel, bias in zip(net.kernels, net.biases, strict=True):
        width = len(kernel) // size
        n = seen.shape[1] - width + 1
        patches = np.concatenate([seen[:, j : j + n] for j in range(width)], axis=2)
        response = patches @ kernel
        at = response.argmax(axis=1)
        tops.append(np.take_along_axis(response, at[:, None], axis=1)[:, 0] + bias)
        places.append((width, at, patches))
    return np.concatenate(tops, axis=1), places


def logits(net: Network, codes: np.ndarray, block: int = 512) -> np.ndarray:
    """Uncalibrated outputs for windows."""
    parts = [np.maximum(_peaks(net, codes[i : i + block])[0], 0) @ net.out + net.constant for i in range(0, len(codes), block)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def untrained(how: Settings, rng: np.random.Generator) -> Network:
    """The network with drawn weights."""

    def drawn(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    return Network(
        rng.normal(0, 1, (2 * _INSIDE, how.embedding)).astype(np.float32),
        [drawn(w * how.embedding, how.filters) for w in how.widths],
        [np.zeros(how.filters, np.float32) for _ in how.widths],
        drawn(how.filters * len(how.widths)),
        np.zeros(1, np.float32),
    )


class Training:
    """A network, and what Adam keeps of its gradients."""

    def __init__(self, net: Network):
        self.net = net
        self.mean = [np.zeros_like(w) for w in net.weights()]
        self.square = [np.zeros_like(w) for w in net.weights()]
        self.turn = 0.0

    def _arrays(self) -> list[np.ndarray]:
        return [*self.net.weights(), *self.mean, *self.square]

    def numbers(self) -> np.ndarray:
        """All of it in one vector, which can be averaged."""
        return np.concatenate([*(a.ravel() for a in self._arrays()), [self.turn]]).astype(np.float64)

    def restore(self, numbers: np.ndarray) -> None:
        at = 0
        for a in self._arrays():
            a[...] = numbers[at : at + a.size].reshape(a.shape)
            at += a.size
        self.turn = float(numbers[at])

    def epoch(self, codes: np.ndarray, labels: np.ndarray, how: Settings, rng: np.random.Generator) -> None:
        """Go over all windows once, by Adam on the logistic loss."""
        net, weights = self.net, self.net.weights()
        order = rng.permutation(len(codes))
        for begin in range(0, len(codes), how.batch):
            pick = order[begin : begin + how.batch]
            x, y, every = codes[pick], labels[pick], np.arange(len(pick))[:, None]
            tops, places = _peaks(net, x)
            live = np.maximum(tops, 0)
            error = ((_sigmoid(live @ net.out + net.constant) - y) / len(pick)).astype(np.float32)
            back = error[:, None] * net.out * (tops > 0)
            d_embed = np.zeros_like(net.embed)
            d_kernels, d_biases = [], []
            for i, (width, at, patches) in enumerate(places):
                g = back[:, i * how.filters : (i + 1) * how.filters]
                d_kernels.append(np.einsum("bf,bfk->kf", g, patches[every, at]))
                d_biases.append(g.sum(axis=0))
                for j in range(width):
                    part = net.kernels[i][j * how.embedding : (j + 1) * how.embedding].T
                    np.add.at(d_embed, x[every, at + j], g[:, :, None] * part)
            self.turn += 1
            grads = [d_embed, *d_kernels, *d_biases, live.T @ error, error.sum(keepdims=True)]
            for w, g, m, v in zip(weights, grads, self.mean, self.square, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= how.rate * (m / (1 - 0.9**self.turn)) / (np.sqrt(v / (1 - 0.999**self.turn)) + 1e-8)


def train(codes: np.ndarray, labels: np.ndarray, how: Settings) -> Network:
    """Fit a network to windows that one process holds."""
    rng = np.random.default_rng(how.seed)
    training = Training(untrained(how, rng))
    for _ in range(how.epochs):
        training.epoch(codes, labels, how, rng)
    return training.net


def calibrate(z: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that make ``sigmoid(slope * z + offset)`` a probability, by Newton steps.

    ``counts`` says how often each output occurs, once by default.
    """
    counts = np.ones(len(z)) if counts is None else counts
    positive, negative = (counts * labels).sum(), (counts * (1 - labels)).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([z, np.ones(len(z))], axis=1)

    def loss(w: np.ndarray) -> float:
        return float((counts * (np.logaddexp(0, x @ w) - target * (x @ w))).sum())

    w = np.zeros(2)
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (counts * (p - target)))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def shapes(codes: np.ndarray) -> np.ndarray:
    """The alphabet of each window's candidate: 0 hexadecimal, 1 letters and digits, 2 with signs."""
    inside = codes >= _INSIDE
    char = (codes & (_INSIDE - 1)).astype(np.uint8)
    hexadecimal = _HEX[lowered(char)] | ~inside
    plain = (_LETTER | _DIGIT)[char] | ~inside
    return np.where(hexadecimal.all(axis=1), 0, np.where(plain.all(axis=1), 1, 2))


def constrained(
    score: np.ndarray, labels: np.ndarray, shape: np.ndarray, how: Settings, counts: np.ndarray | None = None
) -> dict[int, float]:
    """For each shape the highest threshold that finds the wanted share of held-out secrets, 0.5 at most.

    Shapes with few held-out secrets get that of all together. ``counts`` says
    how often each score occurs, once by default.
    """
    counts = np.ones(len(score)) if counts is None else counts

    def highest(which: np.ndarray) -> float:
        if not which.any():
            return 0.5
        order = np.argsort(-score[which], kind="stable")
        found = np.cumsum(counts[which][order])
        last = np.searchsorted(found, how.recall * found[-1] * (1 - 1e-12))
        return min(float(score[which][order][last]), 0.5)

    whole = highest(labels > 0)
    parts = {k: (labels > 0) & (shape == k) for k in range(3)}
    return {k: highest(part) if counts[part].sum() >= how.least_held else whole for k, part in parts.items()}


def _runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], member.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


class Chunk:
    """The rows of a chunk one after another, a line feed behind each, which ends every pattern."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        self.row_starts = offsets[:-1] + np.arange(rows)
        self.row_ends = offsets[1:] + np.arange(rows)
        self.data = np.full(len(raw) + rows + 4, 10, dtype=np.uint8)
        inside = np.ones(len(raw) + rows, dtype=bool)
        inside[self.row_ends] = False
        self.data[: len(inside)][inside] = raw
        self.bytes = self.data.tobytes()

    def _matches(self, at: np.ndarray, pattern: re.Pattern, group: int, least: int) -> np.ndarray:
        """Leftmost matches that do not overlap, of those that can begin ``at``; short ones are dropped at last."""
        found, end = [], 0
        for begin in at.tolist():
            if begin >= end and (match := pattern.match(self.bytes, begin)):
                end = match.end()
                if len(match[group]) >= least:
                    found.append((begin, end))
        return np.array(found, dtype=np.int64).reshape(-1, 2)

    def base(self) -> list[np.ndarray]:
        """(start, end) of the matches of each pattern."""
        fours = np.ndarray((len(self.data) - 3,), dtype="<u4", buffer=self.data, strides=(1,))
        small = lowered(self.data)
        small = np.ndarray((len(small) - 3,), dtype="<u4", buffer=small, strides=(1,))
        heads = np.zeros(len(small), dtype=bool)
        for head in _HEADS:
            heads |= small == head
        begin, end = _runs(_HEX[self.data])
        long = end - begin >= _LEAST_HEX
        return [
            self._matches(np.flatnonzero(heads), _ASSIGN, 2, _LEAST_ASSIGN),
            self._matches(np.flatnonzero(fours == _AKIA), _ACCESS, 0, _LEAST_ACCESS),
            np.stack([begin[long], end[long]], axis=1),
        ]

    def candidates(self) -> np.ndarray:
        """(start, end) of every run of key characters with a letter and a digit."""
        begin, end = _runs(_KEY[self.data])
        long = end - begin >= LEAST_CANDIDATE
        begin, end = begin[long], end[long]
        digits, letters = (np.concatenate([[0], np.cumsum(kind[self.data])]) for kind in (_DIGIT, _LETTER))
        good = (digits[end] > digits[begin]) & (letters[end] > letters[begin])
        return np.stack([begin[good], end[good]], axis=1)

    def windows(self, spans: np.ndarray) -> np.ndarray:
        """The coded characters of each candidate and around it; 0 where there is none."""
        begin, end = spans[:, :1], spans[:, 1:]
        row = np.searchsorted(self.row_starts, spans[:, 0], side="right") - 1
        first, last = self.row_starts[row][:, None], self.row_ends[row][:, None]
        size = end - begin
        before = begin - _BEFORE + np.arange(_BEFORE)
        head = begin + np.arange(_HEAD)
        # The tail holds what the head does not, up to the last characters.
        tail = np.maximum(end - _TAIL, begin + _HEAD) + np.arange(_TAIL)
        after = end + np.arange(_AFTER)
        parts = [(before, before >= first, 0), (head, np.arange(_HEAD) < size, _INSIDE), (tail, tail < end, _INSIDE), (after, after < last, 0)]
        coded = [np.where(good, self.data[np.clip(at, 0, len(self.data) - 1)] + np.uint16(more), 0) for at, good, more in parts]
        return np.concatenate(coded, axis=1).astype(np.uint16)

    def points(self, at: np.ndarray) -> np.ndarray:
        """Places as code points of their rows."""
        leads = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        row = np.searchsorted(self.row_starts, at, side="right") - 1
        return leads[at] - leads[self.row_starts[row]]


def overlapping(spans: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which spans share a character with any of the others."""
    hit = np.zeros(len(spans), dtype=bool)
    for other in others:
        if len(other):
            # Spans of one kind do not overlap: the last that begins before the end decides.
            at = np.searchsorted(other[:, 0], spans[:, 1]) - 1
            hit |= (at >= 0) & (other[np.maximum(at, 0), 1] > spans[:, 0])
    return hit


def _findings(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offsets in chunks(batch.column(0)):
            chunk = Chunk(raw, offsets)
            spans = chunk.candidates()
            found = overlapping(spans, chunk.base())
            coded = [w.tobytes() for w in chunk.windows(spans).astype("<u2")]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(coded, pa.binary())], names=["found", "window"])


def _drawn(rng: np.random.Generator, letters: str, size: int) -> str:
    return "".join(np.array(list(letters))[rng.integers(0, len(letters), size)])


def made(n: int, rng: np.random.Generator) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """Labelled findings of known kinds: (before, candidate, after), half of them secrets."""
    low, up, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    full = low + up + digits
    hexes = digits + "abcdef"
    names = "password passwd pwd secret client_secret token access_token auth api_key apikey private_key credential".split()
    plain = "the and of report section chapter figure value released on item see page order der la que les".split()

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def word(size=(3, 9)):
        return _drawn(rng, low, int(rng.integers(*size)))

    def number(size):
        return _drawn(rng, digits, size)

    def key():
        return pick(
            [
                lambda: _drawn(rng, full, int(rng.integers(16, 48))),
                lambda: _drawn(rng, full + "+/", int(rng.integers(24, 88))) + pick(["", "=", "=="]),
                lambda: _drawn(rng, pick([hexes, digits + "ABCDEF"]), pick([24, 30, 32, 40, 64])),
                lambda: _drawn(rng, full + "_-", int(rng.integers(20, 64))),
                lambda: pick(["ghp_", "sk_live_", "glpat-", "xoxb-", "pk_test_", "npm_"]) + _drawn(rng, full, int(rng.integers(20, 40))),
                lambda: f"eyJ{_drawn(rng, full, 20)}.eyJ{_drawn(rng, full + '_-', 30)}.{_drawn(rng, full + '_-', 40)}",
            ]
        )()

    def secret():
        lead = pick(
            [
                lambda: f"{word()} {pick(names)}{pick([' = ', '=', ': ', ' is ', ':'])}{pick(['', chr(34), chr(39)])}",
                lambda: pick(["Authorization: Bearer ", "curl -H 'X-Auth: ", "export KEY=", "--key ", "bearer "]),
                lambda: f"{word()} {word()} ",
                lambda: f"{pick(['postgres', 'amqp', 'https'])}://{word()}:",
            ]
        )()
        return lead, key(), pick(["", '"', "'", " ", "@", "\n", " " + word()])

    def other():
        body = pick(
            [
                lambda: f"{word()}.{word()}/{word()}/{word()}-{number(3)}",
                lambda: f"{word()}_{word()}_{number(2)}",
                lambda: f"{pick(['v', 'release-', 'build.'])}{number(1)}.{number(2)}.{number(3)}",
                lambda: f"20{number(2)}-0{number(1)}-1{number(1)}T1{number(1)}",
                lambda: f"{word((8, 14))}{number(1)}",
                lambda: f"{word().title()}{word().title()}{number(2)}",
                lambda: f"{_drawn(rng, up, 3)}-{number(4)}-{_drawn(rng, up, 2)}",
                lambda: "-".join(_drawn(rng, hexes, k) for k in (8, 4, 4, 4, 12)),
                lambda: f"/{word()}/{word()}{number(2)}/{word()}.html",
                lambda: f"{number(int(rng.integers(9, 16)))}{pick(['kg', 'th', 'x', 'px', 'e'])}",
                lambda: f"{word()}{number(3)}.{word((2, 4))}",
            ]
        )()
        lead = f"{pick(plain)} {word()}{pick([' ', ', ', ' (', ': ', '. ', ' | ', ' = '])}"
        return lead, body, pick(["", " ", ".", ",", ") ", " " + pick(plain)])

    labels = np.arange(n) % 2
    return [secret() if y else other() for y in labels], labels


def coded(findings: list[tuple[str, str, str]]) -> np.ndarray:
    """Windows of findings given as text."""
    rows = ["".join(f).encode() for f in findings]
    chunk = Chunk(np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)]))
    lead = np.array([len(before.encode()) for before, _, _ in findings])
    size = np.array([len(body.encode()) for _, body, _ in findings])
    begin = chunk.row_starts + lead
    return chunk.windows(np.stack([begin, begin + size], axis=1))


def findings(docs: DataFrame) -> DataFrame:
    """(found, window) of all candidates of ``docs`` (text), each once: whether a fixed pattern has it, and its codes."""
    ship(docs.sparkSession)
    texts = docs.where(F.length("text") >= LEAST_CANDIDATE).select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_findings, "found boolean, window binary").distinct()


def _decoded(found: pa.Array, window: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(window.to_pylist()), "<u2").reshape(-1, WINDOW)
    return codes, found.to_numpy(zero_copy_only=False).astype(float)


def _by_shard(batches) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard; those of a shard follow each other."""
    current, held = None, []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        borders = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for begin, end in zip(borders[:-1], borders[1:], strict=True):
            if begin == end:
                continue
            if held and shard[begin] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = int(shard[begin])
            held.append(batch.slice(begin, end - begin))
    if held:
        yield current, pa.Table.from_batches(held)


def _learned(batches, sent, turn: int) -> Iterator[pa.RecordBatch]:
    """The weights after an epoch over each shard and the made findings, added up over the shards of a task."""
    training, made_codes, made_labels, how = sent.value
    start = training.numbers()
    total, weight, rows = np.zeros_like(start), 0, 0
    for shard, table in _by_shard(batches):
        codes, labels = _decoded(table.column("found").combine_chunks(), table.column("window"))
        training.restore(start)
        rng = np.random.default_rng([how.seed, turn, shard])
        training.epoch(np.concatenate([codes, made_codes]), np.concatenate([labels, made_labels]), how, rng)
        size = len(codes) + len(made_codes)
        total += size * training.numbers()
        weight += size
        rows += len(codes)
    if rows:
        values = [pa.array([total.tobytes()], pa.binary()), pa.array([weight], pa.int64()), pa.array([rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(values, names=["total", "weight", "rows"])


# Outputs of held-out findings are counted in steps of this, up to a bound beyond which the logistic function is flat.
_STEP, _FLAT = 1 / 1024, 64.0


def _outputs(batches, sent) -> Iterator[pa.RecordBatch]:
    net = sent.value
    for batch in batches:
        codes, _ = _decoded(batch.column(0), batch.column(1))
        step = np.floor(np.clip(logits(net, codes), -_FLAT, _FLAT) / _STEP).astype(np.int64)
        columns = [batch.column(0), pa.array(shapes(codes).astype(np.int64)), pa.array(step)]
        yield pa.RecordBatch.from_arrays(columns, names=["found", "shape", "step"])


def fit(docs: DataFrame, how: Settings = Settings()) -> Network:
    """Learn from all candidates of ``docs`` (text), labelled by the fixed patterns, and from made ones.

    Each different window counts once; a hash holds some out. The others are
    dealt by their hash to shards of about as many as there are made ones. In
    every epoch each shard goes over its windows and all made ones, from the
    same weights, and the weights of all shards are averaged: the driver gets
    one sum a task. The outputs of all held-out windows are counted by value,
    in steps of 1/1024; where they outnumber the made ones, these count as much
    as they. A table without candidates leaves the made ones.
    """
    spark = docs.sparkSession
    made_ones, labels = made(how.made, np.random.default_rng(how.seed))
    codes, labels = coded(made_ones), labels.astype(float)
    out = np.random.default_rng(how.seed + 1).random(len(codes)) < how.held_out
    rng = np.random.default_rng(how.seed)
    training = Training(untrained(how, rng))
    with temporary(spark):
        windows = materialise(findings(docs), "windows").withColumn("held", chance(how.seed + 1, "window") < how.held_out)
        total = windows.where(~F.col("held")).count()
        shards = max(1, round(total / max(1, int((~out).sum()))))
        shard = F.pmod(F.xxhash64(F.lit(how.seed), "window"), F.lit(shards)).cast("long").alias("shard")
        dealt = windows.where(~F.col("held")).select(shard, "found", "window")
        # Each shard lies in one file, in order, so that no epoch shuffles.
        dealt = materialise(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "window", "found"), "shards")
        for turn in range(how.epochs):
            sent = spark.sparkContext.broadcast((training, codes[~out], labels[~out], how))
            rows = dealt.mapInArrow(lambda b, s=sent, t=turn: _learned(b, s, t), "total binary, weight long, rows long").collect()
            if rows:
                sums = sorted(bytes(r["total"]) for r in rows)
                training.restore(np.sum([np.frombuffer(v) for v in sums], axis=0) / sum(r["weight"] for r in rows))
            else:
                training.epoch(codes[~out], labels[~out], how, rng)
            training.net.learned = sum(r["rows"] for r in rows)
            sent.destroy()
        net = training.net
        sent = spark.sparkContext.broadcast(net)
        seen = windows.where("held").select("found", "window")
        seen = seen.mapInArrow(lambda b: _outputs(b, sent), "found boolean, shape long, step long")
        seen = seen.groupBy("found", "shape", "step").agg(F.count(F.lit(1)).alias("n"))
        seen = sorted(tuple(r) for r in seen.collect())
        sent.destroy()
    found, shape, step, n = np.array(seen, dtype=np.int64).reshape(-1, 4).T
    net.held = int(n.sum())
    z = np.concatenate([step * _STEP, logits(net, codes[out])])
    labels = np.concatenate([found, labels[out]]).astype(float)
    shape = np.concatenate([shape, shapes(codes[out])])
    counts = np.concatenate([n, np.full(int(out.sum()), max(1.0, net.held / max(1, int(out.sum()))))])
    net.scale, net.offset = calibrate(z, labels, counts)
    net.thresholds = constrained(_sigmoid(net.scale * z + net.offset), labels, shape, how, counts)
    return net


def _spans(batches, sent, kept: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    net = sent.value
    limits = np.array([net.thresholds[k] for k in range(3)])
    kind = pa.array(KINDS)
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column(kept)):
            chunk = Chunk(raw, offsets)
            base = chunk.base()
            spans = chunk.candidates()
            windows = chunk.windows(spans)
            score = _sigmoid(net.scale * logits(net, windows) + net.offset)
            good = (score >= limits[shapes(windows)]) & ~overlapping(spans, base) if len(spans) else np.zeros(0, bool)
            found = [*base, spans[good]]
            number = np.repeat(np.arange(4), [len(f) for f in found])
            score = np.concatenate([np.ones(len(number) - int(good.sum())), score[good]])
            found = np.concatenate(found)
            order = np.lexsort((number, found[:, 0]))
            number, score, found = number[order], score[order], found[order]
            row = np.searchsorted(chunk.row_starts, found[:, 0], side="right") - 1
            bounds = np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)
            parts = [kind.take(pa.array(number)), pa.array(chunk.points(found[:, 0])), pa.array(chunk.points(found[:, 1] - 1) + 1)]
            structs = pa.StructArray.from_arrays([*parts, pa.array(score)], names=["kind", "start", "end", "score"])
            columns = [c.slice(first, last - first) for c in batch.columns[:kept]]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(bounds), structs)], names=names)


def scan(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",), name: str = "spans") -> DataFrame:
    """The columns of ``keep`` and every span of every whole text: kind, start and end in code points, score.

    Spans are in order of start, then kind. Matches of the fixed patterns are
    all there, with score 1; what the network adds does not overlap them. A null
    text counts as empty and has no span; rows that repeat stay; an empty table
    gives no row. ``name`` must not be in ``keep``.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(net)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("score", "double")
    schema = docs.select(*keep).schema.add(name, T.ArrayType(span))
    return rows.mapInArrow(lambda batches: _spans(batches, sent, len(keep), [*keep, name]), schema)


def counted(spans: str, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: str, *kinds: str) -> Column:
    """The spans of the given kinds as ``kind:start:end``, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    parts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
