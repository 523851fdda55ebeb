"""Byte-level BPE encoding and decoding on arrays.

Pre-tokenisation runs no regular expression. Code points become symbols of a
small alphabet, each symbol is a function from state to state, and functions
compose associatively: rows of the text are reduced side by side, a doubling
scan over the rows gives the state each begins in, and a second pass marks
where matches begin. The slices are looked up in a cache by hash; those not
known are merged together, one merge round for all of them at a time.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import Hasher, chunks, gather
from tidemark.llm.ship import ship

_SEPARATOR = b"\n"
# Code points with the White_Space property, and the endings that
# the published pattern splits off after an apostrophe.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

# Symbols: letter, number, other, apostrophe of a one- or two-letter ending,
# space or other white space before a solid character, white space before white
# space or the end, and the separator of rows.
_L, _N, _O, _A1, _A2, _SPACE_LAST, _WHITE_LAST, _WHITE_MID, _SEP = range(9)
# States: nothing open; in letters, numbers, others; after a space that joins
# what follows; in white space; one or two letters of an ending to come.
_X, _IN_L, _IN_N, _IN_O, _JOIN, _IN_W, _ONE, _TWO = range(8)
_SYMBOLS, _STATES = 9, 8
_ROW = 256


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a match begins, for state * _SYMBOLS + symbol."""
    to = np.zeros((_STATES, _SYMBOLS), dtype=np.uint8)
    begins = np.ones((_STATES, _SYMBOLS), dtype=bool)
    to[:, [_L, _N, _O, _A1, _A2]] = [_IN_L, _IN_N, _IN_O, _ONE, _TWO]
    to[:, [_SPACE_LAST, _WHITE_LAST, _WHITE_MID, _SEP]] = [_JOIN, _X, _IN_W, _X]
    for state, symbols in ((_IN_L, [_L]), (_IN_N, [_N]), (_IN_O, [_O, _A1, _A2]), (_IN_W, [_WHITE_MID])):
        begins[state, symbols] = False
    to[_IN_O, [_A1, _A2]] = to[_JOIN, [_A1, _A2]] = _IN_O
    begins[_JOIN, [_L, _N, _O, _A1, _A2]] = False
    to[_ONE, _L], to[_TWO, _L] = _X, _ONE
    begins[[_ONE, _TWO], _L] = False
    return to.reshape(-1), begins.reshape(-1)


_TO, _BEGINS = _transitions()


@cache
def _classes() -> np.ndarray:
    """Letter, number, other or white space (3), and the space character (4), by code point."""
    found = np.full(0x110000, _O, dtype=np.uint8)
    kinds = {"L": _L, "N": _N}
    for point in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            found[point] = kind
    found[_WHITE] = 3
    found[0x20] = 4
    return found


def _symbols(points: np.ndarray) -> np.ndarray:
    kind = _classes()[points]
    before_white = np.ones(len(kind), dtype=bool)
    before_white[:-1] = kind[1:] >= 3
    table = np.array([_L, _L, _N, _N, _O, _O, _WHITE_LAST, _WHITE_MID, _SPACE_LAST, _WHITE_MID], dtype=np.uint8)
    symbol = table[kind * 2 + before_white]
    marks = np.flatnonzero(points == ord("'"))
    padded = np.concatenate([points[-2:] * 0, [0, 0]]).astype(points.dtype)
    following = np.concatenate([points, padded])
    for ending in _ENDINGS:
        hit = np.ones(len(marks), dtype=bool)
        for i, letter in enumerate(ending):
            hit &= following[marks + 1 + i] == ord(letter)
        symbol[marks[hit]] = _A1 if len(ending) == 1 else _A2
    return symbol


def scan(symbol: np.ndarray) -> np.ndarray:
    """Where matches begin, from the composed transition functions of the symbols."""
    n = len(symbol)
    rows = max(1, -(-n // _ROW))
    grid = np.full(rows * _ROW, _SEP, dtype=np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, _ROW).T)
    # Function of each row: the end state for every start state, or for one if all agree.
    state = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], rows, axis=1)
    for column in grid:
        state = _TO[state * np.uint8(_SYMBOLS) + column]
        if len(state) > 1 and (state == state[:1]).all():
            state = state[:1]
    function = np.ascontiguousarray(np.broadcast_to(state, (_STATES, rows)).T).astype(np.intp)
    reach = 1
    while reach < rows:
        later = np.take_along_axis(function[reach:], function[:-reach], axis=1)
        function[reach:] = later
        reach *= 2
    at = np.full(rows, _X, dtype=np.uint8)
    at[1:] = function[:-1, _X]
    begins = np.empty(grid.shape, dtype=bool)
    for j, column in enumerate(grid):
        step = at * np.uint8(_SYMBOLS) + column
        begins[j] = _BEGINS[step]
        at = _TO[step]
    return begins.T.reshape(-1)[:n]


def slices(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, slice starts, slice ends, first slice of each row) of a chunk of rows."""
    view = memoryview(np.ascontiguousarray(raw))
    bounds = offsets.tolist()
    joined = _SEPARATOR.join(view[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)) + _SEPARATOR
    data = np.frombuffer(joined, dtype=np.uint8)
    points = np.frombuffer(joined.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points) == len(data):
        place = np.arange(len(points) + 1)
    else:
        width = (1 + (points >= 0x80).astype(np.int64)) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
    ends_of_rows = offsets[1:] + np.arange(len(offsets) - 1)
    separators = np.searchsorted(place, ends_of_rows)
    symbol = _symbols(points)
    symbol[separators] = _SEP
    first = np.flatnonzero(scan(symbol))
    starts, ends = place[first], place[np.append(first[1:], len(points))]
    real = np.ones(len(first), dtype=bool)
    real[np.searchsorted(first, separators)] = False
    starts, ends = starts[real], ends[real]
    rows = np.searchsorted(starts, np.concatenate([[0], ends_of_rows + 1]))
    return data, starts, ends, rows


class Merges:
    """Merges of pairs of token ids, in an open hash table of arrays."""

    _EMPTY = np.uint32(0xFFFFFFFF)

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 16 | right] = rank
        keys = np.array(list(pairs), dtype=np.uint32)
        values = np.array(list(pairs.values()), dtype=np.int32)
        self.shift = np.uint32(32 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (32 - int(self.shift))
        self.mask = size - 1
        self.keys = np.full(size, self._EMPTY, dtype=np.uint32)
        self.values = np.full(size, self.none, dtype=np.int32)
        self.depth, left = 0, np.arange(len(keys))
        while len(left):
            slot = (self._slot(keys[left]) + self.depth) & self.mask
            free = self.keys[slot] == self._EMPTY
            slot, took = slot[free], left[free]
            self.keys[slot] = keys[took]
            won = self.keys[slot] == keys[took]
            self.values[slot[won]] = values[took[won]]
            placed = np.zeros(len(keys), dtype=bool)
            placed[took[won]] = True
            left = left[~placed[left]]
            self.depth += 1

    none = np.int32(2**31 - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, ``none`` where it does not merge."""
        keys = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.values[slot], self.none)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != self._EMPTY))
        for depth in range(1, self.depth):
            if not len(open_):
                break
            at = (slot[open_] + depth) & self.mask
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != self._EMPTY)]
        return found

    def merge(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all slices (``ids`` one after another) as far as they go: (ids, lengths)."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), self.none, dtype=np.int32)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.rank(ids[inside], ids[inside + 1])
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, heads)
            size = np.diff(np.append(heads, len(ids)))
            best = np.repeat(low, size)
            ended = best == self.none
            done_ids.append(ids[ended])
            done_owner.append(owner[ended])
            pick = ~ended & (rank == best)
            # Of overlapping pairs, as in a run of one letter, every second one merges.
            runs = np.flatnonzero(pick[1:] & pick[:-1])
            if len(runs):
                at = np.flatnonzero(pick)
                fresh = np.concatenate([[True], np.diff(at) != 1])
                nth = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                pick[at[nth % 2 == 1]] = False
            ids = np.where(pick, rank, ids)
            keep = ~ended
            keep[1:] &= ~pick[:-1]
            ids, owner = ids[keep], owner[keep]
        owners = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        merged = np.concatenate(done_ids) if done_ids else ids
        order = np.argsort(owners, kind="stable")
        return merged[order], np.bincount(owners, minlength=len(lengths))


class Tokenizer:
    """Encodes and decodes chunks of rows by the ranks of a rank file.

    The cache of merged slices holds a fixed number of slots and is emptied
    when its ids pass a bound, so its memory does not grow with the input.
    """

    _SLOT_BITS, _POOL = 19, 2_000_000

    def __init__(self, rank_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.merges = Merges(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.used = None

    def __getstate__(self) -> dict:
        """The tables alone: every worker fills a cache of its own."""
        return {k: v for k, v in vars(self).items() if k not in ("keys", "start", "length", "pool")} | {"used": None}

    def _clear(self) -> None:
        size = 1 << self._SLOT_BITS
        self.keys = np.zeros(size, dtype=np.uint64)
        self.start = np.zeros(size, dtype=np.int32)
        self.length = np.zeros(size, dtype=np.int32)
        self.pool = np.zeros(1 << 18, dtype=np.int32)
        self.used = 0

    def _add(self, ids: np.ndarray) -> int:
        start = self.used
        if start + len(ids) > len(self.pool):
            grown = np.zeros(start + len(ids) + (1 << 18), dtype=np.int32)
            grown[:start] = self.pool[:start]
            self.pool = grown
        self.pool[start : start + len(ids)] = ids
        self.used += len(ids)
        return start

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each row and the end) for the rows of a chunk."""
        data, starts, ends, rows = slices(raw, offsets)
        if self.used is None or self.used > self._POOL:
            self._clear()
        key = Hasher(data)(starts, ends) | np.uint64(1)
        slot = (key >> np.uint64(64 - self._SLOT_BITS)).astype(np.int64)
        at, length = self.start[slot].astype(np.int64), self.length[slot].astype(np.int64)
        missing = np.flatnonzero(self.keys[slot] != key)
        if len(missing):
            new, first, which = np.unique(key[missing], return_index=True, return_inverse=True)
            first = missing[first]
            size = ends[first] - starts[first]
            ids, n = self.merges.merge(self.byte_id[data[gather(starts[first], size)]], size)
            begin = self._add(ids) + np.cumsum(n) - n
            at[missing], length[missing] = begin[which], n[which]
            self.keys[slot[first]], self.start[slot[first]], self.length[slot[first]] = new, begin, n
            # Where two new keys share a slot the last one stays, in all three arrays.
        ids = self.pool[gather(at, length)]
        size = ends - starts
        if not np.array_equal(self.decode(ids), data[gather(starts, size)]):
            # Slices of one hash need not be equal; the ids of the right ones decode to their bytes.
            ids, length = self.merges.merge(self.byte_id[data[gather(starts, size)]], size)
        bounds = np.concatenate([[0], np.cumsum(length)])[rows]
        return ids, bounds

    def spans(self, ids: np.ndarray) -> np.ndarray:
        """Where the bytes of each id begin in the decoded text, and its end."""
        return np.concatenate([[0], np.cumsum(self.token_length[ids])])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after another."""
        return self.token_bytes[gather(self.token_start[ids], self.token_length[ids])]


@lru_cache(maxsize=2)
def tokenizer(rank_file: bytes) -> Tokenizer:
    return Tokenizer(rank_file)


def _binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of ``data`` as a binary column."""
    at = np.ascontiguousarray(bounds * data.itemsize, dtype=np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]
    )


def sent(spark: SparkSession, rank_path: str) -> Broadcast[Tokenizer]:
    """The tokenizer of a rank file for the tasks; its size is that of the vocabulary."""
    with open(rank_path, "rb") as file:
        return spark.sparkContext.broadcast(tokenizer(file.read()))


def _encoded(batches, tables, spans: bool, decoded: bool) -> Iterator[pa.RecordBatch]:
    bpe = tables.value
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            ids, bounds = bpe.encode(raw, offsets)
            columns = {
                "doc_id": batch.column("doc_id").slice(first, last - first),
                "n_tokens": pa.array(np.diff(bounds)),
                "ids": _binaries(ids.astype("<u4"), bounds),
            }
            if spans or decoded:
                place = bpe.spans(ids)
            if spans:
                inside = place[:-1] - np.repeat(place[bounds[:-1]], np.diff(bounds))
                columns["starts"] = _binaries(inside.astype("<u4"), bounds)
            if decoded:
                columns["decoded"] = _binaries(bpe.decode(ids), place[bounds])
            yield pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, rank_path: str, spans: bool = False, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ``ids`` (little-endian unsigned 32-bit) of every whole text.

    ``spans`` adds ``starts``: where each token begins in the text's bytes.
    ``decoded`` adds the bytes the ids decode to. Null texts count as empty and
    have no ids. Rows that repeat stay, in any order; other columns are not
    read; an empty table gives no row.
    """
    spark = docs.sparkSession
    ship(spark)
    tables = sent(spark, rank_path)
    schema = "doc_id long, n_tokens long, ids binary"
    schema += ", starts binary" * spans + ", decoded binary" * decoded
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _encoded(batches, tables, spans, decoded), schema)


def _texts(batches, tables) -> Iterator[pa.RecordBatch]:
    bpe = tables.value
    for batch in batches:
        for row in range(batch.num_rows):  # a row at a time: texts may be very long
            one = batch.slice(row, 1)
            ids = np.frombuffer(one.column("ids")[0].as_py() or b"", dtype="<u4").astype(np.int64)
            text = pa.array([bpe.decode(ids).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([one.column("doc_id"), text], names=["doc_id", "decoded"])


def decode(tokens: DataFrame, rank_path: str) -> DataFrame:
    """doc_id and the bytes that its ``ids`` decode to; null ids count as none."""
    spark = tokens.sparkSession
    ship(spark)
    tables = sent(spark, rank_path)
    return tokens.select("doc_id", "ids").mapInArrow(
        lambda batches: _texts(batches, tables), "doc_id long, decoded binary"
    )
