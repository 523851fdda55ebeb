"""Best-fit packing of token sequences by minimum bin slack.

A bin's fullest combination is found by a subset-sum dynamic programme over a
bitset of reachable fills. Pieces of one length are interchangeable, so the
plan needs only the number of pieces of each length: a table as long as the
bin, whatever the corpus. One combination is repeated while the counts last.
Pieces then find their place by their rank among pieces of the same length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import chunks
from tidemark.llm.byte_bpe import Tokenizer, sent
from tidemark.llm.ship import ship
from tidemark.scale import materialise

# Pieces that one task ranks: lengths are split further as the table grows.
_SALT_ROWS = 20_000
_LEAST_SALTS = 16
_SLACKS = (0, 1, 2, 4, 8, 16, 32)


def added_tokens(path: str) -> dict[str, int]:
    """The tokens of a tokenizer file that stand outside its vocabulary: texts are cut at them first."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if odd := [t["content"] for t in found if t["lstrip"] or t["rstrip"] or t["single_word"]]:
        raise ValueError(f"added tokens that take in their neighbours are not supported: {odd}")
    return {t["content"]: t["id"] for t in found}


def encode_around(bpe: Tokenizer, raw: np.ndarray, offsets: np.ndarray, added: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first id of each row and the end) of a chunk whose rows are cut at the added tokens, the leftmost and longest."""
    pattern = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True)))
    spans, data = [], raw.tobytes()
    if added and pattern.search(data):
        rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        spans = [m for a, b in rows for m in pattern.finditer(data, a, b)]
    if not spans:
        return bpe.encode(raw, offsets)
    begin, end = np.array([m.start() for m in spans]), np.array([m.end() for m in spans])
    kept = np.ones(len(raw), dtype=bool)
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        kept[a:b] = False
    place = np.concatenate([[0], np.cumsum(kept)])
    # Each row and each part of a row between added tokens is encoded by itself.
    edges = np.concatenate([place[offsets], place[begin]])
    rank = np.concatenate([offsets, begin + 0.5])  # a token at a row's begin comes after the row's edge
    order = np.argsort(rank, kind="stable")
    ids, bounds = bpe.encode(raw[kept], edges[order])
    known = {t.encode(): i for t, i in added.items()}
    is_row = order < len(offsets)
    ids = np.insert(ids, bounds[~is_row], [known[m[0]] for m in spans])
    # Behind every cut lies one more id.
    return ids, bounds[is_row] + np.cumsum(~is_row)[is_row]


def _cut(batches, tables, size: int, end_id: int, with_ids: bool, added: dict[str, int]) -> Iterator[pa.RecordBatch]:
    bpe = tables.value
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            ids, bounds = encode_around(bpe, raw, offsets, added)
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            ends = bounds[1:] + np.arange(1, len(bounds))
            total = np.diff(np.concatenate([[0], ends]))
            pieces = -(-total // size)
            row = np.repeat(np.arange(last - first), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = (total - size * (pieces - 1))[row]
            start = np.where(nth == 0, 0, head + (nth - 1) * size)
            length = np.where(nth == 0, head, size)
            at = (ends - total)[row] + start
            view = memoryview(ids.tobytes())
            parts = [view[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = {
                "doc_id": batch.column("doc_id").slice(first, last - first).take(pa.array(row)),
                "piece": pa.array(nth, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([bytes(p) for p in parts], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def pieces(
    docs: DataFrame, rank_path: str, size: int, end_id: int, with_ids: bool = False, added: dict[str, int] | None = None
) -> DataFrame:
    """Token pieces of every whole text, its ids followed by ``end_id``.

    ``added`` tokens in a text have their own ids and cut it. A text of more than ``size`` ids is cut from its end into pieces of
    ``size``, so only the first piece may be shorter.
    """
    spark = docs.sparkSession
    ship(spark)
    tables = sent(spark, rank_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(lambda batches: _cut(batches, tables, size, end_id, with_ids, added or {}), schema)


def fullest(counts: dict[int, int], size: int, slack: int = 0) -> dict[int, int]:
    """The largest length and what fills the rest of the bin best, as {length: copies}.

    Lengths join the programme from the largest on, until a fill within
    ``slack`` of the bin is reachable; smaller ones are then kept for later.
    """
    largest = max(counts)
    room, reach, steps = size - largest, 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        if reach.bit_length() - 1 >= room - slack:
            break
        left = min(counts[length] - (length == largest), room // length)
        copies = 1
        while left > 0:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= reach << (length * copies) & mask
            left -= copies
            copies *= 2
    fill = reach.bit_length() - 1
    chosen = {largest: 1}
    for length, copies, before in reversed(steps):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + copies
            fill -= length * copies
    return chosen


def _plan(counts: dict[int, int], size: int, slack: int) -> tuple[int, list[tuple[int, ...]]]:
    left = {length: n for length, n in counts.items() if n > 0}
    ranks, rows, bins = dict.fromkeys(left, 0), [], 0
    while left:
        chosen = fullest(left, size, slack)
        times = min(left[length] // copies for length, copies in chosen.items())
        offset = 0
        for length, copies in chosen.items():
            begin = ranks[length]
            ranks[length] += copies * times
            rows.append((length, begin, ranks[length], copies, bins, offset))
            offset += length * copies
            left[length] -= copies * times
            if not left[length]:
                del left[length]
        bins += times
    return bins, rows


def plan(counts: dict[int, int], size: int) -> list[tuple[int, ...]]:
    """Rows (length, first rank, end rank, copies a bin, first bin, offset) placing every piece.

    The slack that spares the small lengths best differs by table, so a few are
    tried and the plan with the fewest bins is taken.
    """
    least = -(-sum(length * n for length, n in counts.items()) // size)
    best = None
    for slack in _SLACKS:
        tried = _plan(counts, size, slack)
        best = tried if best is None or tried[0] < best[0] else best
        if best[0] == least:
            break
    return best[1]


def pack(
    docs: DataFrame,
    rank_path: str,
    size: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    the ids (little-endian unsigned 32-bit) if asked for. A null or empty text
    is one piece holding ``end_id`` alone. Repeated rows are packed each for
    itself; other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, rank_path, size, end_id, with_ids, added), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = spark.createDataFrame(
        plan(histogram, size),
        "length long, first_rank long, end_rank long, copies long, first_bin long, base long",
    )
    salts = max(_LEAST_SALTS, sum(histogram.values()) // _SALT_ROWS)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("nth", F.row_number().over(within) - 1)
    ranked = ranked.join(materialise(groups, "ranks"), ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("earlier") + F.col("nth")).alias("r")
    # At most a row for every length of every combination: under 50 times the bin's size.
    where = F.broadcast(layout).alias("p")
    placed = ranked.join(
        where,
        (F.col("r.length") == F.col("p.length"))
        & (F.col("r.rank") >= F.col("p.first_rank"))
        & (F.col("r.rank") < F.col("p.end_rank")),
    )
    at = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        F.col("r.length").alias("length"),
        "ids_crc32",
        (F.col("first_bin") + F.floor(at / F.col("copies"))).alias("sequence_id"),
        (F.col("base") + F.pmod(at, F.col("copies")) * F.col("r.length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length and the ids of its pieces in order.

    ``packed`` must come with ids. A sequence holds at most one bin of tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
