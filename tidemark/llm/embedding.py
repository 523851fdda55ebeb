"""Near-duplicate embeddings by lattice hashing, verified by cosine.

A unit vector is projected to one or more blocks of eight random orthogonal
directions, scaled, and each block is decoded to the nearest point of the E8
lattice; the points together are its cell. Each of several tables has
directions of its own. A vector lies in its own cell of every table and looks
into the neighbouring cells nearest to it. Vectors that meet in a cell are
compared exactly.

How fine the cells are follows from the number of vectors (``planned``): the
recall of pairs at the threshold stays the same, the comparisons a vector
hardly grow. Cells are first counted by their keys alone; vectors are brought
only to cells in which somebody meets somebody.

Copies count as one vector with a weight. Cells of any size are cut into
chunks, and pairs of chunks are compared by matrix products that give link
counts and a spanning forest, never a list of pairs. A pair that meets in
several cells counts where it meets first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.lattice import cell_key, decode, probe
from tidemark.llm.ship import ship
from tidemark.scale import materialise

# Rows of one side of a comparison; cells with more are cut.
_CHUNK = 1024
# Rows of one matrix product.
_TILE = 256
# Projections are computed on a grid on which sums are exact in any order, so a cell never depends on the batch.
_GRID = float(1 << 21)


@dataclass(frozen=True)
class Lattice:
    """``side`` scales the lattice; a larger one finds more and compares more, as do more tables and probes.

    More ``blocks`` make cells finer. ``planned`` chooses all of these.
    """

    threshold: float = 0.9
    tables: int = 4
    probes: int = 4
    side: float = 0.2
    blocks: int = 1
    seed: int = 5


# Costs in comparisons: to decode a block, to look for its neighbours, a key, a vector sent to a cell.
_DECODE, _PROBE, _KEY, _SENT = 30.0, 250.0, 400.0, 4000.0
_PROBES = (0, 1, 2, 4, 8, 16)
_SIDES = (0.14, 0.17, 0.2, 0.24, 0.28, 0.34, 0.4)
_BLOCKS = (1, 2, 3, 4)
_DRAWN = 3000


@lru_cache(maxsize=8)
def _chances(threshold: float, seed: int) -> dict[tuple[int, float, int], tuple[float, float, float]]:
    """For (blocks, side, probes) the chances that in one table a pair at the threshold meets, that two
    unrelated vectors share a cell, and that a probe finds an unrelated vector.

    Drawn from normal distributions, which projections of unit vectors are
    close to whatever the data, so nothing here depends on the table.
    """
    rng = np.random.default_rng(seed)
    found = {}
    for side in _SIDES:
        spread = 1 / (8 * side)
        apart = _snapped(rng.normal(size=(_DRAWN, 8)) * spread)
        own = decode(apart)
        keys, counts = np.unique(cell_key(own, 0), return_counts=True)
        same = float((counts * (counts - 1)).sum()) / (_DRAWN * (_DRAWN - 1))
        near = cell_key(probe(apart, own, _PROBES[-1])[0], 0)
        at = np.minimum(np.searchsorted(keys, near), len(keys) - 1)
        met = np.where(keys[at] == near, counts[at], 0).mean(axis=0) / _DRAWN
        for blocks in _BLOCKS:
            x = rng.normal(size=(_DRAWN // 2, 8 * blocks))
            y = threshold * x + np.sqrt(1 - threshold**2) * rng.normal(size=x.shape)
            (a, looked), (b, seen) = (_points(_snapped(z * spread), _PROBES[-1]) for z in (x, y))
            hits = (looked == b[:, None]) | (seen == a[:, None])
            for probes in _PROBES:
                close = (a == b) | hits[:, :probes].any(axis=1)
                probed = float(met[:probes].mean()) if probes else 0.0
                found[blocks, side, probes] = float(close.mean()), same**blocks, probed * same ** (blocks - 1)
    return found


def expected(count: int, how: Lattice) -> tuple[float, float]:
    """(recall of pairs at the threshold, comparisons a vector) among ``count`` unrelated vectors.

    ``how`` must be one that ``planned`` can give.
    """
    close, same, probed = _chances(how.threshold, how.seed)[how.blocks, how.side, how.probes]
    return 1 - (1 - close) ** how.tables, how.tables * count * (same + 2 * how.probes * probed)


@lru_cache(maxsize=64)
def planned(count: int, threshold: float = 0.9, recall: float = 0.98, seed: int = 5) -> Lattice:
    """The cheapest lattice for ``count`` vectors that finds ``recall`` of the pairs at just the threshold.

    Closer pairs are found more often; in few dimensions projections are less
    normal and a few in 100 less are found. The cost is that of keys, of vectors
    sent to cells where they meet another, and of comparisons.
    """
    best, least = None, np.inf
    for (blocks, side, probes), (close, same, probed) in _chances(threshold, seed).items():
        if close < 0.05:
            continue
        tables = 1 if close >= recall else int(np.ceil(np.log(1 - recall) / np.log(1 - close)))
        others = count * (same + probes * probed)
        sent = -np.expm1(-others) - probes * np.expm1(-count * probed)
        keys = blocks * (_DECODE + _PROBE * (probes > 0)) + (1 + probes) * _KEY
        cost = tables * (keys + _SENT * sent + count * (same + 2 * probes * probed))
        if cost < least:
            best, least = Lattice(threshold, tables, probes, side, blocks, seed), cost
    return best


@lru_cache(maxsize=64)
def _directions(size: int, table: int, blocks: int, seed: int) -> np.ndarray:
    """Random directions, eight for each block, orthogonal if there is room for them."""
    rng = np.random.default_rng([seed, table, size])
    drawn = rng.normal(size=(size, 8 * blocks))
    if size >= 8 * blocks:
        drawn = np.linalg.qr(drawn)[0]
    elif size >= 8:
        drawn = np.concatenate([np.linalg.qr(part)[0] for part in np.split(drawn, blocks, axis=1)], axis=1)
    else:
        drawn = drawn / np.sqrt(size)
    return _snapped(drawn)


def _snapped(values: np.ndarray) -> np.ndarray:
    return np.rint(values * _GRID) / _GRID


def _points(y: np.ndarray, probes: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the own cell (n) and of the ``probes`` neighbouring cells nearest to ``y`` (n x probes)."""
    parts = [y[:, at : at + 8] for at in range(0, y.shape[1], 8)]
    points = [decode(part) for part in parts]
    whole = np.concatenate(points, axis=1)
    own = cell_key(whole, salt)
    if not probes:
        return own, np.empty((len(y), 0), np.int64)
    steps = [probe(part, point, probes) for part, point in zip(parts, points, strict=True)]
    order = np.concatenate([extra for _, extra in steps], axis=1).argsort(axis=1, kind="stable")[:, :probes]
    block, turn = np.divmod(order, probes)
    cells = np.repeat(whole[:, None, :], probes, axis=1)
    for b, (moved, _) in enumerate(steps):
        row, place = np.nonzero(block == b)
        cells[row, place, 8 * b : 8 * b + 8] = moved[row, turn[row, place]]
    return own, cell_key(cells, salt)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _table_cells(snapped: np.ndarray, how: Lattice, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n) and probed cells (n x probes) in one table, of unit vectors on the grid."""
    size = snapped.shape[1]
    # The scale keeps the spread of random vectors the same in any dimension.
    scale = how.side * np.sqrt(64 / size)
    y = _snapped(snapped @ _directions(size, table, how.blocks, how.seed) / scale)
    return _points(y, how.probes, table + how.tables * size)


def cells(vectors: np.ndarray, how: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n x tables) and probed cells (n x tables x probes) of unit vectors."""
    snapped = _snapped(vectors)
    own, probed = zip(*(_table_cells(snapped, how, table) for table in range(how.tables)), strict=True)
    return np.stack(own, axis=1), np.stack(probed, axis=1)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of the list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def _dealt(batches, how: Lattice) -> Iterator[pa.RecordBatch]:
    """A row for each cell a vector lies in or looks into."""
    each = how.tables * (1 + how.probes)
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        for rows, matrix in _vectors(batch.column("embedding")):
            for begin in range(0, len(rows), 2048):
                part = rows[begin : begin + 2048]
                own, probed = cells(unit(matrix[begin : begin + 2048]), how)
                every = np.concatenate([own[:, :, None], probed], axis=2)
                n = len(part)
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": every.reshape(-1),
                        "turn": np.tile(np.repeat(np.arange(how.tables, dtype=np.int32), 1 + how.probes), n),
                        "own": np.tile(np.arange(1 + how.probes) == 0, n * how.tables),
                        "node": np.repeat(nodes[part], each),
                    }
                )


def _first_meeting(
    vectors: np.ndarray, low: np.ndarray, high: np.ndarray, table: int, event: np.ndarray, how: Lattice
) -> np.ndarray:
    """The pairs of ``vectors`` (lower node first) that meet first in ``table``, by ``event``.

    In a table the events are: the same cell, the lower looks into the other's
    cell, the higher does. Only pairs that have not met are followed from
    table to table.
    """
    left = np.arange(len(low))
    for t in range(table + 1):
        used = np.zeros(len(vectors), dtype=bool)
        used[low[left]] = used[high[left]] = True
        place = np.cumsum(used) - 1
        own, probed = _table_cells(_snapped(vectors[used]), how, t)
        new = np.ones(len(left), dtype=bool)
        for begin in range(0, len(left), 65_536):
            part = left[begin : begin + 65_536]
            x, y = place[low[part]], place[high[part]]
            same = own[x] == own[y]
            lower = (probed[x] == own[y][:, None]).any(axis=1)
            if t < table:
                higher = (probed[y] == own[x][:, None]).any(axis=1)
                new[begin : begin + 65_536] = ~(same | lower | higher)
            else:
                new[begin : begin + 65_536] = ~(same & (event[part] > 0)) & ~(lower & (event[part] > 1))
        left = left[new]
        if not len(left):
            break
    return left


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and ``y`` with a product of at least the threshold."""
    found = []
    for begin in range(0, len(x), _TILE):
        a, b = np.nonzero(x[begin : begin + _TILE] @ y.T >= threshold)
        found.append((a + begin, b))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _compared(group: dict, i: int, j: int, how: Lattice) -> dict | None:
    """Links of the vectors of one pair of chunks: node, weight linked first here, lowest node reached."""
    node, own, chunk, table = group["node"], group["own"], group["chunk"], int(group["turn"][0])
    left = np.flatnonzero(own & (chunk == i))
    right = np.flatnonzero(~own | (chunk == j) if j != i else ~own)
    if not len(left):
        return None
    vectors = unit(group["vectors"])
    if i == j:
        # Each pair of the chunk once, and the chunk with those that look in.
        a, b = _linked(vectors[left], vectors[np.concatenate([left, right])], how.threshold)
        kept = a < b
        a, b = left[a[kept]], np.concatenate([left, right])[b[kept]]
    elif len(right):
        a, b = _linked(vectors[left], vectors[right], how.threshold)
        a, b = left[a], right[b]
    else:
        return None
    if not len(a):
        return None
    low, high = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
    event = np.where(own[a] & own[b], 0, np.where(own[low], 2, 1))
    new = _first_meeting(vectors, low, high, table, event, how)
    weight = group["weight"]
    links = np.bincount(a[new], weight[b[new]], len(node)) + np.bincount(b[new], weight[a[new]], len(node))
    root = node.copy()
    while True:
        lowest = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, lowest)
        np.minimum.at(after, b, lowest)
        if (after == root).all():
            break
        root = after
    met = np.zeros(len(node), dtype=bool)
    met[a] = met[b] = True
    return {"node": node[met], "links": np.rint(links[met]).astype(np.int64), "root": root[met]}


def _chunks(batches, how: Lattice) -> Iterator[pa.RecordBatch]:
    """Compare the groups of rows that arrive together, sorted by cell and pair of chunks."""
    held: list[pa.RecordBatch] = []
    key = None

    def compared():
        if not held:
            return
        table = pa.Table.from_batches(held)
        if table.num_rows > 1:
            group = {n: table.column(n).to_numpy() for n in ("node", "own", "chunk", "turn", "weight")}
            flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            group["vectors"] = flat.reshape(table.num_rows, -1)
            found = _compared(group, key[1], key[2], how)
            if found:
                yield pa.RecordBatch.from_pydict(found)

    for batch in batches:
        names = [batch.column(n).to_numpy() for n in ("cell", "i", "j")]
        change = np.zeros(batch.num_rows, dtype=bool)
        for values in names:
            change[1:] |= values[1:] != values[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end == begin:
                continue
            now = tuple(int(values[begin]) for values in names)
            if now != key:
                yield from compared()
                held, key = [], now
            held.append(batch.slice(begin, end - begin))
    yield from compared()


def near(embeddings: DataFrame, how: Lattice | None = None) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose vectors were found with a cosine
    of at least the threshold, by ``how`` or else by what ``planned`` gives for
    the number of different vectors; ``component_id`` is the smallest vec_id
    reachable by links and ``kept`` marks it. Vectors that are null, empty or
    zero, or hold nulls or numbers that are not finite, link with nothing, and
    so do vectors of different lengths with each other. Rows that repeat count
    one by one. A row without vec_id has no links, no component, and is not
    kept. Other columns are not read; an empty table gives no row.
    """
    spark = embeddings.sparkSession
    ship(spark)
    kind = embeddings.schema["embedding"].dataType.elementType.typeName()
    vector = F.col("embedding") if kind == "float" else F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", vector.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("embedding")))
    classes = rows.where("node is not null").groupBy("node", "embedding").agg(F.count(F.lit(1)).alias("weight"))
    classes = materialise(classes, "classes")

    how = how or planned(1 << classes.count().bit_length())
    slim = classes.mapInArrow(lambda b: _dealt(b, how), "cell long, turn int, own boolean, node long")
    slim = materialise(slim, "cells")
    sizes = slim.groupBy("cell").agg(
        F.sum(F.col("own").cast("long")).alias("owns"), F.count(F.lit(1)).alias("rows")
    )
    # Cells in which nobody meets anybody are left out before any vector is sent.
    met = sizes.where("owns > 0 and rows > 1").select(
        F.col("cell"),
        F.when(F.col("rows") > _CHUNK, F.ceil(F.col("owns") / _CHUNK)).cast("int").alias("n_own"),
        F.greatest(F.ceil((F.col("rows") - F.col("owns")) / _CHUNK), F.lit(1)).cast("int").alias("n_probe"),
    )
    dealt = slim.join(materialise(met, "met"), "cell")
    last = F.col("n_own") + F.col("n_probe") - 1
    own_chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("n_own")).cast("int")
    probe_chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("n_probe")).cast("int")
    dealt = dealt.withColumn(
        "chunk", F.coalesce(F.when(F.col("own"), own_chunk).otherwise(F.col("n_own") + probe_chunk), F.lit(0))
    )
    # A row of its own cell meets every chunk, a row that looks in meets the chunks of the cell.
    others = F.sequence(F.lit(0), F.when(F.col("own"), last).otherwise(F.col("n_own") - 1))
    dealt = dealt.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0)))))
    split = F.col("n_own").isNotNull()
    dealt = dealt.withColumn("i", F.when(split, F.least("chunk", "other")).otherwise(0)).withColumn(
        "j", F.when(split, F.greatest("chunk", "other")).otherwise(0)
    ).drop("other", "n_own", "n_probe")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.join(classes, "node")
    dealt = dealt.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    found = dealt.mapInArrow(lambda b: _chunks(b, how), "node long, links long, root long")
    found = materialise(found, "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    info = classes.select("node", "weight").join(links, "node", "left").join(labels, "node", "left")
    info = materialise(info.withColumn("component", F.coalesce("component", "node")), "info")
    ids = rows.select("vec_id", "node").join(info, "node", "left")
    ids = materialise(ids.drop("node"), "rows")
    lowest = ids.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("low"))
    joined = ids.join(materialise(lowest, "lowest"), "component", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("low", "vec_id"))
    return joined.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
