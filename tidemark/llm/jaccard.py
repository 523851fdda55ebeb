"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches a threshold. Tokens (shingle hashes) get one global order, rarest
first. If two sets share at least ``a`` tokens, then their first
``size - a + l`` tokens in that order share at least ``l`` of them, for every
``l <= a``. Each document picks its own ``l``: a longer prefix costs more
postings but asks for more shared ones, and the choice is the cheaper by the
estimated posting lengths. Two documents are verified when they share
``min(l, l')`` tokens inside the prefixes that their sizes imply.

A group of copies may hold a third of all rows, so links are not listed pair
by pair inside a group. Equal sets count as one document. In a long posting
every document is first compared with one hub only, and connected documents
are taken together; then all pairs that share prefix tokens but are still in
different components are counted and verified. No link between components is
missed, because every linked pair passes the prefix condition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import chunks, shingle_sets
from tidemark.llm.components import connected
from tidemark.llm.ship import ship
from tidemark.scale import materialise

# The sketch of token counts has a fixed size, whatever the corpus.
_SKETCH_BITS = 20
_SLICES = 64
# Postings beyond this length meet their hub before pairs are formed.
_HUB_OVER = 16
# Up to this many ids (16 MB) are broadcast; more take a shuffle join.
_BROADCAST_IDS = 1_000_000
# Cost of verifying a candidate, in postings read.
_VERIFY = 8.0


@dataclass(frozen=True)
class Similarity:
    """Shingle length in words, and the threshold ``num / den``."""

    words: int = 5
    num: int = 80
    den: int = 100
    max_match: int = 4

    def least(self, n: int) -> int:
        """Tokens a set of ``n`` must share with any partner."""
        return -(-self.num * n // self.den)


def _token_counts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << _SKETCH_BITS, dtype=np.int64)
    for batch in batches:
        for _, _, raw, offsets in chunks(batch.column("text")):
            if sets := [s for s in shingle_sets(raw, offsets, k) if len(s)]:
                bucket = np.concatenate(sets) >> np.uint64(64 - _SKETCH_BITS)
                counts += np.bincount(bucket.astype(np.int64), minlength=len(counts))
    counts = np.minimum(counts, 2**31 - 1).astype("<i4").reshape(_SLICES, -1)
    yield pa.RecordBatch.from_pydict(
        {"slice": pa.array(range(_SLICES), pa.int32()), "counts": [row.tobytes() for row in counts]}
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = np.frombuffer(counts, dtype="<i4").astype(np.int64)
            total[at] = total[at] + row if at in total else row
    if total:
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(list(total), pa.int32()), "counts": [t.tobytes() for t in total.values()]}
        )


def token_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counts of the documents holding a token, by the token's leading bits."""
    partial = docs.select("text").mapInArrow(
        lambda batches: _token_counts(batches, k), "slice int, counts binary"
    )
    # One running sum a slice, read as a stream: memory does not grow with the tasks.
    whole = partial.repartition(_SLICES, "slice").mapInArrow(_summed, "slice int, counts binary")
    sketch = np.zeros((_SLICES, (1 << _SKETCH_BITS) // _SLICES), dtype=np.int64)
    for row in whole.collect():  # _SLICES rows of fixed size
        sketch[row["slice"]] = np.frombuffer(row["counts"], dtype=np.int64)
    return np.minimum(sketch.reshape(-1), 2**31 - 1).astype(np.int32)


def prefix(tokens: np.ndarray, sketch: np.ndarray, noise: float, how: Similarity) -> tuple[int, np.ndarray]:
    """The number of matches asked for, and the tokens of the longest prefix needed, in order."""
    n = len(tokens)
    need = how.least(n)
    most = min(how.max_match, need)
    count = sketch[(tokens >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)]
    size = n - need + most
    near = np.flatnonzero(count <= np.partition(count, size - 1)[size - 1])
    order = near[np.lexsort((tokens[near], count[near]))][:size]
    length = np.cumsum(np.maximum(count[order] - noise, 0.0) + 1.0)
    match = np.arange(1, most + 1)
    postings = length[n - need + match - 1]
    best = int(np.argmin(postings * (1 + _VERIFY / match)))
    return best + 1, tokens[order[: n - need + best + 1]].view(np.int64)


_PREFIXES = "doc_id long, n_shingles int, node long, matches int, prefix array<long>"
_SETS = "node long, tokens array<long>"


def _node(tokens: np.ndarray) -> int:
    """The id of a set: equal sets are one node, whatever their documents."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).view(np.int64)))


def _prefixes(batches, sketch, how: Similarity, more: list[str]) -> Iterator[pa.RecordBatch]:
    counts = sketch.value
    noise = float(np.median(counts))
    for batch in batches:
        for first, last, raw, offsets in chunks(batch.column("text")):
            rows = shingle_sets(raw, offsets, how.words)
            asked = [prefix(r, counts, noise, how) if len(r) else (0, r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array([len(r) for r in rows], pa.int32()),
                    pa.array([_node(r) for r in rows], pa.int64()),
                    pa.array([matches for matches, _ in asked], pa.int32()),
                    _lists([tokens for _, tokens in asked]),
                    *(batch.column(name).slice(first, last - first) for name in more),
                ],
                names=["doc_id", "n_shingles", "node", "matches", "prefix", *more],
            )


def _sets(batches, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offsets in chunks(batch.column("text")):
            rows = shingle_sets(raw, offsets, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(r) for r in rows], pa.int64()), _lists(rows)], names=["node", "tokens"]
            )


def _verified(docs: DataFrame, places: DataFrame, pairs: DataFrame, how: Similarity) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, from their whole texts."""
    pairs = materialise(pairs.select("a", "b"), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    ids = limited(places.join(nodes, "node", "left_semi").select("doc_id").distinct())
    sets = docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(
        lambda batches, k=how.words: _sets(batches, k), _SETS
    )
    sets = materialise(sets, "sets").dropDuplicates(["node"])
    sets = materialise(sets, "sets")
    both = pairs.join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    total = F.size("of_a") + F.size("of_b")
    return materialise(both.where(shared * (how.num + how.den) >= total * how.num).select("a", "b"), "links")


def _fits(a: str, b: str, how: Similarity) -> Column:
    """Whether two postings can belong to a linked pair.

    The sizes must allow it, the shared token must lie in both prefixes for the
    smaller ``matches``, and both prefixes must hold that many tokens that any
    other document has at all.
    """
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    least = F.ceil((n_a + n_b) * how.num / F.lit(float(how.num + how.den)) - 1e-9)
    level = F.least(f"{a}.matches", f"{b}.matches")
    fits = F.least(n_a, n_b) * how.den >= F.greatest(n_a, n_b) * how.num
    for side, n in ((a, n_a), (b, n_b)):
        last = F.greatest(F.col(f"{side}.at"), F.get(F.col(f"{side}.kept"), level - 1))
        fits = fits & F.get(F.col(f"{side}.kept"), level - 1).isNotNull() & (last <= n - least + level)
    return fits


def _spokes(postings: DataFrame, hubs: DataFrame, how: Similarity) -> DataFrame:
    """Every document of a long posting with the posting's hub."""
    x, y = postings.alias("x"), hubs.where(F.col("rows") > _HUB_OVER).alias("y")
    fits = _fits("x", "y", how) & (F.col("x.node") != F.col("y.node"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & fits)
    a, b = F.least("x.node", "y.node"), F.greatest("x.node", "y.node")
    return met.select(a.alias("a"), b.alias("b")).distinct()


def _candidates(postings: DataFrame, hubs: DataFrame, labels: DataFrame, how: Similarity) -> DataFrame:
    """Pairs in different components that share enough prefix tokens, each once (a < b)."""
    placed = postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    centre = hubs.select("token", "node").join(labels, "node", "left")
    centre = centre.select("token", F.coalesce("component", "node").alias("main"))
    placed = materialise(placed.join(materialise(centre, "centres"), "token"), "placed")
    # Of two components one is not the hub's: those rows against all rows are every pair.
    x, y = placed.where("component <> main").alias("x"), placed.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    asked = F.least("x.matches", "y.matches")
    hit = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") != F.col("y.component"))
        & once
        & _fits("x", "y", how),
    )
    pairs = hit.groupBy(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return pairs.agg(F.count(F.lit(1)).alias("shared"), F.min(asked).alias("asked")).where("shared >= asked")


def limited(ids: DataFrame) -> DataFrame:
    """``ids`` written, and marked for broadcasting if they are few."""
    ids = materialise(ids, "ids")
    return F.broadcast(ids) if ids.count() <= _BROADCAST_IDS else ids


def _one_each(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """One of the rows that share a node, for the nodes in ``repeated`` (node, first doc_id)."""
    repeated = limited(repeated)
    first = rows.join(repeated, "node", "left").where("first is null or first = doc_id").drop("first")
    twice = rows.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return first if twice.isEmpty() else first.dropDuplicates(["node"])


def jaccard_components(docs: DataFrame, how: Similarity = Similarity(), by_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links. Null and empty
    texts, and texts of white space, have no shingle and link with nothing; a
    row without doc_id does not link either and has no component. Different
    texts under one doc_id are compared each for itself. Other columns are not
    read; an empty table gives no row. With ``by_text`` each row also has its
    ``text_hash`` (xxhash64) and ``component``, the same for linked texts.
    """
    spark = docs.sparkSession
    ship(spark)
    extra = ["text_hash"] if by_text else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = spark.sparkContext.broadcast(token_sketch(docs, how.words))
    hashed = docs.select("*", *(F.xxhash64("text").alias(name) for name in extra))
    schema = _PREFIXES + "".join(f", {name} long" for name in extra)
    rows = hashed.mapInArrow(lambda batches: _prefixes(batches, sketch, how, extra), schema)
    rows = materialise(rows, "prefixes")
    linkable = rows.where("doc_id is not null and n_shingles > 0")

    places = linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    places = materialise(places, "places")
    single = _one_each(linkable, places.where("rows > 1").select("node", F.col("doc_id").alias("first")))
    exploded = single.select("node", F.posexplode("prefix").alias("at", "token"))
    exploded = exploded.withColumn("at", (F.col("at") + 1).cast("int"))
    tokens = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = materialise(exploded.join(materialise(tokens, "tokens"), "token"), "shared")
    # Where each document's first tokens with company are, as many as it may be asked for.
    kept = F.slice(F.array_sort(F.collect_list("at")), 1, how.max_match).alias("kept")
    kept = materialise(shared.groupBy("node").agg(kept), "kept")
    sizes = single.select("node", F.col("n_shingles").alias("n"), "matches").join(kept, "node")
    postings = materialise(shared.join(materialise(sizes, "sizes"), "node"), "postings")
    # The most central document of a posting is the one with the fewest rarer tokens.
    low = F.min(F.struct("at", "n", "node", "matches", "kept")).alias("low")
    hubs = postings.groupBy("token").agg(low, F.first("rows").alias("rows")).select("token", "rows", "low.*")
    hubs = materialise(hubs, "hubs")
    postings = postings.drop("rows")

    links = _verified(docs, places, _spokes(postings, hubs, how), how)
    labels = connected(links)
    more = _verified(docs, places, _candidates(postings, hubs, labels, how), how)
    if not more.isEmpty():
        labels = connected(links.unionAll(more))
    placed = rows.select("doc_id", "n_shingles", "node", *extra).join(labels, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    placed = materialise(placed.drop("node"), "placed")
    lowest = placed.where("doc_id is not null and n_shingles > 0").groupBy("component")
    lowest = lowest.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    placed = placed.join(materialise(lowest.drop("high"), "lowest"), "component", "left")
    grouped = F.when(F.col("n_shingles") > 0, F.col("low"))
    return placed.select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(grouped, "doc_id")).alias("component_id"),
        *(["component", *extra] if by_text else []),
    )
