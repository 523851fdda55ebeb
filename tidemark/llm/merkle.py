"""Document fingerprints: Merkle trees over sections and paragraphs, in DataFrame expressions only.

A section is a line. Its paragraphs are pieces that end with a sentence, or
after 96 characters without an end. Paragraph hashes make the section's hash,
section hashes the root. A fingerprint is the whole root and the first eight
digits of every node below it: ``root:section.leaf.leaf/section.leaf/...``.
Equal roots mean equal texts; differing branches tell where texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scale import materialise

_PIECE = "[^.!?]{1,96}[.!?]*|[.!?]+"
_SHORT = 8


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tree(text: Column) -> Column:
    """Per section a struct of its hash and the hashes of its paragraphs."""

    def section(line: Column) -> Column:
        return F.transform(F.regexp_extract_all(line, F.lit(_PIECE), F.lit(0)), _sha)

    leaves = F.transform(F.split(text, "\n"), section)
    return F.transform(leaves, lambda found: F.struct(_sha(F.concat_ws("", found)).alias("hash"), found.alias("leaves")))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty."""
    sections = tree(F.coalesce(text, F.lit("")))

    def written(section: Column) -> Column:
        short = F.transform(section["leaves"], lambda leaf: F.substring(leaf, 1, _SHORT))
        return F.concat_ws(".", F.array(F.substring(section["hash"], 1, _SHORT)), short)

    def whole(nodes: Column) -> Column:
        root = _sha(F.concat_ws("", F.transform(nodes, lambda s: s["hash"])))
        return F.concat(root, F.lit(":"), F.concat_ws("/", F.transform(nodes, written)))

    # One lambda argument holds the tree, so that it is built once.
    return F.transform(F.array(sections), whole)[0]


def nodes(mark: Column) -> Column:
    """The distinct sections and paragraphs of a fingerprint."""
    return F.array_distinct(F.split(F.substring_index(mark, ":", -1), "[./]"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal branches of two fingerprints, 1 only for equal texts, null if one is null."""

    def share(pair: Column) -> Column:
        both = F.size(F.array_intersect(pair["a"], pair["b"]))
        return both * 2.0 / (F.size(pair["a"]) + F.size(pair["b"]))

    parts = F.array(F.struct(nodes(a).alias("a"), nodes(b).alias("b")))
    return F.when(a == b, 1.0).when(a != b, F.least(F.transform(parts, share)[0], F.lit(0.9999)))


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of ``b`` that differ from the same section of ``a``."""
    left, right = (F.split(F.substring_index(mark, ":", -1), "/") for mark in (a, b))
    differs = F.transform(
        F.arrays_zip(left.alias("x"), right.alias("y")),
        lambda pair, i: F.when(~pair["x"].eqNullSafe(pair["y"]), i),
    )
    return F.array_compact(differs)


def followers(ids: DataFrame) -> DataFrame:
    """(doc_id, owner): each distinct id with the next smaller one; the smallest with the largest.

    Ids are range-partitioned and each partition is ordered for itself; only
    the partitions' ends, one row each, meet in one place.
    """
    distinct = ids.where("doc_id is not null").select("doc_id").distinct()
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = distinct.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    ends = ranged.groupBy("part").agg(F.max("doc_id").alias("high"))
    ends = materialise(ends.coalesce(1), "ends")  # a row for each partition
    before = F.lag("high").over(Window.orderBy("part"))
    largest = F.max("high").over(Window.partitionBy(F.lit(0)))
    ends = ends.select("part", F.coalesce(before, largest).alias("earlier"))
    inside = F.lag("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    linked = ranged.withColumn("owner", inside).join(F.broadcast(ends), "part")
    return linked.select("doc_id", F.coalesce("owner", "earlier").alias("owner"))


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The last quarter (rounded down, in code points) of a text gives way to as
    many of the first of the next document by doc_id, after the last the first.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null counts as empty. If rows share a doc_id, each
    has a row of its own and the smallest text counts as that document's where
    it is the next one. A row without doc_id has an empty next document. Other
    columns are not read; an empty table gives no row.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    slim = materialise(texts.select("doc_id", F.floor(F.length("text") / 4).alias("quarter")), "sizes")
    links = followers(slim)
    quarter = slim.where("doc_id is not null").groupBy("doc_id").agg(F.max("quarter").alias("quarter"), F.count(F.lit(1)).alias("rows"))
    quarter = materialise(quarter, "quarters")
    links = links.join(quarter.select(F.col("doc_id").alias("owner"), "quarter"), "owner")
    links = materialise(links, "followers")
    following = texts.join(links, "doc_id")
    if not quarter.where("rows > 1").isEmpty():
        following = following.groupBy("owner").agg(F.min("text").alias("text"), F.first("quarter").alias("quarter"))
    following = following.select(
        F.col("owner").alias("doc_id"),
        F.left("text", F.col("quarter").cast("int")).alias("head"),
        fingerprint(F.col("text")).alias("next_fingerprint"),
    )
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    # Asking for an id as the join above does makes both read one shuffle of the texts.
    known = texts.where("doc_id is not null").join(following, "doc_id", "left")
    unknown = texts.where("doc_id is null").withColumns(
        {"head": F.lit(None).cast("string"), "next_fingerprint": F.lit(None).cast("string")}
    )
    rows = known.unionByName(unknown).select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "text",
        F.concat(
            F.left("text", size - cut), F.left(F.coalesce(F.col("head"), F.lit("")), cut)
        ).alias("edited"),
        "next_fingerprint",
    )
    rows = rows.select(
        "doc_id",
        "n_chars",
        _sha(F.col("edited")).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        F.coalesce("next_fingerprint", fingerprint(F.lit(""))).alias("next_fingerprint"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
