"""A cleaning pipeline over ``documents``, each stage written and read again by the next.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last
return the columns they were given, whatever their names. Null and empty texts
are rejected by the first stage, which finds no language in them; empty tables
pass through. Extra columns are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, packing, toxicity
from tidemark.llm.jaccard import Similarity, jaccard_components, limited
from tidemark.scale import materialise

# A text is rejected if being junk is likelier than any language, or no language is as likely as this.
LEAST_LANGUAGE = 0.25
# A text is rejected as toxic from this score on.
TOXIC_FROM = 0.3
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ADDED = public_tokenizers.path("byte_bpe_50k.json")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts in which a language is found; learned from the texts that have a lang, and from junk."""
    model = language.fit(docs, F.lit(True), reject=True)
    found, score = _free(docs, "found_language"), _free(docs, "found_score")
    rows = language.predict(docs, model, docs.columns, (found, score))
    known = (F.col(found) != language.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE)
    return rows.where(known).select(docs.columns)


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts that are not toxic; learned from the toxic rows of ``labels`` and unlabelled texts."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    score = _free(docs, "toxic_score")
    rows = toxicity.score(docs, model, docs.columns, score)
    return rows.where(F.col(score) < TOXIC_FROM).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that five-word shingles link at 0.8 or more.

    The one with the smallest doc_id stays; of linked rows that repeat it one
    stays, of copies any. Unlinked texts under one doc_id are judged each for
    itself. Rows without doc_id stay.
    """
    groups = jaccard_components(docs, Similarity(words=5, num=80, den=100), by_text=True)
    groups = materialise(groups, "groups")
    twice = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        kept = groups.where("component_id = doc_id").groupBy("doc_id", "component")
        kept = kept.agg(F.min("text_hash").alias("kept_hash")).select(F.col("doc_id").alias("kept_id"), "kept_hash")
        kept = limited(kept)
        row_hash = _free(docs, "row_hash")
        known = docs.where("doc_id is not null").withColumn(row_hash, F.xxhash64(F.col("text").cast("string")))
        known = known.join(kept, (known["doc_id"] == kept["kept_id"]) & (known[row_hash] == kept["kept_hash"]), "left_semi")
        known = known.dropDuplicates(["doc_id", row_hash]).select(docs.columns)
        return known.unionByName(docs.where("doc_id is null"))
    gone = limited(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences of 1024."""
    return packing.pack(docs, RANKS, size=1024, end_id=2, added=packing.added_tokens(ADDED))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic_texts),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

# Two stages learn models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
