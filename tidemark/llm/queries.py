"""The language-model data operators as named queries over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    collocations,
    embedding,
    jaccard,
    language,
    licenses,
    merkle,
    packing,
    quality,
    secrets,
    toxicity,
    warc,
    whitening,
)
from tidemark.llm.sampling import fold
from tidemark.scale import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


TOXIC_FROM = 0.3
GOOD_FROM = 0.5


def op1_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = warc.write(pages, folder)
    keys = pages.select(warc.url_key(F.col("url")).alias("key"))
    captures = warc.lookup(archives, folder, keys)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 3) == 1)
    model = language.fit(docs, ~F.col("held_out"))
    return language.predict(docs, model, ["doc_id", "held_out"])


def op5_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = toxicity.score(docs, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op3_best_fit_packing(spark, sf_dir):
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, size=1024, end_id=2, added=added)


def op4_byte_bpe(spark, sf_dir):
    tokens = byte_bpe.encode(table(spark, sf_dir, "documents"), RANKS, decoded=True)
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_ngram_jaccard_join(spark, sf_dir):
    how = jaccard.Similarity(words=3, num=90, den=100)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), how)


def op8_quality(spark, sf_dir):
    scored = quality.classify(table(spark, sf_dir, "documents"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


def op9_embedding_near_dedup(spark, sf_dir):
    return embedding.near(table(spark, sf_dir, "embeddings"))


def op10_fingerprints(spark, sf_dir):
    return merkle.edits(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    base = secrets.listed("spans", *secrets.KINDS[:3]).cast("binary")
    return found.select(
        "doc_id",
        *(secrets.counted("spans", kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        secrets.listed("spans", *secrets.KINDS).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_quality": op8_quality,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_secrets": op13_secrets,
}
