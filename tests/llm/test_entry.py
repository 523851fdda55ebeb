"""The registered queries against their SQL, and the pipeline against brute force."""

import base64
import random
import string

import pytest
from cases import BASE, COLUMNS, TEXTS, documents, jaccard_groups
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidemark.llm import oracle
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], oracle.ORACLE[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    named = queries()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(named) and "pipeline" in named
    assert set(oracle.ORACLE) <= set(oracle_sql())


def test_stages_keep_columns_and_rows(spark, sf_dir):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.dtypes == docs.dtypes, name
        whole, rows = [tuple(r) for r in docs.collect()], [tuple(r) for r in kept.collect()]
        assert set(rows) <= set(whole), name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_texts_in_no_learned_language_are_rejected(spark, sf_larger):
    rng = random.Random(6)
    junk = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        *(base64.b64encode(rng.randbytes(300)).decode() for _ in range(15)),
        *(" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9))) for _ in range(40)) for _ in range(15)),
    ]
    docs = spark.read.parquet(f"{sf_larger}/documents.parquet")
    # Held-out texts and junk have no lang, so they are not learned from.
    held = docs.where("doc_id % 3 = 1 and length(text) >= 200").withColumn("lang", F.lit(None).cast("string"))
    rows = [(-i, t) for i, t in enumerate(junk, 1)]
    bad = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    columns = ["doc_id", "text", "lang"]
    given = docs.where("doc_id % 3 <> 1").select(columns).unionByName(held.select(columns)).unionByName(bad)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, given, sf_larger).select("doc_id").collect()}
    clean = {r.doc_id for r in held.select("doc_id").collect()}
    assert sum(i < 0 for i in kept) <= 1
    assert len(clean & kept) >= 0.98 * len(clean)


def test_one_document_of_each_group_stays(spark, sf_dir):
    docs = documents(spark)
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    groups = jaccard_groups(list(enumerate(TEXTS, 1)), 5, 80, 100)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(i for i, (_, low) in groups.items() if i == low)
    assert sum(r.doc_id is None for r in kept) == 1
    assert len(COLUMNS.split(",")) == len(kept[0])


def test_unlinked_texts_under_one_id_stay(spark, sf_dir):
    other, third = "quite another text of more than five words", "and one more that is like no other here"
    rows = [(3, BASE), (7, BASE + " tail"), (7, other), (8, other), (8, third), (8, third), (9, "x"), (9, "x")]
    docs = spark.createDataFrame([*rows, (None, BASE)], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect())
    assert kept == [(0, BASE), (3, BASE), (7, other), (8, third), (9, "x")]


def test_the_pipeline_is_its_stages(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    tongue = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, sf_dir).select("doc_id").collect()}
    clean = docs.where(docs.doc_id.isin(list(tongue)))
    polite = {r.doc_id for r in corpus_pipeline.toxic_texts(spark, clean, sf_dir).select("doc_id").collect()}
    groups = jaccard_groups([(i, texts[i]) for i in polite], 5, 80, 100)
    assert {r.doc_id for r in found.select("doc_id").collect()} == {i for i, (_, low) in groups.items() if i == low}
