"""The registered queries over the smallest tables, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from tillroll.llm import mixing, neardup, packing, secrets
from tillroll.llm.queries import ORACLE, QUERIES
from tillroll.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_mixing_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = connection.execute(ORACLE["op7_mixing"]).fetchall()
    assert sorted(map(tuple, QUERIES["op7_mixing"](spark, SF).collect())) == sorted(expected)


@pytest.mark.parametrize("name", ["op1_sharding", "op4_fingerprints", "op5_quality", "op6_toxicity", "op9_secrets"])
def test_queries_give_a_row_per_document(spark, name):
    found = QUERIES[name](spark, SF)
    ids = [row["doc_id"] for row in found.select("doc_id").collect()]
    assert sorted(ids) == sorted(row["doc_id"] for row in table(spark, SF, "documents").select("doc_id").collect())


def test_pages_give_a_row_each(spark):
    pages = table(spark, SF, "pages").count()
    assert QUERIES["op10_html"](spark, SF).filter("n_chars > 0").count() == pages
    assert QUERIES["op8_language"](spark, SF).filter("language = declared").count() == pages


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF, "documents").cache()
    known = corpus_pipeline.known_language(spark, docs, SF).cache()
    assert known.count() == docs.count() and known.columns == docs.columns
    single = corpus_pipeline.without_near_duplicates(spark, known, SF).cache()
    classes = neardup.near_duplicates(known).select("class_id").distinct().count()
    assert single.count() == classes and single.columns == docs.columns
    clean = corpus_pipeline.without_secrets(spark, single, SF).cache()
    assert clean.count() == single.count() and secrets.find_secrets(clean).filter("n_live > 0").count() == 0
    mixed = corpus_pipeline.mixed_sources(spark, clean, SF).cache()
    assert mixed.columns == docs.columns and mixed.count() > 0
    most = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert most <= mixing.REPEATS
    pieces = corpus_pipeline.packed(spark, mixed, SF)
    assert pieces.filter("piece = 0").count() == mixed.count()
    assert pieces.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= packing.CAPACITY
