"""Registration, SQL agreement on the small table and the pipeline's stages."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from tidemark.sources.tables import SOURCE_TABLES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", ["op1_decontaminate", "op6_jaccard", "op7_shards", "op8_fixity", "op10_language", "op11_fim", "op12_topk", "op13_ranked"])
def test_sql(spark, name):
    from check_oracle import rows_of

    con = duckdb.connect()
    for t in SOURCE_TABLES:
        if os.path.exists(f"{SF_SMALL}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    told = E.queries()["op10_language"](spark, SF_SMALL).join(docs, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right[1] > 10 and right[0] >= 0.95


def test_pipeline_stages(spark):
    docs, kept = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    odd = spark.createDataFrame([(10**9, None, None, "s", 0), (10**9 + 1, "1234 !!", "en", "s", 8)], docs.schema)
    docs = docs.unionByName(odd)
    first = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == first.columns, name
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    everything = {r.doc_id for r in first.select("doc_id").collect()}
    assert everything - kept[0] >= {10**9, 10**9 + 1} and len(everything - kept[0]) <= 4
    # of each component of near copies the smallest id stays
    from tidemark.llm import decontam, jaccard

    after_language = first.where(F.col("doc_id").isin(list(kept[0])))
    parts = {r.doc_id: r.component_id for r in jaccard.similarity_report(after_language).collect()}
    assert kept[1] == {c for c in parts.values()}
    after_copies = first.where(F.col("doc_id").isin(list(kept[1])))
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert kept[2] == {r.doc_id for r in decontam.contamination(after_copies, bench).collect() if not r.contaminated}
    mixed = corpus_pipeline.mix(spark, docs, SF_SMALL)
    assert mixed.columns == first.columns and {r.doc_id for r in mixed.select("doc_id").collect()} == kept[2]
    out = corpus_pipeline.shard(spark, mixed, SF_SMALL)
    assert out.count() == mixed.count() and "shard" in out.columns


def test_near_copies_keep_one_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, "", "en", "s", 0), (3, "", "en", "s", 0), (None, text, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    got = corpus_pipeline.near_copies(spark, docs, SF_SMALL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got if r.text) in ([(False, 1, text)], [(True, 0, text)])
    assert sum(1 for r in got if r.text == "") == 2


def test_decontamination_judges_rows_that_share_an_id_each(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(1).drop("doc_id", "text")
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").where("length(text) > 100").first().text
    clean = " ".join(f"unlike{i}" for i in range(40))
    given = spark.createDataFrame([(None, item), (None, clean), (7, item), (7, clean), (8, clean)], "doc_id BIGINT, text STRING")
    left = corpus_pipeline.decontaminate(spark, given.crossJoin(docs), SF_SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, clean), (7, clean), (8, clean)]


CLASHING = ["th", "_chance", "score", "lang_pred", "rate", "copies", "_maybe", "_s", "_bits", "p", "_text", "component", "row", "a b", "n_tokens", "doc id"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(f"own {i}") if i % 2 else F.lit(i).cast("long"))
    docs = docs.cache()
    want = {tuple(r[n] for n in CLASHING) for r in docs.select(*[f"`{n}`" for n in CLASHING]).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_SMALL)
        assert got.columns == docs.columns, name
        assert got.dtypes == docs.dtypes, name
        assert {tuple(r[n] for n in CLASHING) for r in got.select(*[f"`{n}`" for n in CLASHING]).collect()} == want, name
    assert corpus_pipeline.shard(spark, docs, SF_SMALL).count() == docs.count()


def test_pipeline_of_an_empty_table(spark, tmp_root):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_root}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_root).collect() == []
