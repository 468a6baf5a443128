"""The corpus pipeline: five stages over documents, each written and read again.

Language identification, near-copy removal, benchmark decontamination, mixing and
sharding.  Every stage reads all rows that the one before it kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, jaccard, langid, mixing, sharding
from tidemark.llm.common import cut, held_out, maybe, shared_dir, table
from tidemark.llm.queries import labelled_domains

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose n-grams fit no learned language better than this is rejected.
MIN_SCORE = 0.05
#: Rows up to which a side of ids and hashes is broadcast.
SMALL_ROWS = 10_000


#: The input's columns that a stage does not read travel in one struct of this name, so none can clash with a working column.
REST = "_rest_of_row"


def packed(docs: DataFrame, *read: str) -> DataFrame:
    """The columns that a stage reads, and all others as one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in read]
    return docs.select(*read, (F.struct(*others) if others else F.lit(None).cast("int")).alias(REST))


def unpacked(rows: DataFrame, docs: DataFrame, *read: str) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return rows.select(*[F.col(c) if c in read else F.col(f"{REST}.`{c}`").alias(c) for c in docs.columns])


def without(docs: DataFrame, key: list[F.Column], gone: DataFrame, names: list[str]) -> DataFrame:
    """``docs``, packed, but the rows whose ``key`` is in ``gone`` (columns ``names``); rows that are
    surely not in it are not shuffled."""
    flagged = maybe(docs, F.xxhash64(*key), gone, F.xxhash64(*names))
    for n, k in zip(names, key, strict=True):
        flagged = flagged.withColumn(f"_key_{n}", k)
    same = [F.col(f"_key_{n}").eqNullSafe(F.col(f"gone.{n}")) for n in names]
    met = flagged.where("_maybe").join(gone.alias("gone"), same, "left_anti")
    return flagged.where("not _maybe").unionByName(met).select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; a missing lang is filled in.

    Null, empty and letterless texts go.  A tie between languages goes to the smaller name.  Long
    texts are read whole, repeated rows judged alike, an empty table stays empty, and every
    column comes back as it was, whatever its name.
    """
    train = docs.where(~held_out(F.col("doc_id"))).select("text", "lang")
    told = langid.identify(packed(docs, "text", "lang"), train, keep_text=True)
    known = told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return unpacked(known.withColumn("lang", F.coalesce("lang", "lang_pred")), docs, "text", "lang")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id.

    A null id counts as the smallest; of one id the text of the smallest hash stays, of rows equal in id and
    text one.  Null and empty texts have no copies and stay.  An empty table stays empty, and
    every column comes back as it was, whatever its name.
    """
    rows = packed(docs, "doc_id", "text")
    sets, _, joined = jaccard.similar_classes(rows.select("doc_id", "text"))
    placed = sets.where("class_id IS NOT NULL").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left") \
        .withColumn("component", F.coalesce("component", "class_id"))
    # rows of one id and text are equal: of those that stay, one does
    each = cut(placed.groupBy("component", "doc_id", "th").agg(F.count("*").alias("n")), "placed-documents")
    first = each.groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    judged = each.join(first, "component").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    gone = cut(judged.where("NOT stays OR n > 1").select("doc_id", "th", "stays"), "removed-documents")
    key = [F.col("doc_id").cast("long"), F.xxhash64("text")]
    rest = without(rows, key, gone, ["doc_id", "th"])
    once = gone.where("stays").select(F.col("doc_id").alias("id"), "th")
    if once.limit(SMALL_ROWS).count() < SMALL_ROWS:
        once = F.broadcast(once)
    again = rows.withColumn("th", key[1]).alias("d").join(
        once.alias("g"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.id")) & (F.col("d.th") == F.col("g.th")), "left_semi")
    return unpacked(rest.unionByName(again.dropDuplicates(["doc_id", "th"]).drop("th")), docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more stands in benchmark windows; rows that
    share an id, or have none, are judged each by its own text.

    Null and empty texts have no words and stay; repeated rows go or stay together; long texts are read
    whole; an empty table stays empty, and every column comes back as it was, whatever its name.
    """
    rows = packed(docs, "doc_id", "text")
    key = F.xxhash64("doc_id", "text")
    report = decontam.contamination(rows.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = cut(report.where("contaminated").select("doc_id").distinct(), "contaminated")
    return unpacked(without(rows, [key], gone, ["doc_id"]), docs, "doc_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of the domains that are short of their targets; drops none.

    Null and empty texts have no tokens and stay; rows equal in id and text are repeated alike; without labelled
    rows, or on an empty table, nothing changes; every column comes back as it was, whatever its name.
    """
    rows = packed(docs, "doc_id", "text")
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    return unpacked(mixing.repeated(mixing.mix(rows, labelled, least=1.0), rows.columns), docs, "doc_id", "text")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus with each row's shard, page and the shard's size.

    Null and empty texts have no bytes; rows equal in id and text, which no hash parts, are paged; a text over a
    shard's limit is a shard alone; an empty table gives no rows; a column called like an added one is replaced.
    """
    return sharding.with_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: Rank-order profiles and fitted rates are no SQL; tests hold the stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are Parquet in the shared folder."""
    docs, base = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/tidemark/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
