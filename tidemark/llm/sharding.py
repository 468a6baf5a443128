"""Extendible hashing: cut a corpus into shards that fit a byte limit.

Every row has a 60-bit key (leading bits of an MD5 of its id and text).  The
directory is indexed by key prefixes; it starts with one bucket, and only a
bucket over the limit is split on its next bit.  The shard of a row is the
shortest prefix whose bucket fits.  Totals per prefix are found for a run of
levels at once from one aggregate, so a split costs no pass over the rows, and
the directory stays a DataFrame: nothing but one total reaches the driver.

Defined cases: a null text has 0 bytes and a null id takes part as such; an empty
table gives no rows; a row larger than the limit gets a shard of its own; rows
repeated exactly share every key bit, so a bucket of them is paged instead
(``page`` 0, 1, ...), each page within the limit; further columns are kept by
:func:`with_shards`, and replaced where they are called like one that is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small

KEY_BITS = 60
#: Bytes of text in a shard.  Small, as the given tables are; use 256 MiB and more at 100 TB.
SHARD_BYTES = 1 << 20


def hash_key(doc_id: Column, text: Column) -> Column:
    """Leading 60 bits of MD5(id, unit separator, text) as a long."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column) -> Column:
    """The leading ``bits`` of the key."""
    return F.call_function("shiftright", F.col("_key"), F.lit(KEY_BITS) - bits)


def split_levels(rows: DataFrame, depth: int, levels: int, limit: int) -> DataFrame:
    """Leaves found between ``depth`` and ``depth + levels``: for each prefix of the
    finest level, the shortest prefix whose bucket fits (or cannot be split).

    Totals only fall along a path of the directory, so the shortest fitting prefix
    is the bucket where splitting stops.
    """
    finest = depth + levels
    fine = rows.groupBy(_prefix(F.lit(finest)).alias("_fine")).agg(
        F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"))
    paths = fine.withColumn("lev", F.explode(F.sequence(F.lit(depth), F.lit(finest)))) \
        .withColumn("p", F.call_function("shiftright", F.col("_fine"), F.lit(finest) - F.col("lev")))
    buckets = paths.groupBy("lev", "p").agg(
        F.sum("b").alias("b"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fits = buckets.where((F.col("b") <= limit) | (F.col("lo") == F.col("hi")))
    return paths.select("_fine", "lev", "p").join(fits, ["lev", "p"]).groupBy("_fine").agg(
        F.min(F.struct("lev", "p", "b", "n", (F.col("lo") == F.col("hi")).alias("one"))).alias("leaf"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rank among the rows of one key by (partition, place in it): a window over each
    partition's own share plus offsets per partition, so a key that holds a third of
    all rows is never gathered."""
    pid = F.call_function("shiftright", F.col("_rid"), F.lit(33))
    own = rows.withColumn("_pid", pid)
    counts = own.groupBy("_key", "_pid").agg(F.count("*").alias("c"))
    before = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", "_pid", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_key", "_pid").orderBy("_rid")) - 1
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    return own.withColumn("_rank", rank).join(offsets, ["_key", "_pid"]) \
        .withColumn("page", F.floor((F.col("_rank") + F.col("_before")) / per_page).cast("long"))


#: Columns that the result adds or that are needed on the way; such columns of the input are replaced.
ADDED = ["n_bytes", "shard", "page", "shard_depth", "shard_bytes", "shard_docs"]
_OWN = ["_key", "_rid", "_fine", "_pid", "_rank", "_before", "leaf"]


def with_shards(docs: DataFrame, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, shard (its prefix as 0s and 1s; the single bucket of an
    unsplit directory is the empty string), page, shard_depth, shard_bytes and
    shard_docs (both of the bucket).  Rows meet the directory, never each other: no
    text is shuffled while the directory is small enough to broadcast."""
    kept = [c for c in docs.columns if c not in ADDED + _OWN]
    return _assign(docs, limit, doc_id, text, kept)


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Like :func:`with_shards`, but of the columns of ``docs`` only the id is kept."""
    return _assign(docs, limit, doc_id, text, [doc_id])


def _assign(docs: DataFrame, limit: int, doc_id: str, text: str, kept: list[str]) -> DataFrame:
    rows = cut(docs.select(
        *kept, hash_key(F.col(doc_id), F.col(text)).alias("_key"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("_rid")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    levels = min(KEY_BITS, max(1, math.ceil(math.log2(max(1.0, total / limit))) + 4))
    done, todo, depth = [], rows, 0
    while True:
        finest = depth + levels
        leaves, _ = small(cut(split_levels(todo.select("_key", "n_bytes"), depth, levels, limit), "shard-directory"), F.lit(64))
        keyed = todo.withColumn("_fine", _prefix(F.lit(finest)))
        done.append(keyed.join(leaves, "_fine"))
        rest = keyed.join(leaves, "_fine", "left_anti")
        if finest >= KEY_BITS or rest.isEmpty():
            break
        todo, depth = cut(rest.select(rows.columns), "shard-rest"), finest
        levels = min(levels, KEY_BITS - depth)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    full = F.col("leaf.one") & (F.col("leaf.n") > 1) & (F.col("leaf.b") > limit)
    paged = _pages(found.where(full).select("_key", "_rid", "n_bytes"), limit).select("_rid", F.col("page").alias("_page"))
    every = found.where(~full).withColumn("page", F.lit(0).cast("long")).unionByName(
        found.where(full).join(paged, "_rid").withColumnRenamed("_page", "page"))
    bits = F.substring(F.lpad(F.conv(F.col("leaf.p").cast("string"), 10, 2), KEY_BITS, "0"),
                       F.lit(KEY_BITS + 1) - F.col("leaf.lev"), F.col("leaf.lev"))
    return every.select(
        *kept, "n_bytes", bits.alias("shard"), "page", F.col("leaf.lev").alias("shard_depth"),
        F.col("leaf.b").alias("shard_bytes"), F.col("leaf.n").alias("shard_docs"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text") -> None:
    """Parquet, one folder per shard and page."""
    name = F.concat(F.lit("s"), F.col("shard"), F.lit("."), F.col("page").cast("string"))
    with_shards(docs, limit, doc_id, text).withColumn("folder", name).drop(*ADDED) \
        .repartition("folder").write.partitionBy("folder").parquet(path)
