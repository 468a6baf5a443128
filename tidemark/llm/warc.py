"""Merkle fixity audit of WARC replicas.

Records are hashed, and ordered ranges of offsets are hashed into a tree for each file:
a leaf covers the records that start in one range of RANGE_BYTES, a node FANOUT
neighbouring ranges.  Two replicas with one root are equal.  Where roots differ, only the
children of differing nodes are compared, level by level, down to the ranges and then
the records that are corrupt, missing or added.  Work of an audit thus follows
the damage; trees are built once per replica, a level at a time, and stored.

Everything is DataFrame and SQL expressions; a group holds the records of one range or
the children of one node, both bounded.

Defined cases: null texts and urls are empty, a null id is written as an empty one;
repeated rows are records of their own; an empty table is an archive without files,
and a file that only one replica has is reported record by record; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

RANGE_BYTES, FANOUT = 1 << 16, 16


def record_bytes(record_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record."""
    body = F.coalesce(payload.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n")).cast("binary")


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Records in files, both tables stored in the shared folder: (rid, file, length,
    page_id, record) and (rid, offset); rid names a record and orders its file.

    Each task's rows are one file, so a file is bounded by the size of a scan split
    and its offsets are a running sum within it, whatever keys the rows have.  Only
    lengths are shuffled for that, never records.
    """
    rows = cut(pages.select(F.monotonically_increasing_id().alias("rid"), F.col(page_id).alias("page_id"),
                            record_bytes(F.col(page_id), F.col(url), F.col(html)).alias("record")), "warc-records")
    records = rows.select("rid", F.call_function("shiftright", F.col("rid"), F.lit(33)).alias("file"),
                          F.octet_length("record").cast("long").alias("length"), "page_id", "record")
    before = Window.partitionBy("file").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = records.select("rid", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
    return records, cut(offsets, "warc-offsets")


def leaves(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """(file, offset, length, hash, page_id) of a replica's records, stored."""
    hashed = records.select("rid", "file", "length", "page_id", F.sha2("record", 256).alias("hash"))
    return cut(hashed.join(offsets, "rid").select("file", "offset", "length", "hash", "page_id"), "warc-hashes")


def tree(hashed: DataFrame, levels: int, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of a replica's trees, lowest first: (file, node, hash)."""
    told = F.struct("offset", F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "hash").alias("x"))
    joined = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(told)), lambda s: s["x"]))
    out = [cut(hashed.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("node")).agg(F.sha2(joined, 256).alias("hash")), "merkle-0")]
    told = F.struct("node", F.concat_ws(":", F.col("node").cast("string"), "hash").alias("x"))
    joined = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(told)), lambda s: s["x"]))
    for k in range(1, levels):
        up = out[-1].groupBy("file", F.floor(F.col("node") / fanout).alias("up")).agg(F.sha2(joined, 256).alias("hash"))
        out.append(cut(up.withColumnRenamed("up", "node"), f"merkle-{k}"))
    return out


def levels_for(*replicas: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> int:
    """Levels up to a single root for the longest file."""
    top = max(((r.agg(F.max("offset")).first()[0] or 0) // range_bytes for r in replicas), default=0)
    levels = 1
    while top:
        top //= fanout
        levels += 1
    return levels


def audit(ours: DataFrame, theirs: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Where two replicas' records (file, offset, length, hash) differ: (file, offset,
    status), status being corrupt, missing (from theirs) or added."""
    levels = levels_for(ours, theirs, range_bytes=range_bytes, fanout=fanout)
    mine, other = tree(ours, levels, range_bytes, fanout), tree(theirs, levels, range_bytes, fanout)
    differ = None
    for k in range(levels - 1, -1, -1):
        a, b = mine[k], other[k]
        if differ is not None:
            up = F.floor(F.col("node") / fanout)
            a, b = (x.withColumn("up", up).join(differ, ["file", "up"], "left_semi").drop("up") for x in (a, b))
        unlike = a.alias("a").join(b.alias("b"), ["file", "node"], "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
        differ = cut(unlike.select("file", F.col("node").alias("up")), "merkle-differ")
    at = F.floor(F.col("offset") / range_bytes)
    a, b = (x.withColumn("up", at).join(differ, ["file", "up"], "left_semi") for x in (ours, theirs))
    return a.alias("a").join(b.alias("b"), ["file", "offset"], "full") \
        .where(~(F.col("a.hash").eqNullSafe(F.col("b.hash")) & F.col("a.length").eqNullSafe(F.col("b.length")))) \
        .select("file", "offset", F.when(F.col("b.hash").isNull(), "missing").when(F.col("a.hash").isNull(), "added").otherwise("corrupt").alias("status"))
