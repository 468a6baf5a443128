"""Publishing: keyed upsert, validated atomic replace, appends and exports.

Tables are folders of immutable versions under a root on the cluster's shared
file system, and a commit log says which of them are live::

    {root}/{table}/v=000001/part-*.parquet
    {root}/_COMMITS/000000000007      <- JSON: {"enrol": ["v=000003"], "fx": ["v=000001", "v=000002"]}

A table may be kept by a column of its key (the year of a fact): each value has a folder
of its own, ``tm_v=000002/tm_part=1999``, and an upsert reads and writes the folders of the
values in its batch only; all others stay live as they are, file by file.

A write never touches a folder that a reader may see: it lands in a new version
folder, is validated and recounted, and only then is the next commit written,
under a temporary name and renamed to a name that did not exist before.  Readers
take the highest commit, and one commit holds every table's live folders, so a table or
a whole release switches with one rename and there is no moment without a published
state.  A failed or short load leaves the state before it.

File-system access goes through Hadoop's ``FileSystem`` on the JVM, so the same
code works on HDFS, object stores and local disk.  The rename is atomic and refuses a name
that exists on HDFS; on an object store it is a copy, so there only one writer a root at a time
is safe.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "_COMMITS"
#: Folder keys of a table kept by a column's values.
PART_VERSION, PART = "tm_v", "tm_part"
#: Older commits are removed, but for this many.
KEPT_COMMITS = 20
#: Columns that say where and when a row was loaded; a change in them alone is no change.
LINEAGE = ("_etl_source", "_etl_loaded_at", "_etl_file")


# ---------------------------------------------------------------------------
# File-system helpers (Hadoop FileSystem through the JVM gateway)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def _write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write to a temporary name, then rename to ``path``, which must not exist."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}: it exists already")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


# ---------------------------------------------------------------------------
# Versioned tables


def table_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete commits, ascending."""
    fs, p, _ = _fs(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(p):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())


def live_tables(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Every published table's live version folders: the newest commit."""
    done = _commits(spark, root)
    return json.loads(_read_text(spark, f"{root.rstrip('/')}/{COMMITS}/{done[-1]:012d}") or "{}") if done else {}


def commit(spark: SparkSession, root: str, changes: Mapping[str, Sequence[str]]) -> None:
    """Make ``changes`` (table to version folders) live, all with one rename."""
    done = _commits(spark, root)
    state = {**live_tables(spark, root), **{t: list(v) for t, v in changes.items()}}
    folder = f"{root.rstrip('/')}/{COMMITS}"
    _write_new(spark, f"{folder}/{(done[-1] if done else 0) + 1:012d}", json.dumps(state, sort_keys=True))
    for old in done[:-KEPT_COMMITS]:
        _delete(spark, f"{folder}/{old:012d}")


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest live version folder of a table."""
    live = live_tables(spark, root).get(table)
    return live[-1] if live else None


def _next_version(spark: SparkSession, root: str, table: str, prefix: str = "v=") -> str:
    """A folder name after every one there is, published or left over."""
    fs, p, _ = _fs(spark, table_dir(root, table))
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    done = [int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit()]
    return f"{prefix}{max(done, default=0) + 1:06d}"


def tables_at(spark: SparkSession, root: str, number: int) -> dict[str, list[str]]:
    """Every table's live folders as of commit ``number`` (0: nothing is published)."""
    return json.loads(_read_text(spark, f"{root.rstrip('/')}/{COMMITS}/{number:012d}") or "{}") if number else {}


def last_commit(spark: SparkSession, root: str) -> int:
    return max(_commits(spark, root), default=0)


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType | str | None = None, commit_number: int | None = None) -> DataFrame | None:
    """The published rows of a table (``None`` when nothing is published), now or as of a
    commit whose folders are still there."""
    state = live_tables(spark, root) if commit_number is None else tables_at(spark, root, commit_number)
    return _read_folders(spark, root, table, state.get(table) or [], schema)


def _read_folders(spark: SparkSession, root: str, table: str, live: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame | None:
    if not live:
        return None
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [f"{table_dir(root, table)}/{v}" for v in live]
    if "/" in live[0]:
        # the columns are in the files; those that Spark reads off the folders are not the table's,
        # and a column that a later batch brought is in the folders written since
        return reader.option("basePath", table_dir(root, table)).option("mergeSchema", True).parquet(*paths).drop(PART_VERSION, PART)
    return reader.parquet(*paths)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN in every floating column becomes NULL before a write."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not fl:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in fl})


@dataclass
class LoadResult:
    table: str
    version: str | None
    rows_written: int
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    published: bool = False
    dry_run: bool = False


class LoadError(RuntimeError):
    pass


def _write_version(
    df: DataFrame, path: str, max_records: int | None = None, partition_by: Sequence[str] | None = None
) -> int:
    """Write ``df`` once and return the number of rows written (observed during
    the write, no second pass).  ``partition_by`` lays the version out in
    folders per value (e.g. the year of a YTD fact), so a reader filtering on
    it prunes whole folders."""
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    w = observed.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)
    return int(obs.get["n"])


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    table: str,
    key_columns: Sequence[str] | None = None,
    dry_run: bool = False,
    expected_rows: int | None = None,
    blanks: Mapping[str, str] | None = None,
    partition_by: Sequence[str] | None = None,
    staged: dict[str, list[str]] | None = None,
) -> LoadResult:
    """K04 (+ G03, G12): validated atomic full replace.

    1. reject duplicate keys before writing anything (NULL key parts compare
       equal through their blank value);
    2. write the frame to a new version folder, counting rows as they pass;
    3. recount the written version from its files and compare with the rows
       written (and ``expected_rows`` when given);
    4. only then commit it.  Any failure leaves the old version live.  With ``staged`` the folders
       are entered there instead, for a commit of several tables.
    """
    from tidemark.operators.quality import duplicate_key_groups

    if key_columns:
        dups = duplicate_key_groups(df, key_columns, blanks).limit(5).collect()  # at most 5 sample rows
        if dups:
            raise LoadError(f"{table}: duplicate keys on {list(key_columns)}, e.g. {[r.asDict() for r in dups]}")
    if dry_run:
        return LoadResult(table, None, df.count(), dry_run=True)
    ver = _next_version(spark, root, table)
    path = f"{table_dir(root, table)}/{ver}"
    written = _write_version(nan_to_null_all(df), path, partition_by=partition_by)
    recount = spark.read.parquet(path).count()
    if recount != written or (expected_rows is not None and recount != expected_rows):
        _delete(spark, path)
        raise LoadError(f"{table}: wrote {written}, found {recount}, expected {expected_rows}; old version kept")
    _publish(spark, root, table, [ver], staged)
    return LoadResult(table, ver, written, inserted=written, published=staged is None)


def _publish(spark: SparkSession, root: str, table: str, folders: list[str], staged: dict[str, list[str]] | None) -> None:
    if staged is None:
        commit(spark, root, {table: folders})
    else:
        staged[table] = folders


def upsert(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    table: str,
    key_columns: Sequence[str],
    mode: str = "update",
    order_col: str | None = None,
    dry_run: bool = False,
    blanks: Mapping[str, str] | None = None,
    lineage: Sequence[str] = LINEAGE,
    by: str | None = None,
    staged: dict[str, list[str]] | None = None,
) -> LoadResult:
    """K01/K02 (K06 dry run, Q10 idempotent rerun, U06 dedupe only on the
    declared key): keyed upsert into the published table, producing a new version.

    ``mode="update"``: for a key present in ``df`` every column ``df`` carries
    takes the new value (even NULL); columns ``df`` lacks keep the old value.
    ``mode="replace_row"``: the new row replaces the old one whole; columns
    ``df`` lacks become NULL.  Within ``df`` a repeated key keeps the row with
    the highest ``order_col`` (last wins); without ``order_col`` a repeated key
    is an error.  NULL key parts equal each other, and the blank value that
    ``blanks`` gives for their column.  Counts of inserted, updated and unchanged keys
    are returned; a row that differs in ``lineage`` columns only is unchanged and stays
    as it was, so a rerun of the same batch changes nothing.

    With ``by``, one of the key columns, the table is kept by its values: only the folders of values
    that the batch holds are read, merged and written, so a batch that touches few
    periods of a large fact costs what these periods cost.

    Plan: one full outer join of old and new on the key (shuffled on the key)
    and one write, which also counts.
    """
    from tidemark.operators.quality import duplicate_key_groups
    from tidemark.operators.windows import last_wins

    if mode not in ("update", "replace_row"):
        raise ValueError("mode must be 'update' or 'replace_row'")
    if by is not None and by not in key_columns:
        raise ValueError(f"{table}: '{by}' must be a key column, or a row could move between folders")
    keys = list(key_columns)
    same = {k: F.coalesce(F.col(k).cast("string"), F.lit(blanks[k])) if k in (blanks or {}) else F.col(k) for k in keys}
    parts = [f"__k{i}" for i in range(len(keys))]
    new = nan_to_null_all(df)
    if order_col is not None:
        new = last_wins(new.select("*", *[same[k].alias(p) for k, p in zip(keys, parts, strict=True)]), parts, order_col) \
            .drop(order_col, *parts)
    elif duplicate_key_groups(new, keys, blanks).limit(1).count():
        raise LoadError(f"{table}: repeated keys in the batch and no order column")
    if by is None:
        old = read_table(spark, root, table)
        if old is not None and "/" in live_tables(spark, root)[table][0]:
            raise LoadError(f"{table} is kept by a column's values; name it in 'by'")
    else:
        part_of = _part_text(same[by])
        live = live_tables(spark, root).get(table, [])
        if live and "/" not in live[0]:
            raise LoadError(f"{table} is not kept by a column's values")
        touched = {r[0] for r in new.select(part_of.alias("p")).distinct().collect()}  # the batch's periods
        old = _read_folders(spark, root, table, [f for f in live if f.rsplit("=", 1)[1] in touched])
    if dry_run:
        return LoadResult(table, None, new.count(), dry_run=True)
    if old is None:
        return replace_table(spark, new, root, table, keys, blanks=blanks, staged=staged) if by is None else \
            _write_parts(spark, new, part_of, touched, root, table, staged)
    value_cols = [c for c in old.columns if c not in keys]
    extra = [c for c in new.columns if c not in old.columns and c not in keys]
    key_parts = [same[k].alias(p) for k, p in zip(keys, parts, strict=True)]
    o = old.select(*key_parts, *[F.col(c).alias(f"__o_{c}") for c in old.columns], F.lit(True).alias("__in_old")).alias("o")
    n = new.select(*key_parts, *[F.col(c).alias(f"__n_{c}") for c in new.columns], F.lit(True).alias("__in_new")).alias("n")
    j = o.join(n, [F.col(f"o.{p}").eqNullSafe(F.col(f"n.{p}")) for p in parts], "full")
    in_new = F.coalesce(F.col("__in_new"), F.lit(False))
    in_old = F.coalesce(F.col("__in_old"), F.lit(False))
    values = {}
    changed = F.lit(False)
    for c in value_cols + extra:
        has_new = c in new.columns
        old_c = F.col(f"__o_{c}") if c in value_cols else F.lit(None)
        if mode == "replace_row":
            val = F.when(in_new, F.col(f"__n_{c}") if has_new else F.lit(None)).otherwise(old_c)
        else:
            val = F.when(in_new, F.col(f"__n_{c}")).otherwise(old_c) if has_new else old_c
        values[c] = val
        if c not in lineage:
            changed = changed | ~val.eqNullSafe(old_c)
    same_row = in_new & in_old & ~changed
    out_cols = [F.when(same_row, F.col(f"__o_{c}")).otherwise(v).alias(c) if c in lineage and c in value_cols else v.alias(c)
                for c, v in values.items()]
    out_keys = [F.when(in_old, F.col(f"__o_{k}")).otherwise(F.col(f"__n_{k}")).alias(k) for k in keys]
    counts = Observation("upsert")
    merged = j.observe(
        counts,
        F.count_if(in_new & ~in_old).alias("ins"),
        F.count_if(in_new & in_old & changed).alias("upd"),
        F.count_if(same_row).alias("same"),
    ).select(*out_keys, *out_cols)
    res = replace_table(spark, merged, root, table, staged=staged) if by is None else _write_parts(spark, merged, part_of, touched, root, table, staged)
    stats = counts.get
    res.inserted, res.updated, res.unchanged = int(stats["ins"]), int(stats["upd"]), int(stats["same"])
    return res


def _part_text(value: Column) -> Column:
    """The name of a value's folder: the value itself where it is made of plain signs, else its hash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("null")).when(text.rlike("^[A-Za-z0-9_-]{1,64}$"), F.concat(F.lit("k"), text)) \
        .otherwise(F.concat(F.lit("h"), F.md5(text.cast("binary"))))


def _write_parts(spark: SparkSession, df: DataFrame, part_of: Column, touched: set[str], root: str, table: str,
                 staged: dict[str, list[str]] | None = None) -> LoadResult:
    """Write the rows by folder, recount them and commit: the folders written take the place of those of the same values."""
    if not touched:
        return LoadResult(table, None, 0, published=True)
    ver = _next_version(spark, root, table, f"{PART_VERSION}=")
    path = f"{table_dir(root, table)}/{ver}"
    # dealt by folder, a large one over several tasks
    written = _write_version(df.withColumn(PART, part_of).hint("rebalance", F.col(PART)), path, partition_by=[PART])
    folders = [f"{ver}/{PART}={p}" for p in sorted(touched)]
    recount = _read_folders(spark, root, table, folders).count()
    if recount != written:
        _delete(spark, path)
        raise LoadError(f"{table}: wrote {written}, found {recount}; old folders kept")
    kept = [f for f in live_tables(spark, root).get(table, []) if f.rsplit("=", 1)[1] not in touched]
    _publish(spark, root, table, sorted([*kept, *folders], key=lambda f: f.rsplit("=", 1)[1]), staged)
    return LoadResult(table, ver, written, inserted=written, published=staged is None)


def upsert_release(
    spark: SparkSession, root: str, frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], order_col: str,
    blanks: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, LoadResult]:
    """K01 + K09: several tables upserted together: each is merged with its published rows into a new
    version, and one commit makes them live.  A failure leaves every table as it was."""
    staged: dict[str, list[str]] = {}
    try:
        out = {table: upsert(spark, df, root, table, keys[table], order_col=order_col, blanks=(blanks or {}).get(table), staged=staged)
               for table, df in frames.items()}
        commit(spark, root, staged)
    except Exception:
        for table, folders in staged.items():
            for folder in folders:
                _delete(spark, f"{table_dir(root, table)}/{folder}")
        raise
    for res in out.values():
        res.published = True
    return out


def append_rows(spark: SparkSession, df: DataFrame, root: str, table: str) -> LoadResult:
    """Bulk append; returns the number of rows appended.

    The new rows are one more version folder, committed beside those that are live, so
    the cost is that of the new rows only and readers never see a part of them.
    """
    live = live_tables(spark, root).get(table, [])
    if live and "/" in live[0]:
        raise LoadError(f"{table} is kept by a column's values; load it with upsert")
    ver = _next_version(spark, root, table)
    n = _write_version(nan_to_null_all(df), f"{table_dir(root, table)}/{ver}")
    commit(spark, root, {table: [*live, ver]})
    return LoadResult(table, ver, n, inserted=n, published=True)


def overwrite_and_count(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Plain overwrite of a path (never the one being read) and count back."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count()


def export_csv(df: DataFrame, path: str, null_value: str = "", max_records: int | None = None) -> None:
    """CSV export with a header, a NULL sentinel and an optional
    row cap per output file (e.g. 1,048,575 rows, one spreadsheet sheet)."""
    w = df.write.mode("overwrite").option("header", True).option("nullValue", null_value)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.csv(path)


def publish_release(spark: SparkSession, root: str, frames: Mapping[str, DataFrame],
                    key_columns: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Several tables published together: each is validated and written as a
    new version; only when all succeed does one commit make them live together.
    A failure leaves every table on its old version (new folders are removed)."""
    staged: dict[str, str] = {}
    try:
        for table, df in frames.items():
            keys = (key_columns or {}).get(table)
            if keys:
                from tidemark.operators.quality import duplicate_key_groups

                if duplicate_key_groups(df, keys).limit(1).count():
                    raise LoadError(f"{table}: duplicate keys")
            ver = _next_version(spark, root, table)
            path = f"{table_dir(root, table)}/{ver}"
            written = _write_version(nan_to_null_all(df), path)
            staged[table] = ver
            if spark.read.parquet(path).count() != written:
                raise LoadError(f"{table}: recount mismatch")
        commit(spark, root, {table: [ver] for table, ver in staged.items()})
    except Exception:
        for table, ver in staged.items():
            _delete(spark, f"{table_dir(root, table)}/{ver}")
        raise
    return staged


def write_manifest(spark: SparkSession, manifest: DataFrame, path: str) -> None:
    """Manifest records as JSON."""
    manifest.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Manifest records read back with a declared schema."""
    return spark.read.schema(schema).json(path)
