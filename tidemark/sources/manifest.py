"""Release manifests: which files make up a release, their size and SHA-256,
and whether they have been extracted (G15, G16, K10, X23).

A manifest is one record with two nested file records (basic and detailed).
Digests are computed by Spark from ``binaryFile`` (one task per file); the
manifest itself is tiny and lives as JSON next to the release.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_STRUCT = (
    "STRUCT<filename: STRING, url: STRING, size_bytes: BIGINT, sha256: STRING, release_year: INT, "
    "release_month: INT, raw_split_filename: STRING, raw_split_size_bytes: BIGINT, raw_split_sha256: STRING>"
)
MANIFEST_SCHEMA = (
    "release_label STRING, release_year INT, release_month INT, publication_page_url STRING, "
    f"downloaded_at_utc STRING, status STRING, basic {FILE_STRUCT}, detailed {FILE_STRUCT}"
)


def file_digests(spark: SparkSession, path: str, glob: str = "*", folder_key: str | None = None) -> DataFrame:
    """(path, filename, size_bytes, sha256) for every matching file.  The file's name is the last part of its
    path, or with ``folder_key`` the value of that key among its folders (a release that Spark itself has landed)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1) if folder_key is None else F.regexp_extract("path", f"/{folder_key}=([^/]+)/", 1)
    return files.select(
        "path",
        name.alias("filename"),
        F.col("length").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def build_manifest(
    spark: SparkSession,
    digests: DataFrame,
    release_year: int,
    release_month: int,
    page_url: str,
    basic_name: str,
    basic_url: str,
    detailed_name: str,
    detailed_url: str,
    downloaded_at_utc: str,
) -> DataFrame:
    """The manifest record for a downloaded release, status 'downloaded'."""
    from tidemark.functions.scalars import month_label

    # one pass over the digests picks both files' size and hash
    picked = digests.agg(
        F.max(F.when(F.col("filename") == basic_name, F.struct("size_bytes", "sha256"))).alias("b"),
        F.max(F.when(F.col("filename") == detailed_name, F.struct("size_bytes", "sha256"))).alias("d"),
    )

    def part(name: str, url: str, col: str):
        return F.struct(
            F.lit(name).alias("filename"),
            F.lit(url).alias("url"),
            F.col(f"{col}.size_bytes").alias("size_bytes"),
            F.col(f"{col}.sha256").alias("sha256"),
            F.lit(release_year).alias("release_year"),
            F.lit(release_month).alias("release_month"),
            F.lit(None).cast("string").alias("raw_split_filename"),
            F.lit(None).cast("long").alias("raw_split_size_bytes"),
            F.lit(None).cast("string").alias("raw_split_sha256"),
        )

    record = picked.select(
        month_label(F.lit(release_year), F.lit(release_month)).alias("release_label"),
        F.lit(release_year).alias("release_year"),
        F.lit(release_month).alias("release_month"),
        F.lit(page_url).alias("publication_page_url"),
        F.lit(downloaded_at_utc).alias("downloaded_at_utc"),
        F.lit("downloaded").alias("status"),
        part(basic_name, basic_url, "b").alias("basic"),
        part(detailed_name, detailed_url, "d").alias("detailed"),
    )
    return _freeze(spark, record)


def build_manifests(digests: DataFrame, releases: DataFrame) -> DataFrame:
    """G16 for many releases at once: ``releases`` (release_year, release_month, publication_page_url,
    downloaded_at_utc, basic_name, basic_url, detailed_name, detailed_url) with each file's size and hash from
    ``digests`` (NULL for a file that is not there), status 'downloaded'."""
    from tidemark.functions.scalars import month_label

    out = releases
    for kind in ("basic", "detailed"):
        d = digests.select(F.col("filename").alias(f"__{kind}"), F.col("size_bytes").alias(f"__{kind}_size"), F.col("sha256").alias(f"__{kind}_sha"))
        out = out.join(d, F.col(f"{kind}_name") == F.col(f"__{kind}"), "left")

    def part(kind: str):
        return F.struct(
            F.col(f"{kind}_name").alias("filename"), F.col(f"{kind}_url").alias("url"), F.col(f"__{kind}_size").alias("size_bytes"),
            F.col(f"__{kind}_sha").alias("sha256"), "release_year", "release_month", F.lit(None).cast("string").alias("raw_split_filename"),
            F.lit(None).cast("long").alias("raw_split_size_bytes"), F.lit(None).cast("string").alias("raw_split_sha256"))

    return out.select(month_label(F.col("release_year"), F.col("release_month")).alias("release_label"), "release_year", "release_month",
                      "publication_page_url", "downloaded_at_utc", F.lit("downloaded").alias("status"),
                      part("basic").alias("basic"), part("detailed").alias("detailed"))


def _freeze(spark: SparkSession, record: DataFrame) -> DataFrame:
    """A manifest states what the files were when it was built: its single row
    is fixed now instead of being re-derived from the files at read time."""
    return spark.createDataFrame(record.collect(), MANIFEST_SCHEMA)


def mark_extracted(manifest: DataFrame, basic_split: DataFrame, detailed_split: DataFrame) -> DataFrame:
    """Record the extracted (raw split) files and move the status to
    'extracted'.  ``*_split`` are digest frames of the split files; each is
    reduced to one struct by an aggregate used as a scalar subquery (Spark
    evaluates a repeated identical subquery once)."""
    def one(split: DataFrame):
        return split.agg(F.max(F.struct("filename", "size_bytes", "sha256"))).scalar()

    def with_split(col: str, s):
        return F.col(col).withField("raw_split_filename", s.getField("filename")).withField(
            "raw_split_size_bytes", s.getField("size_bytes")
        ).withField("raw_split_sha256", s.getField("sha256"))

    out = manifest.withColumn("basic", with_split("basic", one(basic_split))).withColumn(
        "detailed", with_split("detailed", one(detailed_split))
    ).withColumn("status", F.lit("extracted"))
    return _freeze(manifest.sparkSession, out)


def validate_against_manifest(manifest: DataFrame, digests: DataFrame, require_extracted: bool = False) -> DataFrame:
    """One row per manifest file (basic, detailed) with the problems found:
    missing file, size mismatch, hash mismatch, period mismatch, not extracted,
    stale extract.  ``ok`` is true when the list is empty."""
    parts = manifest.select(
        F.explode(F.array(
            F.struct(F.lit("basic").alias("kind"), F.col("basic").alias("f"), "release_year", "release_month", "status"),
            F.struct(F.lit("detailed").alias("kind"), F.col("detailed").alias("f"), "release_year", "release_month",
                     "status"),
        )).alias("p")
    ).select("p.kind", "p.f.*", F.col("p.release_year").alias("m_year"), F.col("p.release_month").alias("m_month"),
             F.col("p.status").alias("status"))
    d = digests.select(F.col("filename").alias("d_name"), F.col("size_bytes").alias("d_size"),
                       F.col("sha256").alias("d_sha"))
    j = parts.join(d, F.col("filename") == F.col("d_name"), "left")
    s = digests.select(F.col("filename").alias("s_name"), F.col("sha256").alias("s_sha"))
    j = j.join(s, F.col("raw_split_filename") == F.col("s_name"), "left")
    problems = F.array_compact(F.array(
        F.when(F.col("d_name").isNull(), F.lit("missing_file")),
        F.when(F.col("d_name").isNotNull() & (F.col("d_size") != F.col("size_bytes")), F.lit("size_mismatch")),
        F.when(F.col("d_name").isNotNull() & (F.col("d_sha") != F.col("sha256")), F.lit("hash_mismatch")),
        F.when((F.col("release_year") != F.col("m_year")) | (F.col("release_month") != F.col("m_month")),
               F.lit("period_mismatch")),
        F.when(F.lit(require_extracted) & (F.col("status") != "extracted"), F.lit("not_extracted")),
        F.when(F.lit(require_extracted) & (F.col("status") == "extracted")
               & (F.col("s_sha").isNull() | (F.col("s_sha") != F.col("raw_split_sha256"))), F.lit("stale_extract")),
    ))
    return j.select("kind", "filename", problems.alias("problems"), (F.size(problems) == 0).alias("ok"))


def validate_names(manifest: DataFrame, digests: DataFrame) -> DataFrame:
    """G15, the other way round: files that are there and that no manifest names, as (filename, problems)."""
    named = manifest.select(F.explode(F.array("basic.filename", "detailed.filename", "basic.raw_split_filename", "detailed.raw_split_filename")).alias("filename"))
    return digests.join(named.where(F.col("filename").isNotNull()).distinct(), "filename", "left_anti").select("filename", F.array(F.lit("not_in_manifest")).alias("problems"))
