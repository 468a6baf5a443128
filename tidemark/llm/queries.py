"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, fim, jaccard, langid, mixing, neardup, ordinal, ranked, sharding, suffixdedup, topk, warc
from tidemark.llm.common import held_out, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a benchmark window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(docs, table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade and whether it is selected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, thresholds = ordinal.fit(docs, ordinal.grades(table(spark, sf_dir, "labels")))
    return ordinal.score(docs, weights, thresholds).drop("place")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in budgeted windows, read back; with one that quotes control strings."""
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.windows(turns))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y): the language, as domain, of the documents that the labelled table holds."""
    return docs.select("doc_id", F.col("lang").alias("y")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rate, so that the languages' expected tokens match their targets."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "text"), labelled_domains(docs, table(spark, sf_dir, "labels")), keep_text=False)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links of cosine 0.9 and more, and the component they make."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and the component of its near copies."""
    return jaccard.similarity_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of at most SHARD_BYTES bytes of text."""
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's WARC record, and what an audit of a damaged second replica says of it."""
    held, offsets = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")
    flipped = F.overlay("record", F.lit(b"\x01"), F.col("length").cast("int") - 4)
    copy = held.where(draw % 97 != 1).withColumn("record", F.when(draw % 89 == 0, flipped).otherwise(F.col("record")))
    ours = warc.leaves(held, offsets)
    found = warc.audit(ours, warc.leaves(copy, offsets))
    return ours.join(found, ["file", "offset"], "left").select(
        "page_id", F.col("length").alias("n_bytes"), F.col("hash").alias("record_sha256"), F.coalesce("status", F.lit("intact")).alias("status"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 200-byte strings that start elsewhere too."""
    return suffixdedup.dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    train = docs.where(~held_out(F.col("doc_id"))).select("text", "lang")
    return langid.identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), train)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved, and the digest of the text rebuilt from that."""
    moved = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return fim.restore(moved, texts=False)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every 50th vector with all others."""
    return topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest-scoring documents of every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_chat": op3_chat,
    "op4_mixing": op4_mixing,
    "op5_embeddings": op5_embeddings,
    "op6_jaccard": op6_jaccard,
    "op7_shards": op7_shards,
    "op8_fixity": op8_fixity,
    "op9_substrings": op9_substrings,
    "op10_language": op10_language,
    "op11_fim": op11_fim,
    "op12_topk": op12_topk,
    "op13_ranked": op13_ranked,
}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT item_id, least(13, len(w)) AS n, array_to_string(w[s + 1:s + least(13, len(w))], ' ') AS g
  FROM i, unnest(range(0, greatest(0, len(w) - 13) + 1)) AS t(s) WHERE len(w) > 0),
grams AS (
  SELECT rid, n, p, array_to_string(w[p + 1:p + n], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM wins), unnest(range(0, len(w) - n + 1)) AS t(p) WHERE len(w) >= n),
hits AS (SELECT DISTINCT rid, item_id, p, n FROM grams JOIN wins USING (n, g)),
per AS (
  SELECT rid, count(DISTINCT q) AS n_hit, list_sort(list(DISTINCT item_id)) AS ids
  FROM hits, unnest(range(p, p + n)) AS t(q) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per USING (rid)""",
    "op6_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS g
  FROM d, unnest(range(0, greatest(0, len(w) - 5) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op7_shards": f"""
WITH keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS k
  FROM documents),
levels AS (
  SELECT lev, k >> (60 - lev) AS p, sum(n_bytes)::BIGINT AS b, count(*) AS n, min(k) AS lo, max(k) AS hi
  FROM keyed, generate_series(0, 60) AS g(lev) GROUP BY ALL),
leaves AS (
  SELECT keyed.*, lev, p, b, n, lo = hi AS one FROM keyed JOIN levels ON p = (k >> (60 - lev))
  WHERE b <= {sharding.SHARD_BYTES} OR lo = hi
  QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY lev) = 1)
SELECT doc_id, n_bytes, substr(lpad(bin(k), 60, '0'), 1, lev) AS shard,
       CASE WHEN one AND n > 1 AND b > {sharding.SHARD_BYTES}
            THEN (row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1)
                 // greatest(1, {sharding.SHARD_BYTES} // greatest(n_bytes, 1)) ELSE 0 END AS page,
       lev::INTEGER AS shard_depth, b AS shard_bytes, n AS shard_docs
FROM leaves""",
    "op8_fixity": r"""
WITH r AS (
  SELECT page_id, ('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8))::BIGINT AS draw,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
         || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages)
SELECT page_id, strlen(record) AS n_bytes, sha256(record) AS record_sha256,
       CASE WHEN draw % 97 = 1 THEN 'missing' WHEN draw % 89 = 0 THEN 'corrupt' ELSE 'intact' END AS status FROM r""",
    "op11_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
c AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 AS plain,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 AS spm,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2 FROM d),
p AS (
  SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS a,
         coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS b,
         coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS z FROM c)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(a) END AS prefix_chars, CASE WHEN NOT plain THEN length(b) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || z || '<P>' || a || '<M>' || b ELSE '<P>' || a || '<S>' || z || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
    "op12_topk": r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid AS qid, q.vec_id AS query_id, o.rid, o.vec_id, list_dot_product(q.e, o.e)::BIGINT AS score
  FROM v AS q JOIN v AS o ON q.rid <> o.rid WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id, rid))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op13_ranked": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT item, item_id, t, count(*) AS q FROM (SELECT item, item_id, unnest(w) AS t FROM i) GROUP BY ALL),
c AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS wt FROM (SELECT t, count(*) AS df FROM p GROUP BY t), c),
m AS (SELECT rid, doc_id, 100 - 25 + (25 * len(w)::BIGINT * nn) // l AS m FROM d, c),
s AS (
  SELECT item, item_id, rid, doc_id, sum(q * wt * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN p USING (t) JOIN f USING (t) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20""",
    "op10_language": r"""
WITH crc AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, text, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda p, q: CASE WHEN p % 2 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END)), 4294967295) AS crc FROM documents),
d AS (
  SELECT rid, doc_id, lang, coalesce(crc % 5 = 0, true) AS held_out, chr(1114111) || array_to_string(regexp_extract_all(lower(text), '\p{L}+'), chr(1114111)) || chr(1114111) AS s
  FROM crc),
c AS (SELECT rid, unnest(string_split(s, '')) AS c, generate_subscripts(string_split(s, ''), 1) AS pos FROM d WHERE length(s) > 2),
n AS (SELECT rid, c, c || lead(c) OVER w AS cc, c || lead(c) OVER w || lead(c, 2) OVER w AS ccc FROM c WINDOW w AS (PARTITION BY rid ORDER BY pos)),
g AS (
  SELECT rid, g, length(g) AS k, count(*) AS n
  FROM (SELECT rid, c AS g FROM n WHERE c <> chr(1114111) UNION ALL SELECT rid, cc FROM n UNION ALL SELECT rid, ccc FROM n) WHERE g IS NOT NULL GROUP BY ALL),
prof AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, k, g) - 1 AS place
  FROM (SELECT lang, g, k, sum(n) AS n FROM g JOIN d USING (rid) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL) QUALIFY place < 300),
asked AS (SELECT rid, g, row_number() OVER (PARTITION BY rid ORDER BY n DESC, k, g) - 1 AS place FROM g QUALIFY place < 300),
far AS (
  SELECT rid, l.lang, sum(CASE WHEN prof.place IS NULL THEN 300 ELSE abs(prof.place - asked.place) END) AS far, count(*) AS n
  FROM asked CROSS JOIN (SELECT DISTINCT lang FROM prof) AS l LEFT JOIN prof ON prof.lang = l.lang AND prof.g = asked.g GROUP BY ALL),
best AS (SELECT rid, lang, 1.0::DOUBLE - far::DOUBLE / (300 * n) AS score FROM far QUALIFY row_number() OVER (PARTITION BY rid ORDER BY far, lang) = 1)
SELECT doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred, coalesce(score, 0.0::DOUBLE) AS score FROM d LEFT JOIN best USING (rid)""",
}
