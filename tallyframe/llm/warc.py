"""WARC fixity: Merkle trees over two replicas of an archive, compared from the roots down.

A record is the bytes of one page with its WARC header. Records are ordered by page id; 64 ids make a
range and 64 ranges a file. A range's hash covers the offset inside the range, length, digest and
number of copies of each record; a file's hash covers its ranges in order with their lengths, so it
fixes every absolute offset. A damaged record therefore changes its own range and file only. The audit
compares file hashes, then the ranges of differing files, then the records of differing ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, written

RANGE_IDS = 64
FILE_IDS = 64 * 64
NODE = ["file_id", "range_id"]


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """One WARC/1.1 record as text; nulls are empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def record_digests(pages: DataFrame) -> DataFrame:
    """Leaves: ``file_id``, ``range_id``, ``page_id``, ``digest``, ``length``, ``copies``, ``start``.

    Equal records count as copies before the shuffle, so a page that was stored many times is one
    row. ``start`` is the offset inside the range. A null page id has a file of its own.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    leaves = (pages.select("page_id", record.alias("record"))
              .select("page_id", F.sha2("record", 256).alias("digest"), F.octet_length("record").cast("long").alias("length"))
              .groupBy("page_id", "digest", "length").agg(F.count("*").alias("copies")))
    ids = F.col("page_id")
    leaves = leaves.withColumns({"file_id": F.floor(ids / FILE_IDS), "range_id": F.floor(ids / RANGE_IDS)})
    before = Window.partitionBy(*NODE).orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("start", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)))


def range_nodes(leaves: DataFrame) -> DataFrame:
    line = F.concat_ws(":", "start", "length", "copies", "digest")
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "digest", line.alias("line")))), lambda x: x["line"]), "\n")
    nodes = leaves.groupBy(*NODE).agg(lines.alias("lines"), F.sum(F.col("length") * F.col("copies")).alias("length"))
    return nodes.select(*NODE, "length", F.sha2("lines", 256).alias("digest"))


def file_nodes(ranges: DataFrame) -> DataFrame:
    line = F.concat_ws(":", F.coalesce(F.col("range_id").cast("string"), F.lit("")), "length", "digest")
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("range_id", line.alias("line")))), lambda x: x["line"]), "\n")
    nodes = ranges.groupBy("file_id").agg(lines.alias("lines"), F.sum("length").alias("length"))
    return nodes.select("file_id", "length", F.sha2("lines", 256).alias("digest"))


def paired(primary: DataFrame, replica: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full outer join on null-safe ``keys``; values get the prefixes ``p_`` and ``r_``."""
    sides = [d.select(*keys, F.struct(*values).alias("v"), F.lit(i).alias("side")) for i, d in enumerate((primary, replica))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[F.max(F.when(F.col("side") == i, F.col("v"))).alias(n) for i, n in enumerate("pr")])
    return both.select(*keys, *[F.col(f"{n}.{v}").alias(f"{n}_{v}") for n in "pr" for v in values])


def below(nodes: DataFrame, differing: DataFrame, keys: list[str]) -> DataFrame:
    """The nodes under differing parents."""
    marks = differing.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return nodes.join(marks, on, "left_semi")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Compare two replicas (tables of pages) and locate what differs.

    Rows: ``level`` (file, range, record), ``file_id``, ``range_id``, ``page_id``, ``start`` (of a
    record, inside its range), ``length``, ``primary_digest``, ``replica_digest``, ``status``. Every
    file is listed (``same``, ``changed``, ``missing``, ``extra``); ranges and records only where they
    differ. A record is ``missing`` or ``extra`` (an altered one is both), ``copies`` if it is there
    another number of times, ``moved`` if only its place differs. Empty replicas give no rows.
    """
    leaves = [written(record_digests(d), "leaves") for d in (primary, replica)]
    ranges = [written(range_nodes(d), "ranges") for d in leaves]
    files = written(paired(*map(file_nodes, ranges), ["file_id"], ["length", "digest"]), "files")
    state = F.when(F.col("r_digest").isNull(), "missing").when(F.col("p_digest").isNull(), "extra")
    files = files.withColumn("status", state.when(F.col("p_digest") == F.col("r_digest"), "same").otherwise("changed"))
    odd = files.where("status <> 'same'")
    branches = paired(*[below(d, odd, ["file_id"]) for d in ranges], NODE, ["length", "digest"])
    branches = written(branches.withColumn("status", state.otherwise("changed")).where("not (p_digest <=> r_digest)"), "branches")
    found = paired(*[below(d, branches, NODE) for d in leaves], [*NODE, "page_id", "digest"], ["start", "length", "copies"])
    here = F.col("p_start").isNotNull() & F.col("r_start").isNotNull()
    found = found.withColumn("status", F.when(~here & F.col("r_start").isNull(), "missing").when(~here, "extra")
                             .when(F.col("p_copies") != F.col("r_copies"), "copies").when(F.col("p_start") != F.col("r_start"), "moved"))
    none = F.lit(None).cast("long")
    either = F.coalesce("p_length", "r_length").alias("length")
    digests = [F.col("p_digest").alias("primary_digest"), F.col("r_digest").alias("replica_digest")]
    return (files.select(F.lit("file").alias("level"), "file_id", none.alias("range_id"), none.alias("page_id"), none.alias("start"), either, *digests, "status")
            .unionByName(branches.select(F.lit("range").alias("level"), *NODE, none.alias("page_id"), none.alias("start"), either, *digests, "status"))
            .unionByName(found.where("status is not null").select(
                F.lit("record").alias("level"), *NODE, "page_id", F.coalesce("p_start", "r_start").alias("start"), either,
                F.when(F.col("p_start").isNotNull(), F.col("digest")).alias("primary_digest"),
                F.when(F.col("r_start").isNotNull(), F.col("digest")).alias("replica_digest"), "status")))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with known faults: by the first two digits of a record's digest, one page in 64 is
    lost (00), loses its last character (01), gains one (02) or is stored twice (03)."""
    mark = F.substring(F.sha2(warc_record(F.col("page_id"), F.col("url"), F.col("html")), 256), 1, 2)
    html = F.coalesce("html", F.lit(""))
    faulty = F.when(mark == "01", F.substring(html, F.lit(1), F.greatest(F.length(html) - 1, F.lit(0)))).when(mark == "02", F.concat(html, F.lit("!"))).otherwise(html)
    copies = F.when(mark == "00", F.array().cast("array<int>")).when(mark == "03", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return pages.select("page_id", "url", faulty.alias("html"), F.explode(copies).alias("_n")).drop("_n")


def op8_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as an archive, audited against a replica with known faults."""
    pages = read_table(spark, folder, "pages").select("page_id", "url", "html")
    return audit(pages, damaged(pages))


_TREE = """
{n}_leaves AS (
    SELECT *, floor(page_id / 4096.0)::BIGINT AS file_id, floor(page_id / 64.0)::BIGINT AS range_id,
           coalesce(sum(length * copies) OVER (PARTITION BY floor(page_id / 64.0) ORDER BY page_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM (SELECT page_id, sha256(record) AS digest, strlen(record)::BIGINT AS length, count(*) AS copies FROM {n}_records GROUP BY ALL)),
{n}_ranges AS (
    SELECT file_id, range_id, sum(length * copies)::BIGINT AS length,
           sha256(string_agg(start || ':' || length || ':' || copies || ':' || digest, chr(10) ORDER BY page_id, digest)) AS digest
    FROM {n}_leaves GROUP BY ALL),
{n}_files AS (
    SELECT file_id, sum(length)::BIGINT AS length, sha256(string_agg(range_id || ':' || length || ':' || digest, chr(10) ORDER BY range_id)) AS digest
    FROM {n}_ranges GROUP BY ALL)"""

_RECORD = """'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e || 'WARC-Target-URI: ' || coalesce(url, '')
    || e || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(html) || e || e || html || e || e"""

#: Independent SQL over the whole table: hashes every record of both replicas and joins all levels.
OP8_SQL = f"""
WITH held AS (SELECT page_id, url, coalesce(html, '') AS html, chr(13) || chr(10) AS e FROM pages WHERE page_id IS NOT NULL),
p_records AS (SELECT page_id, url, html, e, {_RECORD} AS record FROM held),
marked AS (SELECT page_id, url, html, e, substr(sha256(record), 1, 2) AS mark FROM p_records),
faulty AS (
    SELECT page_id, url, e, CASE mark WHEN '01' THEN substr(html, 1, greatest(length(html) - 1, 0)) WHEN '02' THEN html || '!' ELSE html END AS html
    FROM (SELECT * FROM marked WHERE mark <> '00' UNION ALL SELECT * FROM marked WHERE mark = '03')),
r_records AS (SELECT page_id, {_RECORD} AS record FROM faulty),{_TREE.format(n="p")},{_TREE.format(n="r")},
files AS (
    SELECT coalesce(p.file_id, r.file_id) AS file_id, coalesce(p.length, r.length) AS length, p.digest AS primary_digest, r.digest AS replica_digest,
           CASE WHEN r.digest IS NULL THEN 'missing' WHEN p.digest IS NULL THEN 'extra' WHEN p.digest = r.digest THEN 'same' ELSE 'changed' END AS status
    FROM p_files p FULL JOIN r_files r ON p.file_id = r.file_id),
ranges AS (
    SELECT coalesce(p.file_id, r.file_id) AS file_id, coalesce(p.range_id, r.range_id) AS range_id, coalesce(p.length, r.length) AS length,
           p.digest AS primary_digest, r.digest AS replica_digest,
           CASE WHEN r.digest IS NULL THEN 'missing' WHEN p.digest IS NULL THEN 'extra' ELSE 'changed' END AS status
    FROM p_ranges p FULL JOIN r_ranges r ON p.range_id = r.range_id WHERE p.digest IS DISTINCT FROM r.digest),
records AS (
    SELECT coalesce(p.file_id, r.file_id) AS file_id, coalesce(p.range_id, r.range_id) AS range_id, coalesce(p.page_id, r.page_id) AS page_id,
           coalesce(p.start, r.start) AS start, coalesce(p.length, r.length) AS length, p.digest AS primary_digest, r.digest AS replica_digest,
           CASE WHEN r.digest IS NULL THEN 'missing' WHEN p.digest IS NULL THEN 'extra' WHEN p.copies <> r.copies THEN 'copies' WHEN p.start <> r.start THEN 'moved' END AS status
    FROM p_leaves p FULL JOIN r_leaves r ON p.page_id = r.page_id AND p.digest = r.digest)
SELECT 'file' AS level, file_id, NULL::BIGINT AS range_id, NULL::BIGINT AS page_id, NULL::BIGINT AS start, length, primary_digest, replica_digest, status FROM files
UNION ALL SELECT 'range', file_id, range_id, NULL, NULL, length, primary_digest, replica_digest, status FROM ranges
UNION ALL SELECT 'record', file_id, range_id, page_id, start, length, primary_digest, replica_digest, status FROM records WHERE status IS NOT NULL
"""
