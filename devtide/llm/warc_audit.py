"""Merkle fixity audit of WARC replicas.

Pages become WARC records, which lie one behind the other in archive files. Each record's bytes
are hashed, and with the range of offsets it takes gives a leaf; ``FANOUT`` nodes that follow
each other give one above, up to a root for each file, and on over the files to one root. Two
replicas are compared from the root down: only children of nodes that differ are looked at, so
the leaves that differ are the damaged ranges.

Defined results: null urls and texts are empty ones; pages that are equal in every column used are
one record; pages without an id lie in files of their own, dealt out by their text; very long
records are hashed whole; an empty replica is one that lacks every record, and two empty ones are
equal. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: Ids that share an archive file, and children of a node.
FILE_IDS, FANOUT = 1000, 16
#: Files among which pages without an id are dealt out (below 0).
LOST_FILES = 4096
#: The scenario of the query: of each this many ids, one record is altered and one is lost.
DAMAGE, ALTERED, LOST = 503, 7, 13


def record(page_id: str = "page_id", url: str = "url", html: str = "html"):
    """The text of a page's WARC record."""
    text = F.coalesce(F.col(html), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(page_id).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(text).cast("string"),
        F.lit("\r\n\r\n"),
        text,
        F.lit("\r\n\r\n"),
    )


def digests(pages: DataFrame, copy: str = "html") -> DataFrame:
    """page_id, file, length and digest of each record, equal records once; and length and digest
    of the record with the column ``copy`` in place of ``html``."""
    own = F.floor(F.col("page_id") / FILE_IDS)
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(LOST_FILES))
    return (
        pages.select("page_id", record().alias("text"), record(html=copy).alias("copy"))
        .select(
            "page_id",
            F.coalesce(own, spread).alias("file"),
            F.octet_length("text").cast("long").alias("length"),
            F.sha2("text", 256).alias("digest"),
            F.octet_length("copy").cast("long").alias("copy_length"),
            F.sha2("copy", 256).alias("copy_digest"),
        )
        .distinct()
    )


def layout(records: DataFrame) -> DataFrame:
    """``records`` with their number in the file (``place``) and ``offset``. A file holds the
    records of ``FILE_IDS`` ids."""
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("place", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0))
    )


def _above(level: DataFrame, group: list[str]) -> DataFrame:
    """Parents of nodes: ``FANOUT`` children at most, in order."""
    children = F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda c: c["hash"])
    return level.groupBy(*group).agg(F.sha2(F.concat_ws(",", children), 256).alias("hash"))


def tree(records: DataFrame, height: int, width: int) -> list[DataFrame]:
    """Levels from the leaves (file, node, hash) up to the files' roots (``height`` steps), and on
    to the root of all (``width`` steps), each stored."""
    leaf = F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256)
    levels = [records.select("file", F.col("place").alias("node"), leaf.alias("hash"))]
    for step in range(height + width):
        if step < height:
            up = ["file", F.floor(F.col("node") / FANOUT).alias("up")]
            level = _above(levels[-1], up).select("file", F.col("up").alias("node"), "hash")
        else:
            # Above the files' roots, a node is a run of files.
            files = levels[-1].select(F.col("file").alias("node"), "hash")
            up = [F.floor(F.col("node") / FANOUT).alias("file")]
            level = _above(files, up).select("file", F.lit(0).cast("long").alias("node"), "hash")
        levels.append(shared.stored(level, f"level{step + 1}"))
    return levels


def _steps(count: int) -> int:
    steps = 0
    while count > 1:
        count, steps = -(-count // FANOUT), steps + 1
    return steps


def audit(replica: DataFrame, other: DataFrame) -> DataFrame:
    """The records (file, place) that are not the same in both: ``kind`` is altered, missing (in
    ``other``) or extra. Both have file, place, offset, length, digest."""
    both = replica.select("file", "place").union(other.select("file", "place"))
    sizes = both.agg(F.max("place"), F.min("file"), F.max("file")).first()
    height = _steps((sizes[0] or 0) + 1)
    # One run of files on each side of 0 is as far as runs can be joined.
    width = _steps(max(abs(sizes[1] or 0), abs(sizes[2] or 0)) + 1)
    trees = [tree(replica, height, width), tree(other, height, width)]
    differ = None
    for step in range(height + width, -1, -1):
        left, right = (t[step] for t in trees)
        if differ is not None:
            if step >= height:
                parent = [F.floor(F.col("file") / FANOUT).alias("p_file"), F.lit(0).cast("long").alias("p_node")]
            else:
                parent = [F.col("file").alias("p_file"), F.floor(F.col("node") / FANOUT).alias("p_node")]
            wanted = differ.select(F.col("file").alias("p_file"), F.col("node").alias("p_node"))
            left, right = (
                side.select("*", *parent).join(wanted, ["p_file", "p_node"], "left_semi").select("file", "node", "hash")
                for side in (left, right)
            )
        pairs = left.withColumnRenamed("hash", "a").join(
            right.withColumnRenamed("hash", "b"), ["file", "node"], "full"
        )
        differ = pairs.filter(~F.col("a").eqNullSafe(F.col("b")))
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("altered")
    return differ.select("file", F.col("node").alias("place"), kind.alias("kind"))


def op6_warc_audit(spark, sf_dir: str) -> DataFrame:
    """The records of ``pages`` that a damaged replica of them does not hold as they are: in the
    replica, of each ``DAMAGE`` ids one record's text has other letters in place, and one is gone."""
    pages = shared.read(spark, sf_dir, "pages")
    hit = F.coalesce(F.pmod("page_id", F.lit(DAMAGE)), F.lit(-1))
    worn = F.when(hit == ALTERED, F.translate("html", "e", "3")).otherwise(F.col("html"))
    good = shared.stored(layout(digests(pages.withColumn("worn", worn), "worn")), "replica")
    # The damage leaves all other records where they are.
    bad = good.filter((hit != LOST) & (F.col("length") == F.col("copy_length"))).select(
        "file", "place", "offset", "length", F.col("copy_digest").alias("digest")
    )
    found = audit(good, bad)
    return good.join(found, ["file", "place"]).select(
        "page_id", "file", "place", "offset", "length", "kind"
    )


ORACLE = f"""
WITH records AS (
  SELECT DISTINCT page_id, url, html,
    CAST(strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
      || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Type: text/html' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS BIGINT) AS length
  FROM pages
), placed AS (
  SELECT page_id, html, length, page_id // {FILE_IDS} AS file,
    row_number() OVER w - 1 AS place,
    CAST(coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
      AS "offset"
  FROM records WINDOW w AS (PARTITION BY page_id // {FILE_IDS} ORDER BY page_id)
)
SELECT page_id, file, place, "offset", length,
  CASE WHEN page_id % {DAMAGE} = {LOST} THEN 'missing' ELSE 'altered' END AS kind
FROM placed
WHERE page_id % {DAMAGE} = {LOST}
   OR (page_id % {DAMAGE} = {ALTERED} AND contains(html, 'e'))
"""
