"""WARC archives and their Merkle fixity audit.

An archive is a set of WARC files, each an ordered list of records. ``store``
writes it: a table in the shared folder with a row per record that holds its
file, its place there and its bytes, in file order, so a file is its rows'
bytes one after another. ``records`` reads a stored replica back; numbers,
offsets, lengths and digests are all taken from the bytes that it finds, so a
record that was changed, cut or lost in the store shows. Records are WARC 1.1
resource records, and their headers say how long they are: one whose bytes end
elsewhere than its Content-Length says is ``torn``. A record's leaf hash covers its number, its offset range in the file and its bytes; above
the leaves, every ``FANOUT`` consecutive nodes make one node, whose hash covers
its offset range and its children's hashes in order, up to one root per file.

An audit compares the roots of two replicas and descends level by level, only
below nodes that differ, down to the records that differ. A record that only
one replica has differs too, and behind a record of another length or a missing
one all later records of the file differ, as they have other offsets. Where a file's roots agree, none of its lower
levels is read.

Everything is grouped by (file, node number): a node has at most ``FANOUT``
children, so a file of any length spreads over all tasks. Files are cut by a
hash of the page id to about ``FILE_RECORDS`` records, so no host makes one
file large. Offsets are running sums inside a file.

Null urls and htmls are empty; null ids come first. Repeated pages are records
of their own, in the order of their bytes. An empty table has no files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import materialise, table

FANOUT = 16
FILE_RECORDS = 512
#: A replica is damaged in about one record in so many.
DAMAGE = 50


#: The date of records whose pages have none.
DATE = "1970-01-01T00:00:00Z"


def record_bytes(page_id: Column, url: Column, html: Column, date: str = DATE) -> Column:
    """A WARC 1.1 resource record as bytes. Line ends in a URL are escaped."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]+", "%0A"),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def declared_bytes(payload: Column) -> Column:
    """The length of a record as its own header gives it: the header up to the
    first blank line, Content-Length, and the blank lines behind the block.
    Null where there is no such header."""
    text = payload.cast("string")
    head = F.substring(text, F.lit(1), F.instr(text, "\r\n\r\n") + 3)
    block = F.nullif(F.regexp_extract(head, r"\r\nContent-Length: ([0-9]+)\r\n", 1), F.lit("")).cast("long")
    return F.octet_length(head) + block + 4


def spread(key: Column, salt: str, n: int) -> Column:
    """A number from 0 to n - 1 by the MD5 of ``key``."""
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def store(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(file, place, page_id, payload): the records of ``pages`` as they stand
    in the shared folder, in files of about ``FILE_RECORDS`` records.

    Bytes are shuffled once, to their file.
    """
    files = max(1, -(-pages.count() // FILE_RECORDS))
    key = F.coalesce(F.col(id_col).cast("string"), F.col(url_col))
    rows = pages.select(
        spread(key, "", files).alias("file"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        record_bytes(F.col(id_col), F.col(url_col), F.col(html_col)).alias("payload"))
    order = Window.partitionBy("file").orderBy("page_id", "url", F.sha2("payload", 256))
    placed = rows.withColumn("place", F.row_number().over(order).cast("long") - 1)
    return materialise(placed.select("file", "place", "page_id", "payload"), "warc-archive")


def records(stored: DataFrame) -> DataFrame:
    """(file, pos, page_id, offset, length, digest, torn) of the records that a
    stored replica has.

    ``digest`` is the SHA-256 of the bytes read back; the bytes themselves are
    not shuffled. ``torn``: they are not as many as the record's header says.
    """
    length = F.octet_length("payload").cast("long")
    rows = stored.select(
        "file", "place", "page_id", length.alias("length"), F.sha2("payload", 256).alias("digest"),
        (~declared_bytes(F.col("payload")).eqNullSafe(length)).alias("torn"))
    order = Window.partitionBy("file").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "file", (F.row_number().over(order).cast("long") - 1).alias("pos"), "page_id",
        F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset"), "length", "digest", "torn")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``records`` of the archive of ``pages``, which is written and read back."""
    return records(store(pages, id_col, url_col, html_col))


def leaves(records: DataFrame) -> DataFrame:
    """(file, node, lo, hi, hash): level 0 of the tree."""
    hi = F.col("offset") + F.col("length")
    return records.select(
        "file", F.col("pos").alias("node"), F.col("offset").alias("lo"), hi.alias("hi"),
        F.sha2(F.concat_ws(":", "pos", "offset", "length", "digest"), 256).alias("hash"))


def parents(level: DataFrame) -> DataFrame:
    """The next level: one node for every ``FANOUT`` consecutive nodes."""
    children = F.sort_array(F.collect_list(F.struct("node", "hash")))
    grouped = level.groupBy("file", F.floor(F.col("node") / FANOUT).cast("long").alias("parent")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), children.alias("children"))
    return grouped.select(
        "file", F.col("parent").alias("node"), "lo", "hi",
        F.sha2(F.concat_ws(":", "lo", "hi", F.array_join(F.col("children.hash"), ",")), 256).alias("hash"))


def merkle(records: DataFrame) -> list[DataFrame]:
    """The levels of the trees of a replica, leaves first, roots last, written
    to the shared folder."""
    levels = [materialise(leaves(records), "warc-level0")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top > 0:
        levels.append(materialise(parents(levels[-1]), f"warc-level{len(levels)}"))
        top //= FANOUT
    return levels


def audit(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """(file, node, left_hash, right_hash) of the leaves that differ."""
    while len(left) != len(right):  # the shorter tree grows roots above its roots
        (left if len(left) < len(right) else right).append(parents((left if len(left) < len(right) else right)[-1]))
    suspects = None
    for a, b in zip(reversed(left), reversed(right)):
        if suspects is not None:
            a, b = (x.join(suspects, (x.file == suspects.s_file) & (F.floor(x.node / FANOUT) == suspects.s_node), "left_semi") for x in (a, b))
        found = a.select("file", "node", F.col("hash").alias("left_hash")).join(
            b.select("file", "node", F.col("hash").alias("right_hash")), ["file", "node"], "full")
        differ = materialise(found.where(~F.col("left_hash").eqNullSafe(F.col("right_hash"))), "warc-differ")
        suspects = differ.select(F.col("file").alias("s_file"), F.col("node").alias("s_node"))
    return differ


def damaged(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", every: int = DAMAGE) -> DataFrame:
    """Another replica of ``pages``: the first character of about one html in
    ``every`` has changed."""
    bad = spread(F.col(id_col), "damage", every) == 0
    changed = F.concat(F.lit("?"), F.expr(f"substring({html_col}, 2)"))
    return pages.withColumn(html_col, F.when(bad, changed).otherwise(F.col(html_col)))


def damaged_copy(
    stored: DataFrame, changed: int | None = DAMAGE, cut: int | None = None, lost: int | None = None, cut_bytes: int = 8
) -> DataFrame:
    """Another replica of ``stored``, written to the shared folder: of about
    one record in ``changed`` the first character of the body differs, one in
    ``cut`` lacks its last ``cut_bytes`` (the blank lines are four of them),
    one in ``lost`` is missing."""
    bad = lambda kind, every: spread(F.col("page_id"), kind, every) == 0 if every else F.lit(False)  # noqa: E731
    text = F.col("payload").cast("string")  # the same bytes, counted in characters
    body = F.instr(text, "\r\n\r\n") + 4
    tail = F.length(text) - 3  # where the blank lines begin
    other = F.concat(F.substring(text, F.lit(1), body - 1), F.lit("?"), F.substring(text, F.least(body + 1, tail), F.length(text)))
    payload = F.when(bad("damage", changed), other.cast("binary")).otherwise(F.col("payload"))
    copy = stored.where(~bad("lost", lost)).withColumn("payload", payload)
    short = F.substring("payload", F.lit(1), F.octet_length("payload") - cut_bytes)
    return materialise(copy.withColumn("payload", F.when(bad("cut", cut), short).otherwise(F.col("payload"))), "warc-replica")


#: Of so many records one is cut, or lost, in the query's replica: some files
#: are shifted from there on and others are not.
CUT, LOST = 2003, 1999


def op10_warc(spark, sf_dir):
    """The records of the archive of all pages that a damaged replica has
    otherwise (changed, cut, missing, or at another offset behind those), found
    by descending both replicas' trees."""
    archived = store(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    replica = damaged_copy(archived, cut=CUT, lost=LOST, cut_bytes=4)
    ours, theirs = (materialise(records(r), "warc-records") for r in (archived, replica))
    differ = audit(merkle(ours), merkle(theirs)).select("file", F.col("node").alias("pos"))
    found = differ.join(ours.drop("torn"), ["file", "pos"], "left")
    other = theirs.select("file", "pos", F.col("digest").alias("replica_digest"), F.col("torn").alias("replica_torn"))
    return found.join(other, ["file", "pos"], "left").select(
        "file", "pos", "page_id", "offset", "length", "digest", "replica_digest", "replica_torn")


OP10_SQL = rf"""
WITH file_count AS (SELECT greatest(1, (count(*) + 511) // 512) AS n FROM pages),
page AS (
  SELECT page_id, url, coalesce(html, '') AS html, coalesce(CAST(page_id AS VARCHAR), 'null') AS id,
         CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), url, 'null')), 1, 8) AS BIGINT) % n AS file
  FROM pages, file_count),
record AS (
  SELECT file, page_id, url, html, chr(13) || chr(10) AS ln,
         CAST('0x' || substr(md5('damage' || id), 1, 8) AS BIGINT) % {DAMAGE} = 0 AS bad,
         CAST('0x' || substr(md5('cut' || id), 1, 8) AS BIGINT) % {CUT} = 0 AS cut,
         CAST('0x' || substr(md5('lost' || id), 1, 8) AS BIGINT) % {LOST} = 0 AS lost,
         'WARC/1.1' || ln || 'WARC-Type: resource' || ln || 'WARC-Record-ID: <urn:page:' || id || '>' || ln || 'WARC-Date: {DATE}' || ln
         || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[
]+', '%0A', 'g') || ln || 'Content-Type: text/html' || ln
         || 'Content-Length: ' || strlen(html) || ln || ln AS head
  FROM page),
bytes AS (
  SELECT *, head || html || ln || ln AS one,
         head || CASE WHEN bad THEN '?' || substr(html, 2) ELSE html END || CASE WHEN cut THEN '' ELSE ln || ln END AS two
  FROM record),
ours AS (
  SELECT file, row_number() OVER w - 1 AS pos, page_id, strlen(one) AS length, sha256(one) AS digest,
         CAST(coalesce(sum(strlen(one)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM bytes WINDOW w AS (PARTITION BY file ORDER BY page_id NULLS FIRST, url NULLS FIRST)),
theirs AS (
  SELECT file, row_number() OVER w - 1 AS pos, strlen(two) AS length, sha256(two) AS digest, strlen(one) <> strlen(two) AS torn,
         CAST(coalesce(sum(strlen(two)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM bytes WHERE NOT lost WINDOW w AS (PARTITION BY file ORDER BY page_id NULLS FIRST, url NULLS FIRST))
SELECT o.file, o.pos, o.page_id, o."offset", o.length, o.digest, t.digest AS replica_digest, t.torn AS replica_torn
FROM ours o LEFT JOIN theirs t ON o.file = t.file AND o.pos = t.pos
WHERE t.digest IS NULL OR (o."offset", o.length, o.digest) <> (t."offset", t.length, t.digest)
"""
