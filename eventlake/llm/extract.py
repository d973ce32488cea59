"""HTML extraction by differencing pages with their nearest URL.

A page is read into text lines, one per block: white space inside a block is
one space, character references are decoded. Lines are chrome (menus, headers,
footers, sidebars, notices, adverts, forms, comments and the like, by element,
role, class and id), article (inside the page's article or main element) or
plain (neither).

Pages of a host are sorted by path. Neighbours with the very same lines are
copies: they say nothing about each other's template, so a run of them is taken
as one page, and what is deleted from it is deleted from each. Each run is
paired with the neighbouring run whose path shares the longer prefix with its
own, and the lines of the pair are aligned by their longest common subsequence.

What two pages of a host share is their template, and is deleted, whatever its
markup (``n_template`` counts these lines). Markup decides where sharing says
nothing: a shared line inside the page's article stays (``n_quoted``), as
copies, quotations and recurring sentences inside an article are its text and
the article is to be whole; and chrome that no neighbour shares, such as a
reader's comment, goes (``n_marked``). If a page has an article, plain lines
beside it are no text either (``n_marked``) unless they stand in a sibling
article, as a body may be split over several; siblings marked as comments,
related or the like are chrome.

Skew: only line hashes are sorted, by range over (host, path), so a host of any
size spreads over all tasks. A task pairs the runs it holds; its first and last
run meet their neighbours in other tasks in a second, small step of at most two
pages a task, so the result doesn't depend on how rows are dealt. Deletions are
joined to the pages by run: the planner broadcasts them only if their written
table is small, and splits the pages of a large run otherwise.

Null and empty htmls have an empty text. Null urls and those without ``://``
have an empty host and path and are paired among themselves; equal paths are
ordered by page id. Repeated rows are pages of their own and copies of each
other. A host's only page, or only copies of it, keep their unmarked lines.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import materialise, small_batches, table
from eventlake.llm.markup import ARTICLE, PLAIN, read_parts
from eventlake.llm.urls import host_of, path_of

#: Bits of alignment kept at once; longer pairs are halved first.
ALIGN_BITS = 1 << 28
LINES = "lines array<struct<at:int,text:string>>, kinds array<int>, hashes array<long>"
#: What a line may be in ``kinds``.
TEXT, UNDECIDED, NO_TEXT = 0, 1, 2


def rows_of_bits(a: list[int], b: list[int]) -> list[int]:
    """After each line of ``b`` the bit-parallel LCS row over ``a``: a zero
    bit i says that line i lengthens the subsequence."""
    at: dict[int, int] = {}
    for i, line in enumerate(a):
        at[line] = at.get(line, 0) | 1 << i
    mask = row = (1 << len(a)) - 1
    out = []
    for line in b:
        hit = row & at.get(line, 0)
        row = (row + hit | row - hit) & mask
        out.append(row)
    return out


def halves(a: list[int], b: list[int]) -> int:
    """Where to cut ``a`` so that its halves' subsequences with the halves of
    ``b`` add up to the longest one."""
    half = len(b) // 2

    def lengths(x: list[int], y: list[int]) -> np.ndarray:
        row = (1 << len(x)) - 1
        at: dict[int, int] = {}
        for i, line in enumerate(x):
            at[line] = at.get(line, 0) | 1 << i
        mask = row
        for line in y:
            hit = row & at.get(line, 0)
            row = (row + hit | row - hit) & mask
        bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(x) // 8), "little"), np.uint8), bitorder="little")[: len(x)]
        return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

    ahead, behind = lengths(a, b[:half]), lengths(a[::-1], b[half:][::-1])[::-1]
    return int(np.argmax(ahead + behind))


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence of two line lists."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [(i, i) for i in range(head)], [(len(a) - i, len(b) - i) for i in range(tail, 0, -1)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    middle: list[tuple[int, int]] = []
    if x and y and len(x) * len(y) > ALIGN_BITS and len(y) > 1:
        cut, half = halves(x, y), len(y) // 2
        middle = aligned(x[:cut], y[:half]) + [(cut + i, half + j) for i, j in aligned(x[cut:], y[half:])]
    elif x and y:
        rows = rows_of_bits(x, y)
        i, j = len(x), len(y)
        while i and j:
            if rows[j - 1] >> i - 1 & 1:
                i -= 1
            elif j > 1 and not rows[j - 2] >> i - 1 & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                middle.append((i, j))
        middle.reverse()
    return [*ends[0], *((head + i, head + j) for i, j in middle), *ends[1]]


def read_pages(df: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``row`` (the columns given, without the html), host, path, the lines
    that may be text, and for every line what the markup says of it (inside the
    article, undecided, or no text if it isn't shared) and its hash."""
    small_batches(df.sparkSession)
    kept = [F.col(c) for c in df.columns if c != html_col]
    rows = df.select(
        F.struct(*kept).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    schema = T.StructType([*rows.schema.fields[:3], *T.StructType.fromDDL(LINES).fields])
    line = pa.list_(pa.struct([("at", pa.int32()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, kinds, hashes = [], [], []
            for html in batch.column(3).to_pylist():
                blocks = read_parts(html)
                whole = any(kind == ARTICLE for _, kind, _ in blocks)
                kinds.append([TEXT if kind == ARTICLE else UNDECIDED if kind == PLAIN and (beside or not whole) else NO_TEXT
                              for _, kind, beside in blocks])
                lines.append([{"at": i, "text": b[0]} for i, b in enumerate(blocks) if kinds[-1][i] != NO_TEXT])
                hashes.append(np.array([xxhash.xxh64_intdigest(b[0].encode()) for b in blocks], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(lines, line), pa.array(kinds, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))],
                names=schema.names)

    return rows.mapInArrow(run, schema)


MEMBER = "uid long, of_run long"
PAIR = "run long, prefix int, before boolean, shared array<int>"
EDGE = "part int, last boolean, e_run long, host string, path string, end_path string, hashes array<long>"


def paired(a: dict, b: dict) -> list[dict]:
    """What each of two neighbouring runs shares with the other; a: the earlier
    one. Runs of different hosts, and two parts of one run, share nothing."""
    if a["host"] != b["host"] or a["hashes"] == b["hashes"]:
        return []
    pairs = aligned(a["hashes"], b["hashes"])
    prefix = len(os.path.commonprefix([a["end_path"], b["path"]]))
    return [{"run": run["run"], "prefix": prefix, "before": before, "shared": [p[side] for p in pairs]}
            for run, side, before in ((a, 0, False), (b, 1, True))]


def pair_sorted(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every page's run; the pairs of runs inside every task's range of pages;
    and every range's first and last run."""
    small_batches(pages.sparkSession)
    keys = pages.select("host", "path", "page_order", "uid", "hashes")
    ranged = keys.repartitionByRange("host", "path", "page_order", "uid").sortWithinPartitions("host", "path", "page_order", "uid")
    ranged = ranged.select("host", "path", "uid", "hashes")
    types = [T.StructType.fromDDL(x) for x in (MEMBER, PAIR, EDGE)]
    schema = T.StructType([f for t in types for f in t.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part = TaskContext.get().partitionId()
        edge = lambda p, last: {"part": part, "last": last, "e_run": p["run"]} | {
            k: p[k] for k in ("host", "path", "end_path", "hashes")}
        now = before = None  # the run being read, and the one before it
        number = part << 40
        for batch in batches:
            made: list[dict] = []
            for page in batch.to_pylist():
                if now and now["host"] == page["host"] and now["hashes"] == page["hashes"]:
                    now["end_path"] = page["path"]
                else:
                    if now:
                        made += paired(before, now) if before else [edge(now, False)]
                    before, now = now, page | {"run": number, "end_path": page["path"]}
                    number += 1
                made.append({"uid": page["uid"], "of_run": now["run"]})
            yield pa.RecordBatch.from_pylist(made, schema=arrow)
        if now:
            made = paired(before, now) if before else [edge(now, False)]
            yield pa.RecordBatch.from_pylist([*made, edge(now, True)], schema=arrow)

    out = materialise(ranged.mapInArrow(run, schema), "html-pairs")
    members, pairs, edges = (out.where(F.col(k).isNotNull()).select(*t.names) for k, t in zip(("of_run", "run", "e_run"), types))
    return members, pairs, edges


ALIAS = "part_run long, whole_run long"


def pair_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs across ranges, and which runs go on from one range to the
    next (the later part's number and the first one's). At most two runs a
    range meet here."""
    types = [T.StructType.fromDDL(x) for x in (PAIR, ALIAS)]
    schema = T.StructType([f for t in types for f in t.fields])
    ordered = edges.repartition(1).sortWithinPartitions("part", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        held: dict | None = None  # the last run seen, under its first part's number
        for batch in batches:
            made: list[dict] = []
            for page in batch.to_pylist():
                page["run"] = page["e_run"]
                if held and page["run"] == held["e_run"]:  # a range's only run, first and last
                    page["run"] = held["run"]
                elif held and page["part"] != held["part"]:
                    if held["host"] == page["host"] and held["hashes"] == page["hashes"]:
                        made.append({"part_run": page["run"], "whole_run": held["run"]})
                        page["run"] = held["run"]
                    else:
                        made += paired(held, page)
                held = page
            yield pa.RecordBatch.from_pylist(made, schema=to_arrow_schema(schema))

    out = materialise(ordered.mapInArrow(run, schema), "html-edges")
    return tuple(out.where(F.col(t.names[0]).isNotNull()).select(*t.names) for t in types)


def differenced(df: DataFrame, url_col: str, html_col: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written pages (``uid``, ``row``, lines and kinds), every page's run,
    and the lines that a run shares with its nearest one."""
    pages = read_pages(df, url_col, html_col).withColumn("uid", F.monotonically_increasing_id())
    pages = materialise(pages.withColumn("page_order", F.col("row")[id_col]), "html-lines")
    members, inside, edges = pair_sorted(pages)
    across, parts = pair_edges(edges)

    def whole(rows: DataFrame, column: str) -> DataFrame:
        """With a run's number in the place of those of its later parts."""
        named = rows.join(parts, F.col(column) == F.col("part_run"), "left")
        return named.withColumn(column, F.coalesce("whole_run", column)).drop(*parts.columns)

    best = whole(inside.unionByName(across), "run").groupBy("run").agg(F.max(F.struct("prefix", "before", "shared")).alias("best"))
    shared = materialise(best.select("run", "best.shared"), "html-shared")
    members = whole(members, "of_run").select(F.col("uid").alias("member"), "of_run")
    return pages, members, shared


def extract(df: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id", out: str = "text") -> DataFrame:
    """The columns of ``df`` without the html, and the main text as ``out``
    (which replaces a column of that name)."""
    kept = df.drop(out) if out in df.columns and out != html_col else df
    pages, members, shared = differenced(kept, url_col, html_col, id_col)
    # Only pages with lines that the markup leaves open need what is shared.
    open_at = F.filter(F.sequence(F.lit(0), F.size("kinds") - 1), lambda i: F.get("kinds", i) == UNDECIDED)
    left_open = pages.where(F.exists("kinds", lambda k: k == UNDECIDED)).select("uid", open_at.alias("open_at"))
    gone = left_open.join(members, F.col("uid") == F.col("member")).join(shared, F.col("of_run") == F.col("run"))
    gone = gone.select(F.col("uid").alias("gone_uid"), F.array_intersect("shared", "open_at").alias("gone")).where("size(gone) > 0")
    joined = pages.join(materialise(gone, "html-gone"), F.col("uid") == F.col("gone_uid"), "left")
    left = F.filter("lines", lambda x: F.col("gone").isNull() | ~F.array_contains("gone", x["at"]))
    text = F.array_join(F.transform(left, lambda x: x["text"]), "\n\n")
    names = [c for c in kept.columns if c != html_col]
    return joined.select(*(F.col("row")[c].alias(c) for c in names), text.alias(out))


def decisions(df: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """(``id_col``, n_template, n_marked, n_quoted): the lines of every page
    that each rule decided, as the module's text counts them."""
    pages, members, shared = differenced(df.select(id_col, url_col, html_col), url_col, html_col, id_col)
    judged = pages.select("uid", F.col("row")[id_col].alias(id_col), "kinds").join(members, F.col("uid") == F.col("member"))
    judged = judged.join(shared, F.col("of_run") == F.col("run"), "left").withColumn(
        "shared", F.coalesce("shared", F.array().cast("array<int>")))
    n_shared = lambda *kinds: F.size(F.filter("shared", lambda i: F.get("kinds", i).isin(*kinds))).cast("long")
    marked = F.size(F.filter("kinds", lambda k: k == NO_TEXT)).cast("long") - n_shared(NO_TEXT)
    return judged.select(id_col, n_shared(UNDECIDED, NO_TEXT).alias("n_template"), marked.alias("n_marked"), n_shared(TEXT).alias("n_quoted"))


def op9_extract(spark, sf_dir):
    """Contract query: the main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
