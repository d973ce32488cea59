"""Gold run (DED-3, UPS-1..3, VAL-1..4, PUB-1, H-5).

``run_gold`` is the all-or-nothing equivalent of one transactional ETL
script run:

1. read the published state: run id, watermark = max(silver_processed_at)
   of published facts (epoch at first), last silver run seen;
2. the batch = conformed silver rows of newer silver runs with
   ``processed_at > watermark`` (folder list + pushed filter);
3. dim_actors / dim_repos: latest row per key in the batch, upserted with the
   strict newer-than guard into the hash buckets that the batch touches; the
   other buckets stay where they are. Their number follows the rows: buckets
   are split one by one (linear hashing), each from one other;
4. dim_event_types: auto-discovery of the batch's types (the same result
   as scanning the whole view, see the step; one column, partially
   aggregated);
5. facts: batch rows, one per event_id, whose id is not published under any
   date, which the id index tells from the buckets the batch touches;
   the run's aggregates (``plans/rollups.py``) and ids are written with them;
6. all are written to folders of this attempt; constraint checks run on what
   was written; only then the commit record is written, which names them.

Any failure before the record leaves the previous run published and the
watermark unchanged, so the next run retries exactly the same batch.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schema as S
from eventlake.functions.rules import owner_project_sql
from eventlake.operators import validate as V
from eventlake.operators.conform import conform
from eventlake.operators.dedupe import latest_by_key
from eventlake.operators.merge import (
    ACTION, KEEP, insert_ignore, insert_new_types, seed_upsert, upsert_if_newer,
)
from eventlake.plans import rollups as R
from eventlake.plans.concurrent import run_concurrently
from eventlake.plans.ids import only_new
from eventlake.plans.silver import _as_datetime
from eventlake.plans.warehouse import BUCKET, DIM_BUCKET_ROWS, DIM_BUCKETS, DIM_KEYS, DIM_TABLES, RUN_ID, Warehouse, lit_ts
from eventlake.session import describe
from eventlake.sources import seeds
from eventlake.sources.calendar import dim_date

RUN_METRICS = T.StructType([
    T.StructField("silver_run", T.IntegerType()),
    T.StructField("watermark_before", T.TimestampType()),
    T.StructField("watermark_after", T.TimestampType()),
    T.StructField("actors_affected", T.LongType()),
    T.StructField("repos_affected", T.LongType()),
    T.StructField("types_inserted", T.LongType()),
    T.StructField("facts_inserted", T.LongType()),
    T.StructField("total_actors", T.LongType()),
    T.StructField("total_repos", T.LongType()),
    T.StructField("total_types", T.LongType()),
    T.StructField("total_facts", T.LongType()),
    T.StructField("long_names", T.LongType()),
    T.StructField("ms_actors", T.LongType()),
    T.StructField("ms_repos", T.LongType()),
    T.StructField("ms_types", T.LongType()),
    T.StructField("ms_facts", T.LongType()),
    T.StructField("ms_validate", T.LongType()),
    T.StructField("ms_total", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
])

FACT_COLUMNS = [f.name for f in S.FACT_EVENTS.fields]
_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def _fmt(ts: dt.datetime) -> str:
    return ts.strftime(_TS_FMT)


def bootstrap(wh: Warehouse, now: dt.datetime | str = S.EPOCH, reset: bool = False,
              dim_buckets: int = DIM_BUCKETS, dim_bucket_rows: int = DIM_BUCKET_ROWS,
              calendar: tuple[dt.date, dt.date] = (S.DIM_DATE_START, S.DIM_DATE_END)) -> bool:
    """SNK-5: create dim_date and run 0 (seeded dimensions, no facts).

    ``reset`` drops silver and gold first and keeps bronze, so the whole
    warehouse is rebuilt from the raw layer. ``calendar`` is the first and last
    day of dim_date (``extend_calendar`` makes it longer); dimensions begin with
    ``dim_buckets`` buckets and split them above ``dim_bucket_rows`` rows each.
    Returns False when the warehouse was already bootstrapped (see
    ``apply_seeds`` for that case).
    """
    if reset:
        for rel in ("silver", "gold"):
            wh.fs.delete(wh.path(rel))
    if wh.gold_state() is not None:
        return False
    spark, now_col = wh.spark, lit_ts(now)
    types = seed_upsert(seeds.empty(spark, S.DIM_EVENT_TYPES), seeds.event_type_seed(spark), now_col).drop(ACTION)
    days, metrics = wh.attempt("gold/dim_date"), wh.attempt("gold/run_metrics")
    sizes = {"dim_actors": dim_buckets, "dim_repos": dim_buckets, "dim_event_types": 1}
    rows = {"dim_actors": seeds.actor_sentinel(spark), "dim_repos": seeds.repo_sentinel(spark), "dim_event_types": types}
    out = run_concurrently(spark, "bootstrap", {
        "dim_date": lambda: dim_date(spark, *calendar).write.parquet(days),
        "run_metrics": lambda: _write_metrics(wh, metrics, {"run_id": 0, "silver_run": 0, "watermark_before": S.EPOCH,
            "watermark_after": S.EPOCH, "total_actors": 1, "total_repos": 1, "total_types": len(S.EVENT_TYPE_SEED)}, None),
        **{n: (lambda n=n: _write_buckets(wh, n, rows[n], sizes[n], [], [])[0]) for n in rows}})
    record = {
        "run_id": 0, "watermark": _fmt(S.EPOCH), "silver_run": 0, "dim_date": days, "calendar": [_key(d) for d in calendar],
        "buckets": sizes, "bucket_rows": dim_bucket_rows, "dims": {n: out[n] for n in rows}, "fact_events": [], "ids": [],
        "rollups": [], "run_metrics": [{"path": metrics, "id": 0, "rows": 1}]}
    check_written(wh, record, {"dims": {n: [] for n in rows}})
    wh.gold_log.commit(None, record)
    return True


def extend_calendar(wh: Warehouse, start: dt.date, end: dt.date, now: dt.datetime | str) -> int:
    """Give dim_date every day from ``start`` to ``end``, which must hold the
    days it has, so that a run that met a date outside can go on. Publishes a
    run and returns its number."""
    state = wh.published()
    first, last = wh.calendar(state)
    if _key(start) > first or _key(end) < last:
        raise ValueError(f"the calendar has {first} to {last}: it can only be extended")
    days = wh.attempt("gold/dim_date")
    dim_date(wh.spark, start, end).write.parquet(days)
    return _publish_dims(wh, {**state, "dim_date": days, "calendar": [_key(start), _key(end)]}, {}, now)


def _write_metrics(wh: Warehouse, path: str, report: dict, now_col) -> None:
    """The run's row of run_metrics; what the run did not do is zero."""
    values = {f.name: report.get(f.name, 0) for f in RUN_METRICS.fields} | {"loaded_at": None}
    schema = T.StructType([*RUN_METRICS.fields, RUN_ID])
    row = wh.spark.createDataFrame([(*values.values(), report["run_id"])], schema)
    if now_col is not None:
        row = row.withColumn("loaded_at", now_col)
    row.write.parquet(path)


def bucket_of(key: str, n: int) -> F.Column:
    """The bucket of a key among ``n``, by linear hashing: of the buckets that
    doubling would make, those from ``n`` on are not split off yet."""
    half = 1 << (n.bit_length() - 1)
    if half == n:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(2 * half))
    return F.when(b < n, b).otherwise(b - half).cast("int")


def split_from(n: int, more: int) -> set[int]:
    """The buckets among ``n`` that lose keys when there are ``more``."""
    sources = set()
    for b in range(n, more):
        while b >= n:
            b -= 1 << (b.bit_length() - 1)
        sources.add(b)
    return sources


def _write_buckets(wh: Warehouse, name: str, rows: DataFrame, n: int, entries: list[dict],
                   replaced: Iterable[int]) -> tuple[list[dict], dict]:
    """Write the rows of some buckets of a dimension anew, dealt over ``n``.
    They are those of the ``replaced`` entries; the others stay. Returns the
    dimension's entries (``check_written`` adds the rows of the new ones) and
    the metrics of the write."""
    path = wh.attempt(f"gold/{name}")
    dealt = rows.withColumn("bucket", bucket_of(DIM_KEYS[name], n))
    seen = _write(dealt.hint("rebalance", "bucket") if n > 1 else dealt, path, [
        (F.count_if(F.col(ACTION) != KEEP) if ACTION in rows.columns else F.count(F.lit(1))).alias("affected"),
        F.collect_set("bucket").alias("buckets"),
    ], partition_by="bucket")
    new = [{"path": path, "id": b} for b in seen["buckets"]]
    gone = {*replaced, *seen["buckets"]}
    return sorted([*(e for e in entries if e["id"] not in gone), *new], key=lambda e: e["id"]), seen


def check_written(wh: Warehouse, record: dict, state: dict, checks: Sequence[DataFrame] = ()) -> dict:
    """VAL-2 of the dimension buckets that ``record`` has and ``state`` has not,
    with further ``checks``, in one job; the same job counts the buckets' rows,
    which are put in the record. Raises ``ValidationError`` on any breach."""
    report, new = list(checks), {}
    for name, entries in record["dims"].items():
        new[name] = [e for e in entries if "rows" not in e]
        if not new[name]:
            continue
        written = [e for e in entries if e not in state["dims"][name]]
        rows = wh._read(f"gold/{name}", DIM_TABLES[name], written, leaf="bucket")
        counted = wh._read(f"gold/{name}", T.StructType([BUCKET]), new[name], leaf="bucket")
        report += [V.duplicate_keys(rows, [DIM_KEYS[name]], f"duplicate_{DIM_KEYS[name]}"),
                   counted.groupBy("bucket").count().select(F.concat(F.lit(f"{_ROWS}{name}/"), "bucket").alias("check_name"),
                                                            F.col("count").alias("violations"))]
    found = {r["check_name"]: int(r["violations"]) for r in V.union(report).collect()} if report else {}
    for name, entries in new.items():
        for e in entries:
            e["rows"] = found.pop(f"{_ROWS}{name}/{e['id']}")
    return V.raise_on(found)


_ROWS = "rows of "


def apply_seeds(wh: Warehouse, now: dt.datetime | str, curated: bool = False) -> int:
    """UPS-5 on a live warehouse: sentinels and seed types that are missing
    are inserted, those present stay; with ``curated`` the seed's type rows
    win over stored ones (UPS-4). Publishes a run and returns its number."""
    spark, state = wh.spark, wh.published()
    seed = seeds.event_type_seed(spark)
    if not curated:
        seed = insert_ignore(wh.dim("dim_event_types").select("event_type"), seed, ["event_type"])
    changes = {"dim_event_types": seed_upsert(wh.dim("dim_event_types"), seed, lit_ts(now))}
    for name, rows in (("dim_actors", seeds.actor_sentinel(spark)), ("dim_repos", seeds.repo_sentinel(spark))):
        n, key = state["buckets"][name], DIM_KEYS[name]
        touched = [r[0] for r in rows.select(bucket_of(key, n)).distinct().collect()]
        stored = wh.dim(name, buckets=touched)
        changes[name] = stored.unionByName(insert_ignore(stored.select(key), rows, [key]))
    return _publish_dims(wh, state, changes, now)


def _publish_dims(wh: Warehouse, state: dict, changes: dict[str, DataFrame], now) -> int:
    """A run that only replaces buckets of dimensions. Everything else is
    carried over by name, and its metrics are zero but for the totals."""
    run_id = int(state["run_id"]) + 1
    dims = {name: _write_buckets(wh, name, rows, state["buckets"][name], state["dims"][name], [])[0] for name, rows in changes.items()}
    record = {**state, "run_id": run_id, "dims": {**state["dims"], **dims}}
    check_written(wh, record, state)
    metrics = wh.attempt("gold/run_metrics")
    wm = _as_datetime(state["watermark"])
    _write_metrics(wh, metrics, {"run_id": run_id, "silver_run": state["silver_run"], "watermark_before": wm,
                                 "watermark_after": wm, **_totals(record)}, lit_ts(now))
    record["run_metrics"] = [*state["run_metrics"], {"path": metrics, "id": run_id, "rows": 1}]
    wh.gold_log.commit(state, record)
    return run_id


def _totals(record: dict) -> dict:
    rows = lambda entries: sum(e["rows"] for e in entries)
    return {"total_actors": rows(record["dims"]["dim_actors"]), "total_repos": rows(record["dims"]["dim_repos"]),
            "total_types": rows(record["dims"]["dim_event_types"]), "total_facts": rows(record["fact_events"])}


def _write(df: DataFrame, path: str, metrics: list, partition_by: str | None = None) -> dict:
    """Write ``df``, without the columns that only the metrics need, to a new
    folder and return the metrics of that same pass."""
    obs = Observation(f"w{uuid.uuid4().hex[:12]}")
    observed = df.observe(obs, *metrics)
    writer = observed.drop(ACTION, "long_name").write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return obs.get


def actor_updates(batch: DataFrame) -> DataFrame:
    """Latest (actor_id, actor_login, event_time) per real actor of a batch."""
    real = batch.where(f"actor_id <> {S.UNKNOWN_ACTOR_ID}")
    return latest_by_key(real, ["actor_id"]).selectExpr(
        "actor_id", "actor_login", "event_time AS last_event_time")


def repo_updates(batch: DataFrame) -> DataFrame:
    """Latest repo attributes per real repo of a batch, with owner/project."""
    real = batch.where(f"repo_id <> {S.UNKNOWN_REPO_ID}")
    owner, project = owner_project_sql("repo_name")
    return latest_by_key(real, ["repo_id"]).selectExpr(
        "repo_id", "repo_name", f"{owner} AS repo_owner", f"{project} AS repo_project",
        "org_id", "org_login", "event_time AS last_event_time")


def fact_rows(batch: DataFrame, now, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-4: conformed rows -> fact columns."""
    return batch.withColumn("gold_loaded_at", now).selectExpr(
        "event_id", "date_id", "repo_id", "actor_id", "event_type", "event_hour", "event_time",
        "is_public", "processed_at AS silver_processed_at", "gold_loaded_at", *keep)


def run_gold(
    wh: Warehouse,
    now: dt.datetime | str,
    on_step: Callable[[str], None] | None = None,
) -> dict:
    """Load the next gold run and publish it; returns the run report.

    ``on_step(name)`` is called before each staged step (tests inject
    failures with it).

    The batch is not cached: every consumer re-reads only the new silver runs
    with its own column pruning and the pushed watermark filter (types need
    one column, actors four), which keeps a large daily batch out of executor
    memory. It is read six times: once for each of the four tables and, for
    the ids alone, twice by the facts' insert-ignore.
    """
    t_total = time.perf_counter()
    hook = on_step or (lambda _name: None)

    def step(name: str) -> None:
        describe(spark, f"gold {run_id}: {name}")
        hook(name)

    spark = wh.spark
    state = wh.gold_state()
    if state is None:
        raise RuntimeError("run bootstrap() first")
    prev = int(state["run_id"])
    run_id = prev + 1
    wm = _as_datetime(state["watermark"])
    silver_run = int(wh.silver_state()["run_id"])
    if silver_run <= int(state["silver_run"]):
        return {"run_id": prev, "skipped": True}
    now_col = lit_ts(now)

    # Only the silver runs newer than the last one gold saw are read; the
    # strict watermark filter is the warehouse's rule on top of that.
    view = conform(wh.silver_events(silver_run, after=int(state["silver_run"])))
    batch = view.filter(F.col("processed_at") > lit_ts(wm))
    ms: dict[str, float] = {}

    sizes = dict(state["buckets"])

    def load_dim(name: str, updates: DataFrame) -> tuple[list[dict], dict]:
        # The updates are computed once; the buckets of their keys are learnt
        # from that pass. A dimension has at least as many rows as it had, and
        # as there are updates; it gets a bucket for so many.
        n, key, entries = state["buckets"][name], DIM_KEYS[name], state["dims"][name]
        staged = wh.attempt("gold/_updates")
        seen = _write(updates, staged, [F.count(F.lit(1)).alias("n"), F.collect_set(bucket_of(key, n)).alias("touched")])
        if not seen["n"]:
            return entries, {"affected": 0}
        rows = max(seen["n"], sum(e["rows"] for e in entries))
        sizes[name] = max(n, -(-rows // state.get("bucket_rows", DIM_BUCKET_ROWS)))
        replaced = {*seen["touched"], *split_from(n, sizes[name])}
        newer = spark.read.schema(updates.schema).parquet(staged)
        stored = wh.dim(name, prev, sorted(replaced))
        out = _write_buckets(wh, name, upsert_if_newer(stored, newer, key, now_col), sizes[name], entries, replaced)
        wh.fs.delete(staged)
        return out

    def load_types() -> tuple[list[dict], dict]:
        # Discovery over the batch equals discovery over the whole view:
        # every conformed row enters exactly one gold batch (and a reset
        # restarts from the epoch), so the earlier rows' types are already
        # in the dimension. This keeps the step O(new rows).
        types = insert_new_types(wh.dim("dim_event_types", prev), batch.select("event_type"), now_col, S.UNKNOWN_EVENT_TYPE)
        return _write_buckets(wh, "dim_event_types", types, state["buckets"]["dim_event_types"],
                              state["dims"]["dim_event_types"], [])

    facts_path = wh.attempt("gold/fact_events")
    days = wh.calendar(state)
    known = wh.fact_ids.entries(state, [wh.facts(state)])

    def load_facts() -> dict:
        named = batch.withColumn("long_name", F.greatest(*(
            F.coalesce(F.length(c) > n, F.lit(False)) for c, n in S.GOLD_LENGTH_LIMITS.items())))
        staged = wh.attempt("gold/_new")
        once = only_new(wh.fact_ids, known, named, staged, ["processed_at ASC", "event_time ASC"])
        new = fact_rows(once, now_col, ("long_name",)).withColumn("run_id", F.lit(run_id))
        new = new.hint("rebalance", "date_id").sortWithinPartitions("date_id", "repo_id", "event_time")
        seen = _write(new.select(*FACT_COLUMNS, "run_id", "long_name"), facts_path, [
            F.count(F.lit(1)).alias("inserted"),
            F.max("silver_processed_at").alias("max_processed"),
            F.count_if("long_name").alias("long_names"),
            # VAL-1 for date_id without a join: dim_date is every calendar
            # day of its range, so a derived key is present iff in range.
            F.count_if(~F.col("date_id").between(*days)).alias("fk_date_id"),
            F.count_if((F.col("event_hour") < 0) | (F.col("event_hour") > 23)).alias("range_event_hour"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in _FACT_NOT_NULL],
        ], partition_by="date_id")
        wh.fs.delete(staged)
        if not seen["inserted"]:
            return {**seen, "ids": known, "rollups": rolled}
        stored = spark.read.schema(S.FACT_EVENTS).option("basePath", facts_path).parquet(facts_path)
        kept = run_concurrently(spark, f"gold {run_id}", {
            "fact ids": lambda: wh.fact_ids.write(stored, int(seen["inserted"]), run_id),
            "rollups": lambda: load_rollups(stored, int(seen["inserted"]))})
        return {**seen, "ids": [*known, kept["fact ids"]], "rollups": [*rolled, kept["rollups"]]}

    def load_rollups(facts: DataFrame, rows: int, number: int = run_id) -> dict:
        path = wh.attempt("gold/rollups")
        R.write(R.rollups(facts), path)
        return {"path": path, "id": number, "rows": rows}

    # Facts from before runs wrote aggregates get theirs once.
    rolled = state.get("rollups")
    if rolled is None:
        rolled = [load_rollups(wh.facts(state), sum(e["rows"] for e in state["fact_events"]), prev)] if state["fact_events"] else []

    # The four staged writes are independent Spark jobs over the new silver
    # runs; submitting them together overlaps their scheduling latency and
    # lets small jobs share the cluster. Any failure stops the run before the
    # commit record, exactly as a sequential run would.
    loads = {"actors": lambda: load_dim("dim_actors", actor_updates(batch)),
             "repos": lambda: load_dim("dim_repos", repo_updates(batch)), "types": load_types, "facts": load_facts}
    for name in loads:
        step(name)
    out = run_concurrently(spark, f"gold {run_id}", loads, ms)
    (actors, a), (repos, r), (types, ty), f = out["actors"], out["repos"], out["types"], out["facts"]
    inserted = int(f.get("inserted") or 0)

    record = {**state, "run_id": run_id, "silver_run": silver_run, "ids": f["ids"], "rollups": f["rollups"], "buckets": sizes,
              "dims": {"dim_actors": actors, "dim_repos": repos, "dim_event_types": types}}
    if inserted:
        record["fact_events"] = [*state["fact_events"], {"path": facts_path, "id": run_id, "rows": inserted}]

    step("validate")
    t = time.perf_counter()
    V.raise_on({k: int(v) for k, v in f.items() if k.startswith(("fk_", "range_", "null_"))})
    validate_staged(wh, facts_path if inserted else None, record, state)
    ms["validate"] = time.perf_counter() - t

    wm_after = wm
    if f.get("max_processed") is not None:
        wm_after = max(wm, _as_datetime(f["max_processed"]))
    report = {
        "run_id": run_id, "silver_run": silver_run,
        "watermark_before": wm, "watermark_after": wm_after,
        "actors_affected": int(a["affected"]), "repos_affected": int(r["affected"]),
        "types_inserted": int(ty["affected"]), "facts_inserted": inserted,
        "long_names": int(f.get("long_names") or 0), **_totals(record),
        **{f"ms_{k}": int(v * 1000) for k, v in ms.items()},
    }
    report["ms_total"] = int((time.perf_counter() - t_total) * 1000)
    describe(spark, f"gold {run_id}: metrics")
    metrics = wh.attempt("gold/run_metrics")
    _write_metrics(wh, metrics, report, now_col)
    record["watermark"] = _fmt(wm_after)
    record["run_metrics"] = [*state["run_metrics"], {"path": metrics, "id": run_id, "rows": 1}]
    wh.gold_log.commit(state, record)
    report["skipped"] = False
    return report


_FACT_NOT_NULL = ["event_id", "repo_id", "actor_id", "event_type", "event_time", "silver_processed_at"]


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def validate_staged(wh: Warehouse, facts_path: str | None, record: dict, state: dict) -> dict:
    """VAL-1 (dimension keys) and VAL-2 (all primary keys) on what the run
    wrote, in one job.

    Raises ``ValidationError`` on any breach. Everything is read back from
    disk, so the check sees exactly what would be published. Fact ids
    published before were excluded by the insert-ignore; here the run's own
    are checked.
    """
    checks = []
    if facts_path is not None:
        schema = T.StructType([*S.FACT_EVENTS.fields, RUN_ID])
        facts = wh.spark.read.schema(schema).option("basePath", facts_path).parquet(facts_path)
        dims = {name: wh._read(f"gold/{name}", DIM_TABLES[name], entries, leaf="bucket") for name, entries in record["dims"].items()}
        checks = [V.fk_violations(facts, {
            "fk_actor_id": (dims["dim_actors"], "actor_id"),
            "fk_repo_id": (dims["dim_repos"], "repo_id"),
            "fk_event_type": (dims["dim_event_types"], "event_type"),
        }), V.duplicate_keys(facts, ["event_id"], "duplicate_event_id")]
    return check_written(wh, record, state, checks)


def curate(wh: Warehouse, curated: DataFrame, now: dt.datetime | str) -> int:
    """UPS-4 as an operation: apply curated rows (the seed's columns) to the
    published event-type dimension and publish the result as a new run. Rows
    that repeat a type are refused."""
    V.assert_clean(V.duplicate_keys(curated, ["event_type"], "duplicate_event_type"))
    state = wh.published()
    return _publish_dims(wh, state, {"dim_event_types": seed_upsert(wh.dim("dim_event_types"), curated, lit_ts(now))}, now)
