"""Write PLANS.md: the physical plan of every registered query and of the
pipeline's own joins (tree + scan pushdown lines), from explain("formatted").

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text[:text.index("\n(1) ")].replace("== Physical Plan ==\n", "").rstrip()
    keep = [ln for ln in text.splitlines()
            if ln.startswith(("PartitionFilters:", "PushedFilters:", "ReadSchema:"))]
    keep = [re.sub(r"#\d+L?", "", ln)[:200] for ln in keep]
    return tree + "\n" + "\n".join(dict.fromkeys(keep))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from eventlake.operators.conform import conform
    from eventlake.operators.merge import insert_ignore, upsert_if_newer
    from eventlake.plans import gold as G
    from eventlake.plans import rollups as R
    from eventlake.plans.catalog import QUERIES
    from eventlake.plans.layout import clustered
    from eventlake.plans.replay import replayed
    from eventlake.plans.warehouse import lit_ts
    from eventlake.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    wh = replayed(spark, sf_dir)
    batch = conform(wh.silver_events(after=3))
    pipeline = {
        "gold: dim_actors upsert (UPS-1 over DED-3)": upsert_if_newer(
            wh.dim("dim_actors", 3), G.actor_updates(batch), "actor_id", lit_ts("2024-03-01 00:00:00")),
        "gold: fact insert-ignore by the id index (UPS-3)": insert_ignore(
            wh.fact_ids.all(wh.gold_log.of_run(3)["ids"]), G.fact_rows(batch, lit_ts("2024-03-01 00:00:00")), ["event_id"]),
        "bronze: dedupe by the touched buckets of the id index (SNK-1)": insert_ignore(
            wh.bronze_ids.stored(wh.bronze_state()["ids"][:3], [0], 1), wh.bronze_events(after=3).select("event_id"), ["event_id"]),
        "gold: aggregates of a run's facts": R.rollups(wh.facts()),
        "compaction: clustered facts": clustered(wh.facts(), 10_000),
    }
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, tree and scan lines) at `{sf_dir}`,",
           "regenerated by `python tools/plans.py`. Expression ids are stripped.", ""]
    for name, df in [*pipeline.items(), *((n, fn(spark, sf_dir)) for n, fn in QUERIES.items())]:
        out += [f"## {name}", "", "```", summary(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
