"""Property: any event stream, split into any arrival batches, gives the gold
state a one-shot computation gives (first arrival per id; latest row per
actor by event time, earliest batch on equal times, then highest id)."""

import datetime as dt
import json
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventlake.plans.bronze import ingest_batch
from eventlake.plans.gold import bootstrap, run_gold
from eventlake.plans.silver import run_silver
from eventlake.plans.warehouse import Warehouse

UTC = dt.timezone.utc
TIMES = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "2024-01-02T05:00:00Z", "2024-01-03T10:00:00Z"]

event = st.fixed_dictionaries({
    "id": st.integers(1, 25),
    "actor": st.integers(1, 4),
    "login": st.sampled_from(["a", "b", "c", "d"]),
    "t": st.sampled_from(TIMES),
})


@st.composite
def streams(draw):
    events = draw(st.lists(event, min_size=1, max_size=30))
    cuts = sorted(set(draw(st.lists(st.integers(1, max(1, len(events) - 1)), max_size=2))))
    bounds = [0, *[c for c in cuts if 0 < c < len(events)], len(events)]
    return [events[a:b] for a, b in zip(bounds, bounds[1:]) if b > a]


def oracle(batches):
    seen, kept = set(), []
    for b, batch in enumerate(batches, start=1):
        for e in batch:
            if e["id"] not in seen:
                seen.add(e["id"])
                kept.append((b, e))
    best = {}
    for b, e in kept:
        rank = (e["t"], -b, str(e["id"]))
        if e["actor"] not in best or rank > best[e["actor"]][0]:
            best[e["actor"]] = (rank, e["login"])
    return {str(e["id"]) for _, e in kept}, {a: v[1] for a, v in best.items()}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=streams())
def test_incremental_equals_one_shot(spark, tmp_path, batches):
    wh = Warehouse(spark, str(tmp_path / uuid.uuid4().hex))
    bootstrap(wh)
    for n, batch in enumerate(batches, start=1):
        lines = [json.dumps({"id": str(e["id"]), "type": "PushEvent",
                             "actor": {"id": e["actor"], "login": e["login"]},
                             "repo": {"id": 10, "name": "o/p"}, "created_at": e["t"]}) for e in batch]
        df = spark.createDataFrame([(v, "f", i) for i, v in enumerate(lines)],
                                   "value string, arrival_file string, arrival_pos long")
        at = dt.datetime(2024, 2, 1, tzinfo=UTC) + dt.timedelta(hours=n)
        ingest_batch(wh, df, batch_id=n, now=at)
        run_silver(wh, at + dt.timedelta(minutes=10))
        run_gold(wh, at + dt.timedelta(minutes=20))
    want_facts, want_actors = oracle(batches)
    assert {r["event_id"] for r in wh.facts().collect()} == want_facts
    got = {r["actor_id"]: r["actor_login"] for r in wh.dim("dim_actors").collect() if r["actor_id"] != -1}
    assert got == want_actors
