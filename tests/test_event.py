"""Event de-duplication against a plain Python statement of the rules."""

import random
from collections import Counter, defaultdict

import pytest
from samples import documents, line, order, visit

from turnstile.operators import event as EV
from turnstile.operators.quality import event as QE


def random_docs(seed, n=60):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        lines = []
        for j in range(rng.randint(0, 4)):
            if rng.random() < 0.1:
                lines.append(line(j))
                continue
            day = f"2026-03-{rng.randint(1, 4):02d}"
            lines.append(
                line(
                    j,
                    event=visit(
                        day,
                        schedule=rng.choice([None, 1, 2, 3]),
                        event=rng.choice([None, 7, 8, 9, 100 + rng.randint(0, 30)]),
                        end=f"{rng.randint(11, 14)}:00:00",
                        name=rng.choice("abc"),
                    ),
                )
            )
        docs.append(order(i, lines=lines))
    return docs


def brute(docs):
    rows = []
    for d in docs:
        for li in d["lineItems"]:
            if li["event"]:
                s = li["event"]["schedule"]
                rows.append(((s["id"], s["date"]), li["event"]["id"], li["event"]["name"], s["endTime"], d["id"]))
    ids, places = defaultdict(set), defaultdict(set)
    for sched, event, *_ in rows:
        if event is not None:
            ids[sched].add(event)
            places[event].add(sched)
    groups = defaultdict(list)
    for r in rows:
        sched, event = r[:2]
        own = event is None or len(ids[sched]) > 1 or len(places[event]) > 1
        groups[("S", sched) if own else ("E", event)].append(r)
    out = []
    for members in groups.values():
        counts = Counter(m[1] for m in members)
        best = min(counts, key=lambda e: (-counts[e], e is not None, e or 0))
        out.append((members[0][0], best, min(m[2] for m in members), max(m[3] for m in members), min(m[4] for m in members)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, tmp_path, seed):
    docs = random_docs(seed)
    rows = EV.event_transform(documents(spark, tmp_path / "d", docs)).collect()
    got = [
        (
            (r.schedule_id, str(r.event_date)),
            r.event_id,
            r.event_name,
            r.event_end.strftime("%Y-%m-%dT%H:%M:%SZ"),
            r.order_id,
        )
        for r in rows
    ]
    assert sorted(got, key=repr) == brute(docs)
    assert len({r.event_surrogate_key for r in rows}) == len(rows)


def test_strict_is_unique_at_grain_and_idempotent(spark, tmp_path):
    raw = documents(spark, tmp_path / "d", [order(1, lines=[line(1, event=visit("2026-03-01", event=None)), line(2, event=visit("2026-03-01", event=5))])])
    assert EV.repeated(EV.event_transform(raw)).count() == 1
    strict = EV.event_transform(raw, strict=True)
    assert EV.repeated(strict).isEmpty() and strict.first().event_id == 5
    assert EV.event_upsert(strict, strict).collect() == strict.collect()


def test_latest_end(spark, tmp_path):
    lines = [line(i, event=visit("2026-03-01", event=i, end=e)) for i, e in ((3, "12:00:00"), (2, "13:00:00"), (1, "13:00:00"))]
    (row,) = EV.event_latest_end(documents(spark, tmp_path / "d", [order(1, lines=lines)])).collect()
    assert (row.raw_event_id, row.event_end.hour) == (1, 13)


def test_checks_fire(spark, tmp_path):
    raw = documents(spark, tmp_path / "d", [order(1, lines=[line(1, event=visit("2026-03-01", 1, 5)), line(2, event=visit("2026-03-01", 2, 5))])])
    event = EV.event_transform(raw)
    merged = event.filter("schedule_id = 1").unionByName(event.filter("schedule_id = 1").selectExpr(*[f"'other' AS {c}" if c == "event_name" else c for c in event.columns]))
    nobody = event.limit(1).selectExpr(*[f"NULL AS {c}" if c in EV.GRAIN else c for c in event.columns])
    tables = {"event": merged.unionByName(nobody), "raw": raw}
    frame = lambda name: [tuple(r) for r in QE.SUITE.frame(name, tables).collect()]
    assert frame("duplicates")[0][-1] == 2
    assert [r[0] for r in frame("missing")] == [2]
    assert frame("attributes") == [(1, 2, 1, 1, 1)]
    assert len(frame("null_identity")) == 1
    clean = {"event": event.filter("schedule_id = 1"), "raw": raw}
    assert [tuple(r) for r in QE.SUITE.frame("guard", clean).collect()] == [(5, 1)]


def test_table_without_guard_is_found(spark, tmp_path):
    """Id 5 on two schedules becomes one event there, which the guard check names; ids 6 and 7 share a schedule."""
    seen = [("2026-03-01", 1, 5), ("2026-03-02", 2, 5), ("2026-03-03", 3, 6), ("2026-03-03", 3, 7), ("2026-03-04", 4, None)]
    raw = documents(spark, tmp_path / "d", [order(1, lines=[line(i, event=visit(*v)) for i, v in enumerate(seen)])])
    guard = lambda event: [tuple(r) for r in QE.SUITE.frame("guard", {"event": event, "raw": raw}).collect()]
    trusting = EV.event_transform(raw, guard=False)
    assert sorted((r.event_id or 0, r.schedule_id) for r in trusting.collect()) == [(0, 4), (5, 1), (6, 3), (7, 3)]
    assert guard(trusting) == [(5, 1)] and guard(EV.event_transform(raw)) == []
