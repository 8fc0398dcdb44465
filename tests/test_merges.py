import datetime as dt

import pytest
from pyspark.errors import PySparkException
from samples import documents, line, order, rate

from turnstile.operators import contact as C
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.upsert import TableAssertion, enforce, upsert, verdict
from turnstile.sources.history import history_fresh, history_latest, history_merge

T0 = dt.datetime(2026, 3, 4, 1, tzinfo=dt.timezone.utc)
T1 = dt.datetime(2026, 3, 5, 1, tzinfo=dt.timezone.utc)


def frame(spark, rows, schema="k int, a string, b string"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_inserts_refreshes_and_keeps(spark):
    target = frame(spark, [(1, "x", "keep"), (2, "y", "keep"), (3, None, "keep")])
    source = frame(spark, [(1, "x", "new"), (2, "z", "new"), (3, "n", "new"), (4, "q", "new")])
    once = upsert(target, source, ["k"], ["a"])
    assert rows(once) == [(1, "x", "keep"), (2, "z", "keep"), (3, "n", "keep"), (4, "q", "new")]
    assert rows(upsert(once, source, ["k"], ["a"])) == rows(once)


def test_upsert_can_clear_a_value(spark):
    got = upsert(frame(spark, [(1, "x", "p")]), frame(spark, [(1, None, "n")]), ["k"], ["a"])
    assert rows(got) == [(1, None, "p")]


def test_null_keys_match_only_when_null_safe(spark):
    target, source = frame(spark, [(None, "x", "p")]), frame(spark, [(None, "y", "n")])
    assert rows(upsert(target, source, ["k"], ["a"])) == [(None, "x", "p"), (None, "y", "n")]
    assert rows(upsert(target, source, ["k"], ["a"], null_safe=True)) == [(None, "y", "p")]


def test_repeated_source_rows(spark):
    source = frame(spark, [(1, "y", "n"), (1, "z", "n")])
    new = upsert(frame(spark, []), source, ["k"], ["a"])
    assert len(rows(new)) == 2
    with pytest.raises(PySparkException, match="more than one source row"):
        upsert(frame(spark, [(1, "x", "p")]), source, ["k"], ["a"]).collect()


def test_orders_refresh_only_tracked_columns(spark, tmp_path):
    first = O.orders_transform(documents(spark, tmp_path / "a", [order(1), order(2)]))
    later = order(1, modified="2026-04-01T00:00:00Z", status="Void", salesOfficeName="Retail")
    second = O.orders_transform(documents(spark, tmp_path / "b", [later, order(3)]))
    got = {r.order_id: r for r in O.orders_upsert(first, second).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].status, got[1].salesoffice_name) == ("Void", "Front Desk")
    assert got[1].modified_date == first.filter("order_id = 1").first().modified_date


def test_line_items_are_insert_only(spark, tmp_path):
    def load(name, sub, *more):
        docs = [order(1, lines=[line(1, rates=[rate("Group", sub=sub), *more])])]
        return LI.line_items_transform(documents(spark, tmp_path / name, docs))

    first, second = load("a", "10.00"), load("b", "99.00", rate("Under 3"))
    got = {r.rate_type: float(r.line_item_subtotal) for r in LI.line_items_insert(first, second).collect()}
    assert got == {"Group": 10.0, "Under 3": 10.0}


def test_contact_refresh(spark, tmp_path):
    def load(name, email):
        docs = [order(1, primaryContact={"id": 1, "email": email})]
        return C.contact_transform(documents(spark, tmp_path / name, docs))

    got = C.contact_upsert(load("a", "a@b.co"), load("b", "No Email")).collect()
    assert [(r.email, r.is_unknown_contact) for r in got] == [(None, True)]


def test_history_adds_each_version_once(spark, tmp_path):
    first = documents(spark, tmp_path / "a", [order(1), order(2), {**order(3), "modifiedDate": None}])
    none = first.limit(0).selectExpr("*", "CAST(NULL AS TIMESTAMP) ingestion_timestamp", "CAST(NULL AS DATE) ingestion_date")
    hist = history_merge(first, none, T0)
    again = history_merge(first, hist, T1)
    assert hist.count() == 3
    # Only the document without a modification time comes back.
    assert [r.id for r in history_fresh(first, hist, T1).collect()] == [3]
    changed = documents(spark, tmp_path / "b", [order(1, modified="2026-05-01T00:00:00Z", status="Void")])
    third = history_merge(changed, again, T1)
    assert third.filter("id = 1").count() == 2
    latest = {r.id: (r.status, r.ingestion_date) for r in history_latest(third).collect()}
    assert latest == {1: ("Void", dt.date(2026, 3, 4)), 2: ("Active", dt.date(2026, 3, 3)), 3: ("Active", dt.date(2026, 3, 4))}
    assert history_latest(third).count() == 3


def test_enforce_and_verdict(spark):
    bad = frame(spark, [(1, "x", "p")])
    with pytest.raises(TableAssertion, match="no good"):
        enforce(bad, "no good")
    enforce(bad.limit(0), "fine")
    assert tuple(verdict(bad).first()) == (1, False)
    assert tuple(verdict(bad.limit(0)).first()) == (0, True)


def test_repeats_of_the_stored_row_change_nothing(spark):
    target = frame(spark, [(1, "x", "keep"), (2, None, "keep")])
    source = frame(spark, [(1, "x", "n"), (1, "x", "m"), (2, None, "n"), (2, None, "n")])
    assert rows(upsert(target, source, ["k"], ["a"])) == rows(target)
    with pytest.raises(PySparkException, match="more than one source row"):
        upsert(target, frame(spark, [(1, "x", "n"), (1, "y", "n")]), ["k"], ["a"]).collect()
