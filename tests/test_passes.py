"""Jobs in passes return what one pass returns, and their shuffle files go on the way."""

import datetime as dt
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from turnstile.plans import registry
from turnstile.sources import passes, star
from turnstile.sources.tables import StoredTable, by_number

QUERIES = registry.all_queries()


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, star.TABLES[name]).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def star_tables(spark, tmp_path_factory):
    """80 orders, one twice and one without id; lines of all of them, one twice, of no order and without one."""
    folder = str(tmp_path_factory.mktemp("star"))
    noon = dt.datetime(1997, 6, 30, 12)
    day = dt.timedelta(days=1)
    orders = [(i, i % 7, "O", 100.0 + i, noon + (i % 40 - 30) * day + (i % 5 == 0) * 900 * day, f"{i % 5 + 1}-X") for i in range(80)]
    write(spark, folder, "orders", [*orders, orders[11], (None, 1, "O", 5.0, noon, "1-X")])
    lines = [(i % 80, i % 23, i % 10, i // 80 + 1, 3.0, 9.0, 0.05, 0.08, "N", "O", noon + (i % 50 - 20) * day) for i in range(400)]
    odd = [(k, 2, 3, 1, 3.0, 9.0, 0.05, 0.08, "N", "O", noon) for k in (900, None)]
    write(spark, folder, "lineitem", [*lines, lines[5], *odd])
    kinds = ("ECONOMY", "ECONOMY", "SMALL", "MEDIUM", "PROMO")
    write(spark, folder, "part", [(p, f"part {p}", "B", kinds[p % 5], p, 10.0 + p) for p in range(23)])
    write(spark, folder, "customer", [(c, f"c{c}", c % 3, 1.0, "SEG") for c in range(7)])
    write(spark, folder, "nation", [(n, f"n{n}", 0) for n in range(3)])
    write(spark, folder, "region", [(0, "r")])
    return folder


def rows(df):
    return sorted(map(str, df.collect()))


def shuffle_files(spark):
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in tops for _, _, names in os.walk(top.getPath()) for name in names if re.fullmatch(r"shuffle_.*\.data", name)}


def left_by(spark, work):
    """Shuffle files that work leaves behind; Spark removes them in the background."""
    before, until = shuffle_files(spark), time.time() + 15
    work()
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_ranges_hold_every_id_once(spark, monkeypatch):
    ids = spark.createDataFrame([(i,) for i in [*range(-5, 95), *[7] * 50, None]], "id bigint")
    assert len(passes.passes(ids)) == 1
    monkeypatch.setattr(passes, "ORDERS_PER_PASS", 20)
    parts = passes.passes(ids)
    assert 4 <= len(parts) <= 8
    for value in (-100, -5, 7, 8, 94, 1000, None):
        one = spark.createDataFrame([(value,)], "k bigint")
        assert one.select(sum(F.coalesce(p("k"), F.lit(False)).cast("int") for p in parts)).first()[0] == 1, value
    monkeypatch.setattr(passes, "MOST_PASSES", 3)
    assert len(passes.passes(ids)) <= 3
    nothing = spark.createDataFrame([(None,)] * 50, "id bigint")
    assert len(passes.passes(nothing)) == 1


def test_a_load_of_several_frames_is_one_load(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path), "t", spark.range(1).schema, by_number("id", 10))
    table.write(spark.range(0, 15), spark.range(15, 30))
    assert table.loads() == [1] and rows(table.read()) == rows(spark.range(30))


@pytest.mark.parametrize("name", ["stored_monthly_headcount_by_ticket_type", "latest_revenue_per_visitor", "latest_yesterdays_tickets_sold"])
def test_stored_visits(spark, star_tables, monkeypatch, name):
    monkeypatch.setattr(registry, "_visit_tables", {})
    left = left_by(spark, lambda: registry.stored_visits(spark, star_tables))
    plain = rows(QUERIES[name](spark, star_tables))
    monkeypatch.setattr(passes, "ORDERS_PER_PASS", 15)
    left |= left_by(spark, lambda: registry.stored_visits(spark, f"{star_tables}/"))
    table = registry.stored_visits(spark, f"{star_tables}/")
    assert left == set() and table.versions.loads() == [1, 2] and table.pending() == []
    measure, when = registry.VISIT_MEASURES[name.split("_", 1)[1]]
    hist = star.history(spark, star_tables, registry.S.VISIT_FIELDS)
    wanted = rows(registry.edge(measure(hist, when, name.startswith("latest"))))
    assert rows(QUERIES[name](spark, f"{star_tables}/")) == plain == wanted != []


def test_backfill(spark, star_tables, monkeypatch):
    plain = rows(QUERIES["backfill_load"](spark, star_tables))
    assert plain == rows(QUERIES["raw_scan"](spark, star_tables)) != []
    monkeypatch.setattr(passes, "ORDERS_PER_PASS", 15)
    monkeypatch.setattr(registry, "LINES_PER_FILE", 7)
    monkeypatch.setattr(registry.uuid, "uuid4", lambda: registry.uuid.UUID(int=3))
    made = []
    assert left_by(spark, lambda: made.append(QUERIES["backfill_load"](spark, star_tables))) == set()
    assert rows(made[0]) == plain
    assert sorted(os.listdir(f"{registry.work_folder(spark)}/backfill-{registry.uuid.uuid4().hex}".removeprefix("file:"))) == ["landed", "landed_rejects"]


def test_line_items_insert(spark, star_tables, monkeypatch):
    plain = rows(QUERIES["line_items_insert"](spark, star_tables))
    monkeypatch.setattr(passes, "ORDERS_PER_PASS", 15)
    made = []
    assert left_by(spark, lambda: made.append(QUERIES["line_items_insert"](spark, star_tables))) == set()
    assert rows(made[0]) == plain != []
    # Reading the result moves nothing any more.
    assert left_by(spark, lambda: made[0].write.format("noop").mode("overwrite").save()) == set()


@pytest.mark.parametrize("name", ["dq_report", "dq_gate", "audit_append"])
def test_reports(spark, star_tables, monkeypatch, name):
    plain = rows(QUERIES[name](spark, star_tables))
    monkeypatch.setattr(passes, "ORDERS_PER_PASS", 30)
    made = []
    left = left_by(spark, lambda: made.append(QUERIES[name](spark, star_tables)))
    assert rows(made[0]) == plain != []
    if name == "dq_report":
        assert left == set()


def test_sliced_report_of_nothing(spark, star_tables):
    def empty(df):
        return df.limit(0)

    tables = {name: empty(df) for name, df in registry.stored_tables(spark, star_tables, [lambda _: F.lit(True)]).items()}
    for suite, raw in registry.SUITES:
        given = {**tables, "raw": empty(raw(spark, star_tables))}
        sliced = suite.report(given, 3, lambda frames: passes.kept(spark, frames))
        assert rows(sliced) == rows(suite.report(given))
