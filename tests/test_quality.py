import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import documents, line, order, rate, visit

from turnstile.functions import text
from turnstile.operators import contact as C
from turnstile.operators import event as EV
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.quality import contact as QC
from turnstile.operators.quality import event as QE
from turnstile.operators.quality import line_items as QL
from turnstile.operators.quality import orders as QO
from turnstile.operators.quality.report import FrameCheck, gate, gate_verdict
from turnstile.operators.upsert import TableAssertion
from turnstile.sources.tables import audit_append, audit_log


def tables(spark, folder, docs):
    raw = documents(spark, folder, docs)
    return {
        "raw": raw,
        "orders": O.orders_transform(raw),
        "items": LI.line_items_transform(raw),
        "contact": C.contact_transform(raw),
    }


def by_test(report):
    out = {}
    for r in report.collect():
        out.setdefault(r.test_name.split(".")[0].split(" ")[0], []).append((r.severity, json.loads(r.result_json)))
    return out


CLEAN = order(1, lines=[line(1, rates=[rate("Group", 1)])], primaryContact={"id": 1, "email": "a@b.co"})
BAD = order(
    2,
    modified="2026-01-01T00:00:00Z",
    status="Strange",
    total=500.0,
    lines=[line(2, rates=[rate("Group", 2, sub="-3.00", serials=["s", " s"])])],
    primaryContact={"id": 1, "email": "nope"},
)


def test_orders_report(spark, tmp_path):
    t = tables(spark, tmp_path / "d", [CLEAN, BAD])
    got = by_test(QO.SUITE.report(t))
    assert got["1"] == [("INFO", {"total_rows": 2, "null_order_id": 0, "null_created_date": 0, "null_modified_date": 0, "null_total": 0, "null_subtotal": 0, "null_tax_total": 0, "null_discount_total": 0, "null_gratuity_total": 0, "null_or_empty_currency": 0})]
    assert [x[1]["order_id"] for x in got["3"]] == [2] and got["5"][0][1]["status"] == "Strange"
    ((severity, money),) = got["6"]
    assert severity == "ERROR" and (money["fee_residual"], money["delta_model_b"]) == (489.2, 489.2)
    assert got["9A"][0][1]["sum_total"] == 510.8
    with pytest.raises(TableAssertion):
        gate(QO.SUITE.report(t), "orders")
    gate(QO.SUITE.report(tables(spark, tmp_path / "e", [CLEAN])), "orders")


@pytest.mark.parametrize(
    "total, offends",
    [(10.8, False), (9.8, False), (11.8, False), (11.72, False), (60.8, False), (60.81, True), (10.7, False), (9.69, True)],
)
def test_price_models(spark, tmp_path, total, offends):
    doc = order(1, total=total, discountTotal=1.0)
    found = QO.SUITE.frame("financial", tables(spark, tmp_path / "d", [doc])).count()
    assert found == offends


def test_one_pass_report_equals_single_checks(spark, tmp_path):
    t = tables(spark, tmp_path / "d", [CLEAN, BAD])
    for suite in (QO.SUITE, QL.SUITE, QC.SUITE):
        report = suite.report(t)
        for name in suite.checks:
            label = suite.labels[name][1]
            rows = report.filter(report.test_name == label).count()
            assert rows == suite.frame(name, t).count(), (suite.table, name)


def test_line_item_checks(spark, tmp_path):
    t = tables(spark, tmp_path / "d", [CLEAN, BAD])
    got = by_test(QL.SUITE.report(t))
    assert got["5"][0][1]["line_item_subtotal"] == -3.0
    assert got["6"][0][1] == {"line_items_affected": 1, "orders_affected": 1, "max_abs_delta": 23.0}
    assert got["7"][0][1]["serials"] == "s, s"
    half = {**t, "items": t["items"].filter("order_id = 1")}
    assert [r.li_key for r in QL.missing_keys(half).collect()] == ["O:2|LI:2|RT:Group"]
    assert QL.extra_keys({**t, "raw": t["raw"].filter("id = 1")}).count() == 1
    doubled = {**t, "items": t["items"].unionByName(t["items"])}
    assert QL.table_duplicates(doubled).isEmpty() and QL.table_duplicates(doubled, strict=True).count() == 2


def test_contact_checks(spark, tmp_path):
    t = tables(spark, tmp_path / "d", [CLEAN, BAD, order(3)])
    got = by_test(QC.SUITE.report(t))
    assert got["4"][0][1]["unknown_rows"] == 1
    assert got["6A"][0][1]["bad_email_rows"] == 1 and got["6A"][0][1]["affected_orders"] == 1
    assert got["8A"][0][1] == {"distinct_primary_contact_ids_with_dups": 1, "total_rows_involved": 2, "max_dup_count": 2}
    wrong = t["contact"].selectExpr(*["NOT is_unknown_contact AS is_unknown_contact" if c == "is_unknown_contact" else c for c in t["contact"].columns])
    assert QC.SUITE.frame("flag", {"contact": wrong}).count() == 3


def test_gate_label_is_case_sensitive_unless_strict(spark):
    report = spark.createDataFrame([("Error", "t", "{}")], "severity string, test_name string, result_json string")
    gate(report, "event")
    with pytest.raises(TableAssertion):
        gate(report, "event", strict=True)
    assert gate_verdict(report, "event").first().passed


def _lines(suite, tables):
    """What the checks find one by one, as report lines."""
    out = Counter()
    for name in suite.checks:
        rows = suite.frame(name, tables).select(text.json_text(F.struct("*")).alias("j")).collect()
        out.update((*suite.labels[name], r.j) for r in rows)
    return out


@pytest.fixture(scope="module")
def broken(spark, tmp_path_factory):
    """Tables with repeats, gaps, NULL keys and NULL parts of keys on every side."""
    home = tmp_path_factory.mktemp("broken")
    docs = [
        order(i, lines=[line(10 * i, rates=[rate("Group", 2, sub="5.00"), rate(None)], event=visit("2026-03-20", schedule=i % 3 or None, event=i % 2))], primaryContact={"id": i % 4, "email": ["a@b.co", " A@b.co", "bad", None][i % 4], "firstName": "x"})
        for i in range(1, 12)
    ]
    docs.append({k: v for k, v in order(99).items() if k != "id"} | {"isWebOrder": True, "status": "Odd Status"})
    raw = documents(spark, home, docs)
    known = raw.filter("id is null or id % 5 > 0")
    tables = {
        "orders": O.orders_transform(known).union(O.orders_transform(known.filter("id is null or id < 4"))),
        "items": LI.line_items_transform(raw.filter("id % 3 > 0")),
        "contact": C.contact_transform(known).union(C.contact_transform(known.filter("id is null or id = 7"))),
        "event": EV.event_transform(known).union(EV.event_transform(known.filter("id = 4"))),
    }
    return {**tables, "raw": raw}


@pytest.mark.parametrize("suite", [QO.SUITE, QL.SUITE, QC.SUITE, QE.SUITE], ids=lambda s: s.table)
def test_report_finds_what_single_checks_find(broken, suite):
    for tables in (broken, {n: df.limit(0) for n, df in broken.items()}):
        assert Counter(map(tuple, suite.report(tables).collect())) == _lines(suite, tables)


@pytest.mark.parametrize("suite", [QO.SUITE, QL.SUITE, QC.SUITE, QE.SUITE], ids=lambda s: s.table)
def test_report_scans_a_table_twice_at_most(spark, broken, suite, tmp_path):
    stored = {}
    for name, df in broken.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    plan = suite.report(stored)._jdf.queryExecution().optimizedPlan().toString()
    apart = [n for n, c in suite.checks.items() if isinstance(c, FrameCheck) and n not in suite.fused and n not in suite.silent]
    scans = sum("Relation [" in row and row.rstrip().endswith("parquet") for row in plan.splitlines())
    # each table for its keys, one of them for its totals too, and what can't share
    assert 2 <= scans <= len(stored) + 1 + 2 * len(apart)


def test_audit_runs_can_be_repeated(spark, broken, tmp_path):
    path, day = str(tmp_path / "log"), dt.datetime(2026, 3, 3, tzinfo=dt.timezone.utc)
    report = QC.SUITE.report(broken)
    for _ in range(2):
        audit_append(report, "primary_contact", path, day)
    audit_append(report, "primary_contact", path, day + dt.timedelta(days=1))
    audit_append(report, "other", path, day)
    lines = _lines(QC.SUITE, broken)
    got = audit_log(spark, path, "primary_contact", day).collect()
    assert Counter((r.severity, r.test_name, r.result_json) for r in got) == lines
    assert audit_log(spark, path).count() == 3 * sum(lines.values())
