import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from samples import documents, line, order, rate, visit, write

from turnstile.functions.median import median_many
from turnstile.operators import line_items as LI
from turnstile.operators import orders as O
from turnstile.operators.contact import SCHEMA as CONTACT
from turnstile.operators.contact import contact_masked, contact_transform
from turnstile.operators.quality import line_items as line_checks
from turnstile.operators.quality import orders as order_checks
from turnstile.operators.unnest import unnest_events, unnest_rates
from turnstile.plans import registry
from turnstile.sources import landing
from turnstile.sources import schema as S

DOCS = [
    order(
        1,
        lines=[
            line(11, rates=[rate("Adult (13-64)", 2, serials=["a", None, "b"]), rate(None)], event=visit("2026-03-05")),
            line(12, type="Product", rates=[rate("Group", 3)]),
            line(None, rates=[rate("Under 3")]),
        ],
        surprise={"x": 1},
        questions=[{"question": "q", "answer": None}],
        primaryContact={"id": 5, "firstName": " Ann ", "email": "A@B.Co ", "phone": "(1) 2x", "billingAddress": {"city": " X "}},
    ),
    order(2, lines=[line(21, rates=[])]),
    order(3, lines=[]),
    {k: v for k, v in order(4).items() if k != "lineItems"},
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return documents(spark, tmp_path_factory.mktemp("docs"), DOCS)


def test_scan_drops_unlisted_keys(raw):
    assert raw.columns == S.RAW.names and raw.count() == 4


def test_scan_and_text_parse_agree(spark, raw, tmp_path):
    lines = spark.read.text(write(tmp_path / "t", DOCS)).toDF("line")
    parsed = landing.parse_documents(lines, "line")
    assert parsed.schema == raw.schema
    assert parsed.exceptAll(raw).isEmpty() and raw.exceptAll(parsed).isEmpty()


def test_outer_unnest_keeps_empty_parents(raw):
    rows = unnest_rates(raw)
    assert rows.filter("order_id = 1").count() == 4
    assert [(r.order_id, r.line_item_id, r.rate_type) for r in rows.filter("order_id > 1").orderBy("order_id").collect()] == [
        (2, 21, None), (3, None, None), (4, None, None),
    ]
    assert unnest_rates(raw, outer=False).count() == 4


def test_event_rows_need_a_schedule(raw):
    (row,) = unnest_events(raw).collect()
    assert (row.order_id, row.schedule_id, row.event_date) == (1, 1, dt.date(2026, 3, 5))


def test_line_items(raw):
    rows = LI.line_items_transform(raw)
    assert rows.columns == LI.SCHEMA.names
    got = {(r.line_item_id, r.rate_type): r for r in rows.collect()}
    assert set(got) == {(11, "Adult (13-64)"), (12, "Group")}
    assert got[(11, "Adult (13-64)")].serials == "a,b"
    assert len({r.surrogate_key for r in got.values()}) == 2


def test_repeated_elements_get_their_own_key(spark, tmp_path):
    twin = line(1, rates=[rate("Group"), rate("Group")])
    rows = LI.line_items_transform(documents(spark, tmp_path / "d", [order(1, lines=[twin, twin])]))
    assert rows.count() == 4 == rows.select("surrogate_key").distinct().count()
    assert LI.repeated(rows).first().cnt == 4


def test_narrow_columns_equal_full_columns(raw):
    only = ("order_id", "status", "currency", "question")
    assert O.orders_transform(raw, only).collect() == O.orders_transform(raw).select(*only).collect()
    pick = ("line_item_quantity", "product_id", "surrogate_key")
    assert LI.line_items_transform(raw, pick).collect() == LI.line_items_transform(raw).select(*pick).collect()


def test_orders_question_text(raw):
    got = {r.order_id: r.question for r in O.orders_transform(raw).collect()}
    assert got[1] == '[{"question":"q","answer":null}]' and got[2] == "null"


def test_contact_clean_and_mask(raw):
    rows = contact_transform(raw)
    assert rows.columns == CONTACT.names
    one = rows.filter("order_id = 1").first()
    assert (one.first_name, one.email, one.phone, one.city, one.is_unknown_contact) == ("Ann", "a@b.co", "12x", "X", False)
    assert rows.filter("order_id = 2").first().is_unknown_contact
    hidden = contact_masked(rows).filter("order_id = 1").first()
    assert (hidden.first_name, hidden.email, hidden.phone, hidden.address_line1) == (None, "XXXXX@b.co", "XXX", None)


def test_narrow_schema_reads_only_named_leaves(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    docs = landing.raw_table(spark, path, S.VISIT_FIELDS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = docs._jdf.queryExecution().executedPlan().toString()
    assert "salesOfficeName" in text and "serials" not in text and "primaryContact" not in text
    assert docs.filter("size(lineItems) = 3").count() == 1
    with pytest.raises(ValueError):
        S.narrow(S.RAW, ["nothing"])


def test_backfill_replaces(spark, tmp_path):
    target = str(tmp_path / "out")
    for docs in (DOCS, DOCS[:1]):
        loaded = landing.backfill_load(spark, write(tmp_path / f"in{len(docs)}", docs), target)
    assert [r.id for r in loaded.collect()] == [1]


def test_extract_window_is_local(spark, tmp_path):
    docs = [order(i, created=c) for i, c in enumerate(("2026-03-02T07:59:59Z", "2026-03-02T08:00:00Z", "2026-03-03T08:00:00Z"))]
    raw = documents(spark, tmp_path / "w", docs)
    day = landing.yesterday(dt.date(2026, 3, 3))
    assert [r.id for r in landing.extract_window(raw, *day).collect()] == [1]


def test_questions_keep_unknown_keys(spark, tmp_path):
    asked = [{"id": 7, "label": "Allergies", "value": {"food": ["nuts"]}}]
    row = O.orders_transform(documents(spark, tmp_path, [order(1, questions=asked)])).first()
    assert json.loads(row.question) == asked


def test_question_text_is_one_form(spark, tmp_path):
    """Blanks, nulls and nesting of a document come out alike from file and from text, keys in their order."""
    asked = '[ {"b" : {"z": [1 , null], "a": "x  y"} , "a":null } ]'
    lines = ['{"id": 1, "questions": %s}' % asked, '{"id": 2, "questions": null}', '{"id":3}', '{"id":4,"questions":"text"}']
    (tmp_path / "q.json").write_text("\n".join(lines))
    from_file = landing.raw_scan(spark, str(tmp_path / "q.json"))
    from_text = landing.parse_documents(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    want = {1: '[{"b":{"z":[1,null],"a":"x  y"},"a":null}]', 2: "null", 3: "null", 4: "text"}
    for raw in (from_file, from_text):
        assert {r.order_id: r.question for r in O.orders_transform(raw).collect()} == want


def test_rejects_do_not_end_a_load(spark, tmp_path):
    good = [json.dumps(order(i)) for i in (1, 2)]
    odd = ["{}"]  # a document without any field
    bad = ['{"id": 3, "total": "abc"}', '{"id": 4', "null", "7", '{"id": 5, "lineItems": [{"rateTypes": [{"price": "x"}]}]}', "not json"]
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text("\n".join([good[0], *bad[:3], "", "  "]))
    (source / "b.json").write_text("\n".join([*bad[3:], good[1], *odd]))
    landed = landing.backfill_load(spark, str(source), target)
    assert sorted(str(r.id) for r in landed.collect()) == ["1", "2", "None"]
    rejects = spark.read.parquet(target + "_rejects").collect()
    assert sorted(r.line for r in rejects) == sorted(bad) and {r.file.rsplit("/", 1)[1] for r in rejects} == {"a.json", "b.json"}
    # The next load replaces the rejects too.
    (source / "a.json").write_text(good[0])
    (source / "b.json").write_text(good[1])
    assert landing.backfill_load(spark, str(source), target).count() == 2
    assert spark.read.parquet(target + "_rejects").count() == 0


def test_amounts_of_all_digits_are_read_and_summed(spark, tmp_path):
    """29 whole digits and nine decimals are kept, one digit more is a reject, and sums and checks stay exact."""
    def wide(id, total, sub, tax, price):
        return (
            f'{{"id": {id}, "status": "Active", "total": {total}, "subTotal": {sub}, "taxTotal": {tax}, "discountTotal": 0, "gratuityTotal": 0, '
            f'"lineItems": [{{"id": {id}, "type": "Rate", "rateTypes": [{{"rateType": "Group", "quantity": 3, "price": {price}, "subTotal": {sub}}}]}}]}}'
        )
    most = "9" * 29 + ".123456789"
    lines = [
        wide(1, "1000000000000000008.27", "1000000000000000000.02", "8.25", "333333333333333333.34"),
        wide(2, "1000000000000000108.27", "1000000000000000000.02", "8.25", "333333333333333333.00"),
        wide(3, most, most, "0", "1.000000001"),
        wide(4, "1" + most, "0", "0", "0"),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    raw = landing.backfill_load(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    orders, items = O.orders_transform(raw), LI.line_items_transform(raw)
    assert {r.order_id: str(r.total) for r in orders.collect()} == {
        1: "1000000000000000008.270000000", 2: "1000000000000000108.270000000", 3: most,
    }
    assert spark.read.parquet(str(tmp_path / "out_rejects")).count() == 1
    some = orders.filter("order_id < 3")
    assert str(some.agg(F.sum("total")).first()[0]) == "2000000000000000116.540000000"
    assert str(median_many(some, "total", "m").first().m) == "1000000000000000058.27"
    # 100.00 above what is accounted for: wrong by every model and no plausible fee; order 1 adds up to the cent.
    assert [r.order_id for r in orders.filter(order_checks._mispriced()).collect()] == [2]
    gaps = {r.order_id: str(r.gap) for r in items.filter("order_id < 3").select("order_id", line_checks._price_gap().alias("gap")).collect()}
    assert gaps == {1: "0E-9", 2: "1.020000000"}


def test_several_lines_a_document_as_named_queries_see_them(raw):
    rows = [(r.order_id, r.line_item_id, r.rates) for r in registry._scanned(raw).collect()]
    assert sorted(rows, key=str) == sorted([(1, 11, 2), (1, 12, 1), (1, None, 1), (2, 21, 0), (3, None, None), (4, None, None)], key=str)
