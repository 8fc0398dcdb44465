"""Order documents derived from flat star-schema tables (orders, lineitem, customer, part).

A document carries one order head and at most one line: a line joins its head and
becomes a one-element array, so no order is ever gathered into a single row however
many lines it has. An order without lines gives a document with an empty array.
Operators cannot tell the difference from documents with longer arrays, and only
the parts named in ``fields`` are built, so scans stay narrow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.fixed import TICKET_TYPES
from turnstile.session import prepare
from turnstile.sources import schema as S
from turnstile.sources.history import history_merge
from turnstile.sources.passes import Part

OFFICES = ("Online Sales", "Front Desk", "Plaza Booth", "Back Office", "Retail")
STATUSES = (
    "Cancelled",
    "Void",
    "Voided",
    "Return Pending",
    "ReturnProcessed",
    "Refunded",
    None,
    "Wait/Hold",
    "Paid",
    "Unlisted",
)
CURRENCIES = ("USD", "$", "US$", "usd ", "CA$", None, "Australian Dollar", "U.S.D.")
RATES = TICKET_TYPES + ("Group", None)
FIRST_RUN = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
SECOND_RUN = dt.datetime(2002, 1, 2, tzinfo=dt.timezone.utc)


# Driver tables. A declared schema saves a footer-reading job per scan.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
    " props STRING",
}
SPREAD = "spark.turnstile.spread"
LOCAL_TIMES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


ORDER_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str, share: bool = False, part: Part | None = None) -> DataFrame:
    """One driver table with its local timestamp read as a UTC instant; of orders and lines those of the pass."""
    df = prepare(spark).read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if part and name in ORDER_KEYS:
        df = df.filter(part(ORDER_KEYS[name]))
    if share:
        df = spread(df)
    at = LOCAL_TIMES.get(name)
    return df.withColumn(at, F.col(at).cast("timestamp")) if at else df


def spread(df: DataFrame) -> DataFrame:
    """Share a table out over as many parts as the session asks for; as it is where it asks for none.

    One Parquet row group is one task, and building documents costs far more than moving
    the few columns it needs. The local bench has tables of one row group and sets
    SPREAD; a cluster leaves it out and reads tables of many files as they come.
    """
    parts = int(df.sparkSession.conf.get(SPREAD, "0"))
    return df.repartition(parts) if parts else df


def listing(values: tuple, index: str, default: str | None = None) -> str:
    """SQL for values[index] from a constant array; NULL or the default beyond its end."""
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    found = f"get(array({items}), int({index}))"
    return found if default is None else f"IF({index} < {len(values)}, {found}, '{default}')"


def shape(kind: T.StructType, parts: dict) -> str:
    """SQL for a struct of the wanted schema from a tree of expressions."""
    inner = ", ".join(
        f"'{f.name}', "
        + (
            shape(f.dataType, parts[f.name])
            if isinstance(parts[f.name], dict)
            else f"CAST({parts[f.name]} AS {f.dataType.simpleString()})"
        )
        for f in kind.fields
    )
    return f"named_struct({inner})"


def fields_sql(fields: list[T.StructField], parts: dict) -> list[str]:
    return [
        (
            shape(f.dataType, parts[f.name])
            if isinstance(parts[f.name], dict)
            else f"CAST({parts[f.name]} AS {f.dataType.simpleString()})"
        )
        + f" AS {f.name}"
        for f in fields
    ]


# Order-head expressions. Doubles become fixed-point before any arithmetic.
_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
_SUB = f"ROUND({_PRICE} * 0.8BD, 2)"
_TAX = f"IF(o_orderkey % 8 = 6, 0.00BD, ROUND({_SUB} * 0.08BD, 2))"
_OFF = f"ROUND({_SUB} * 0.05BD, 2)"
_TIP = "IF(o_orderkey % 3 = 0, 1BD, 0BD)"
_TOTAL = f"""({_SUB} + {_TAX} + CASE o_orderkey % 8
    WHEN 0 THEN {_TIP} - {_OFF}
    WHEN 1 THEN {_TIP}
    WHEN 2 THEN {_TIP} + {_OFF}
    WHEN 3 THEN {_OFF} - ROUND({_OFF} * 0.08BD, 2)
    WHEN 4 THEN {_TIP} + 7.50BD
    ELSE {_TIP} + {_OFF} + 99BD END)"""
_CHANGED = """CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN o_orderdate
    ELSE timestampadd(HOUR, 24 + o_orderkey % 24, o_orderdate) END"""
HEAD = {
    "id": "o_orderkey",
    "createdDate": "timestampadd(MINUTE, (o_orderkey % 24) * 60 + o_orderkey % 60, o_orderdate)",
    "modifiedDate": _CHANGED,
    "status": listing(STATUSES, "o_orderkey % 20", "Active"),
    "conceirgeId": "NULL",
    "salesOfficeId": "substr(o_orderpriority, 1, 1)",
    "salesOfficeName": listing(OFFICES, "int(substr(o_orderpriority, 1, 1)) - 1"),
    "salesPersonId": "o_custkey % 10",
    "salesPersonFirstName": "concat('First', o_custkey % 10)",
    "salesPersonLastName": "concat('Last', o_custkey % 10)",
    "isWebOrder": "substr(o_orderpriority, 1, 1) = '1' OR o_orderkey % 11 = 0",
    "currencyName": listing(CURRENCIES, "o_orderkey % 8"),
    "total": _TOTAL,
    "subTotal": _SUB,
    "taxTotal": _TAX,
    "discountTotal": _OFF,
    "gratuityTotal": _TIP,
    "variableFeeTotal": "0",
    "orderUrl": "concat('/orders/', o_orderkey)",
    "contactGroupId": "c_nationkey",
    "contactGroupName": "c_mktsegment",
    "questions": "IF(o_orderkey % 2 = 0, '[]', "
    "concat('[{\"question\":\"q\",\"answer\":\"', o_orderkey, '\"}]'))",
    "primaryContact": {
        "id": "o_custkey",
        "firstName": "IF(o_custkey % 9 = 0, '', ' Ann ')",
        "lastName": "IF(o_custkey % 9 = 0, '', concat('C', o_custkey, IF(o_custkey % 5 = 0, '\u00a0', '')))",
        "email": "CASE WHEN o_custkey % 9 = 0 THEN "
        + listing((None, "No Email", ""), "(o_custkey DIV 9) % 3")
        + " WHEN o_custkey % 13 = 0 THEN 'bad-mail' ELSE concat(' C', o_custkey, '@Example.COM ') END",
        "phone": "CASE WHEN o_custkey % 9 = 0 THEN NULL WHEN o_custkey % 17 = 0 THEN 'x12'"
        " ELSE concat('(555) ', o_custkey, '-0100 x9') END",
        "billingAddress": {
            "addressLine1": "concat(o_custkey, ' Main St')",
            "addressLine2": "NULL",
            "city": "n_name",
            "province": "r_name",
            "postalCode": "lpad(string(o_custkey), 5, '0')",
            "country": "'US'",
        },
    },
}
# The second delivery changes every tenth order and repeats the others as they were.
SECOND = {
    **HEAD,
    "modifiedDate": f"IF(o_orderkey % 10 = 0, timestampadd(DAY, 1, {_CHANGED}), {_CHANGED})",
    "total": f"({_TOTAL} + IF(o_orderkey % 10 = 0, 1BD, 0BD))",
    "status": f"IF(o_orderkey % 10 = 0, 'Active', {HEAD['status']})",
    "primaryContact": {
        **HEAD["primaryContact"],
        "phone": "IF(o_orderkey % 10 = 0 AND o_custkey % 9 <> 0,"
        f" concat('(555) ', o_custkey, '-0199'), {HEAD['primaryContact']['phone']})",
    },
}

# Line expressions.
_TYPE = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Rate' WHEN 'SMALL' THEN 'Membership'"
    " WHEN 'MEDIUM' THEN 'Product' WHEN 'PROMO' THEN 'GeneralAdmission' END"
)
_ISO = r"yyyy-MM-dd\'T\'HH:mm:ss\'Z\'"
_START = "timestampadd(HOUR, 10 + l_partkey % 3, l_shipdate)"
_END = "timestampadd(HOUR, 11 + l_partkey % 3 + l_suppkey % 3, l_shipdate)"
LINE = {
    "id": "l_orderkey * 10 + l_linenumber",
    "type": _TYPE,
    "typeId": "p_size",
    "name": "concat(IF(l_partkey % 5 = 0, ' ', ''), IF(p_type = 'SMALL', "
    + listing(("New ", "Volunteer ", "Employee ", ""), "l_partkey % 4")
    + ", ''), p_name)",
    "productId": "l_partkey",
    "salesOfficeName": listing(OFFICES, "l_suppkey % 5"),
    "event": {
        "id": "CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_partkey % 50 % 2 = 0 THEN"
        " unix_date(date(l_shipdate)) * 1000L + l_partkey % 50 * 3 + l_partkey % 3 ELSE l_suppkey END",
        "type": "'Admission'",
        "name": "IF(l_partkey % 59 = 0, NULL, concat('Slot ', l_partkey % 50))",
        "schedule": {
            "id": "IF(l_partkey % 59 = 0, NULL, l_partkey % 50)",
            "date": "date_format(l_shipdate, 'yyyy-MM-dd')",
            "startTime": f"date_format({_START}, '{_ISO}')",
            "endTime": f"date_format({_END}, '{_ISO}')",
        },
    },
}


def rate_parts(e: int) -> dict:
    """Rate entry number e of a line."""
    quantity = f"(CAST(l_quantity AS BIGINT) + {e}L)"
    cut = "IF(l_partkey % 17 = 0, CAST(1 - l_discount AS DECIMAL(4,2)), 1.00BD)"
    sub = (
        f"CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * CAST({quantity} AS DECIMAL(10,0)) * {cut}, 2)"
        " * IF(l_partkey % 211 = 0, -1BD, 1BD) AS DECIMAL(18,2))"
    )
    return {
        "rateType": listing(RATES, f"(l_suppkey + {e}) % 8"),
        "price": "CAST(p_retailprice AS DECIMAL(18,2))",
        "taxTotal": f"ROUND({sub} * CAST(l_tax AS DECIMAL(4,2)), 2)",
        "subTotal": sub,
        "quantity": quantity,
        "serials": "IF(l_partkey % 4 = 0, NULL, IF(l_partkey % 13 = 0,"
        " array(concat('S', l_partkey), concat('T', l_suppkey), concat(' S', l_partkey)),"
        " array(concat('S', l_partkey), concat('T', l_suppkey))))",
        "couponAmount": "IF(l_partkey % 19 = 0, 1BD, NULL)",
        "priceOverrideAmount": "0",
    }


def _needs(kind: T.StructType, *names: str) -> bool:
    return any(n in kind.names for n in names)


def _heads(
    spark: SparkSession, sf_dir: str, kind: T.StructType, second: bool, share: bool = False, part: Part | None = None
) -> DataFrame:
    """Order heads of one delivery; dimension tables join only when a field needs them."""
    rows = table(spark, sf_dir, "orders", share, part)
    contact = kind["primaryContact"].dataType if _needs(kind, "primaryContact") else T.StructType()
    if _needs(kind, "contactGroupId", "contactGroupName") or _needs(contact, "billingAddress"):
        people = table(spark, sf_dir, "customer")
        rows = rows.join(people, rows.o_custkey == people.c_custkey, "left")
    if _needs(contact, "billingAddress"):
        nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey, "left")
        rows = rows.join(region, rows.n_regionkey == region.r_regionkey, "left")
    return rows.selectExpr(*fields_sql(_head_fields(kind), SECOND if second else HEAD))


def _head_fields(kind: T.StructType) -> list[T.StructField]:
    return [f for f in kind.fields if f.name != "lineItems"]


def _line_sql(kind: T.StructType) -> str:
    """The wanted parts of one line as a struct."""
    parts = dict(LINE)
    for f in kind.fields:
        if f.name == "rateTypes":
            # 0, 1 or 2 entries.
            one, two = (shape(f.dataType.elementType, rate_parts(e)) for e in (0, 1))
            parts["rateTypes"] = f"slice(array({one}, {two}), 1, int(l_partkey % 3))"
        elif f.name == "event":
            parts["event"] = f"IF(p_type = 'ECONOMY', {shape(f.dataType, LINE['event'])}, NULL)"
    return shape(kind, parts)


def _lines(spark: SparkSession, sf_dir: str, kind: T.ArrayType, part: Part | None = None) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", share=True, part=part)
    line = kind.elementType
    if _needs(line, "type", "typeId", "name", "event", "rateTypes"):
        goods = table(spark, sf_dir, "part")
        rows = rows.join(goods, rows.l_partkey == goods.p_partkey, "left")
    return rows.selectExpr("l_orderkey AS _order", f"array({_line_sql(line)}) AS lineItems")


def _attach(heads: DataFrame, lines: DataFrame, names: list[str], keep_empty: bool) -> DataFrame:
    """Lines joined to their heads, and heads without lines beside them when kept.

    An outer join could not split an order that holds a third of all lines; the inner
    join can, and heads without lines come from an anti join on distinct keys.
    """
    joined = heads.join(lines, heads.id == lines._order).select(*names)
    if not keep_empty:
        return joined
    alone = heads.join(lines.select("_order").distinct(), F.col("id") == F.col("_order"), "left_anti")
    empty = F.array().cast(lines.schema["lineItems"].dataType)
    return joined.unionByName(alone.withColumn("lineItems", empty).select(*names))


def documents(
    spark: SparkSession,
    sf_dir: str,
    fields: Iterable[str] | None = None,
    second: bool = False,
    keep_empty: bool = True,
    part: Part | None = None,
) -> DataFrame:
    """One delivery of order documents, holding the wanted fields only; ``part`` says of which orders."""
    kind = S.narrow(S.RAW, fields) if fields else S.RAW
    if "lineItems" not in kind.names:
        return _heads(spark, sf_dir, kind, second, share=True, part=part)
    lines = _lines(spark, sf_dir, kind["lineItems"].dataType, part)
    if kind.names == ["id", "lineItems"] and not keep_empty:
        return lines.select(F.col("_order").alias("id"), "lineItems")
    return _attach(_heads(spark, sf_dir, kind, second, part=part), lines, kind.names, keep_empty)


def history(
    spark: SparkSession, sf_dir: str, fields: Iterable[str] | None = None, part: Part | None = None
) -> DataFrame:
    """Both deliveries merged by version; lines join their heads after the merge.

    Callers drop orders without lines, so heads without lines are not kept when
    lines are wanted.
    """
    kind = S.narrow(S.RAW, set(fields) | {"id", "modifiedDate"}) if fields else S.RAW
    heads = _heads(spark, sf_dir, kind, False, part=part)
    none = heads.filter(F.lit(False)).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.INGESTION]
    )
    first = history_merge(heads, none, FIRST_RUN)
    merged = history_merge(_heads(spark, sf_dir, kind, True, part=part), first, SECOND_RUN)
    if "lineItems" not in kind.names:
        return merged
    lines = _lines(spark, sf_dir, kind["lineItems"].dataType, part)
    return _attach(merged, lines, kind.names + [f.name for f in S.INGESTION], keep_empty=False)
