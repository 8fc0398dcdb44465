"""Checks as data, one report from many checks, and the stop rule."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import text
from turnstile.operators.upsert import TableAssertion

Tables = Mapping[str, DataFrame]
#: Computes frames of the same columns one after the other; gives all their rows, read back from where they are kept.
Keep = Callable[[Iterable[DataFrame]], DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """Rows of one table that meet a condition, with the columns to report."""

    table: str
    where: Callable[[], Column]
    payload: Callable[[], Sequence[Column]]

    def frame(self, tables: Tables) -> DataFrame:
        return tables[self.table].filter(self.where()).select(*self.payload())


@dataclass(frozen=True)
class TotalCheck:
    """One row of measures over one whole table."""

    table: str
    measures: Callable[[], Sequence[Column]]

    def frame(self, tables: Tables) -> DataFrame:
        return tables[self.table].agg(*self.measures())


@dataclass(frozen=True)
class FrameCheck:
    """Anything that needs its own joins or grouping."""

    build: Callable[[Tables], DataFrame]

    def frame(self, tables: Tables) -> DataFrame:
        return self.build(tables)


Check = RowCheck | TotalCheck | FrameCheck

# Counts that a key gathers; each check says what they are.
COUNTS = ("n0", "n1", "n2", "n3")
AMOUNT = T.DecimalType(38, 9)


@dataclass(frozen=True)
class Side:
    """What the rows of one table add to their key."""

    key: Callable[[], Sequence[Column]]
    counts: Callable[[], Mapping[str, Column]]
    where: Callable[[], Column] | None = None
    amount: Callable[[], Column] | None = None


def one(slot: str) -> Callable[[], Mapping[str, Column]]:
    return lambda: {slot: F.lit(1)}


@dataclass(frozen=True)
class KeyRows:
    """Keys that meet a condition on n0..n3, amount and whole (no part of the key is NULL).

    The report line holds the key and, after it, the extra columns.
    """

    keyed: str
    where: Callable[[], Column]
    extra: Callable[[], Sequence[Column]] = list


@dataclass(frozen=True)
class KeyTotals:
    """One report line over all keys: whole numbers that keys add up to, and the greatest ``most``.

    The payload finds the sums of the parts in n0..n3. A part that no key adds to is NULL;
    the payload says where that means zero.
    """

    keyed: str
    parts: Callable[[], Sequence[Column]]
    payload: Callable[[], Sequence[Column]]
    most: Callable[[], Column] | None = None


def lacks(count: str) -> Column:
    """No row of that side has the key. A key with a NULL part equals none."""
    return (F.col(count) == 0) | ~F.col("whole")


def zero(part: str, name: str) -> Column:
    """A sum of the payload that is zero over nothing."""
    return F.coalesce(F.col(part), F.lit(0)).alias(name)


def distinct_keys(name: str):
    """Parts and payload of a check of surrogate keys: rows, and different keys."""
    return (
        lambda: [F.col("n0"), F.col("whole").cast("long")],
        lambda: [zero("n0", "total_rows"), zero("n1", name)],
    )


@dataclass(frozen=True)
class Suite:
    """Named checks of one table, in report order.

    ``sides`` and ``fused`` say how the report finds what frame checks find: the rows of
    all tables are counted under keys, and several checks read the same counts.
    ``lines`` makes a table's rows out of what a caller passes; ``few`` names the keys that
    are few whatever the number of rows.
    """

    table: str
    labels: Mapping[str, tuple[str, str]]
    checks: Mapping[str, Check] = field(default_factory=dict)
    sides: Mapping[str, Mapping[str, Side]] = field(default_factory=dict)
    fused: Mapping[str, KeyRows | KeyTotals] = field(default_factory=dict)
    silent: frozenset[str] = frozenset()
    lines: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    few: frozenset[str] = frozenset()

    def frame(self, name: str, tables: Tables) -> DataFrame:
        return self.checks[name].frame(tables)

    def report(self, tables: Tables, slices: int = 1, keep: Keep | None = None) -> DataFrame:
        """(severity, test_name, result_json) of every check.

        A table is scanned once for its totals and once for everything else: each row is
        exploded into the lines it reports by itself and the keys it counts for, and one
        aggregate, combined before it moves, counts both. Only checks that neither form
        can say scan for themselves. Checks in ``silent`` can't report anything.

        With ``keep`` each kind of key is counted by itself instead, in slices by its hash, and
        keep gets them one by one: the disk needs room to move one slice of one kind.
        """
        totals: dict[str, dict[str, Check]] = {}
        for name, check in self.checks.items():
            if isinstance(check, TotalCheck):
                totals.setdefault(check.table, {})[name] = check
        parts = [_total_pass(self, tables[t], group) for t, group in totals.items()]
        parts += _slice_pass(self, tables, slices, keep) if keep else [_key_pass(self, tables)]
        for name, check in self.checks.items():
            if isinstance(check, FrameCheck) and name not in self.fused and name not in self.silent:
                line = _entry(self.labels[name], F.struct("*"))
                lines = check.frame(tables).select(line.alias("r")).select("r.*")
                parts.append(keep([lines]) if keep else lines)
        return reduce(DataFrame.unionByName, parts)


def _entry(label: tuple[str, str], payload: Column) -> Column:
    return _line(label, text.json_text(payload))


def _line(label: tuple[str, str], payload: Column) -> Column:
    return F.struct(
        F.lit(label[0]).alias("severity"),
        F.lit(label[1]).alias("test_name"),
        payload.alias("result_json"),
    )


def _key_fields(suite: Suite, tables: Tables) -> dict[str, T.DataType]:
    """Every part of every key of the suite."""
    found: dict[str, T.DataType] = {}
    for sides in suite.sides.values():
        for table, side in sides.items():
            if table in tables:
                found |= {f.name: f.dataType for f in tables[table].select(*side.key()).schema.fields}
    return found


def _exploded(df: DataFrame, made: Sequence[Column]) -> DataFrame:
    """One row for each of the structs that is not NULL. (Dropping them inside the array would
    leave generated code.)"""
    return df.select(F.explode(F.array(*made)).alias("r")).filter("r IS NOT NULL").select("r.*")


def _tags(suite: Suite, table: str, df: DataFrame, fields: Mapping[str, T.DataType]) -> DataFrame | None:
    """Each row's own report lines, and the keys it counts for: keys as they are, text only for lines."""
    names = df.select(*[c for sides in suite.sides.values() if table in sides for c in sides[table].key()]).columns

    def tag(keyed: str, line: Column | None, key: Mapping[str, Column], counts: Mapping[str, Column], amount: Column | None) -> Column:
        return F.struct(
            F.lit(keyed).alias("keyed"),
            (F.lit(None) if line is None else line).cast("string").alias("line"),
            *[key.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields.items()],
            *[counts.get(n, F.lit(0)).cast("long").alias(n) for n in COUNTS],
            (F.lit(None) if amount is None else amount).cast(AMOUNT).alias("amount"),
        )

    tags = []
    for name, check in suite.checks.items():
        if isinstance(check, RowCheck) and check.table == table:
            line = text.json_text(F.struct(*check.payload()))
            tags.append(F.when(check.where(), tag(f"row {name}", line, {}, {"n0": F.lit(1)}, None)))
    for keyed, sides in suite.sides.items():
        if side := sides.get(table):
            parts = side.key()
            key = dict(zip(names, parts, strict=False))
            names = names[len(parts) :]
            one_tag = tag(keyed, None, key, side.counts(), side.amount and side.amount())
            tags.append(F.when(side.where(), one_tag) if side.where else one_tag)
    if not tags:
        return None
    return _exploded(df, tags)


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    """Keys with the counts that their rows add up to."""
    return rows.groupBy(*by).agg(*[F.sum(n).alias(n) for n in COUNTS], F.sum("amount").alias("amount"), F.max("amount").alias("top"))


def _found(name: str, line: Column | None, times: Column, parts: Sequence[Column] = (), most: Column | None = None) -> Column:
    """What a check finds in a key: a line, or what the key adds to the check's totals."""
    slots = [*parts, *[F.lit(None)] * (len(COUNTS) - len(parts))]
    return F.struct(
        F.lit(name).alias("check"),
        (F.lit(None) if line is None else line).cast("string").alias("line"),
        times.cast("long").alias("times"),
        *[c.cast("long").alias(n) for n, c in zip(COUNTS, slots, strict=True)],
        (F.lit(None) if most is None else most).cast(AMOUNT).alias("most"),
    )


def _fused(name: str, check: KeyRows | KeyTotals, mine: Column, key: Sequence[Column]) -> Column:
    if isinstance(check, KeyRows):
        return F.when(mine & check.where(), _found(name, text.json_text(F.struct(*key, *check.extra())), F.lit(1)))
    return F.when(mine, _found(name, None, F.lit(1), check.parts(), check.most and check.most()))


def _with_always(suite: Suite, lines: DataFrame) -> DataFrame:
    """lines, and one that adds nothing for each check of totals: a total over no keys is a line too."""
    always = [_found(name, None, F.lit(1)) for name, check in suite.fused.items() if isinstance(check, KeyTotals)]
    if not always:
        return lines
    spark = lines.sparkSession
    return lines.unionByName(spark.range(1).select(F.explode(F.array(*always)).alias("e")).select("e.*"))


def _summed(lines: DataFrame) -> DataFrame:
    """Totals are a few rows each after the partial aggregate; lines of keys are alone in their group."""
    return lines.groupBy("check", "line").agg(F.sum("times").alias("times"), *[F.sum(n).alias(n) for n in COUNTS], F.max("most").alias("most"))


def _whole(key: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in key])


def _key_pass(suite: Suite, tables: Tables) -> DataFrame:
    """Lines of row checks and of the fused checks."""
    tables = {name: suite.lines[name](df) if name in suite.lines else df for name, df in tables.items()}
    fields = _key_fields(suite, tables)
    tagged = [t for name, df in tables.items() if (t := _tags(suite, name, df, fields)) is not None]
    keys = _counted(reduce(DataFrame.unionByName, tagged), "keyed", "line", *fields)

    def key_of(keyed: str) -> list[Column]:
        table, side = next((t, s) for t, s in suite.sides[keyed].items() if t in tables)
        return [F.col(n) for n in tables[table].select(*side.key()).columns]

    whole = F.lit(True)
    for keyed in suite.sides:
        whole = F.when(F.col("keyed") == keyed, _whole(key_of(keyed))).otherwise(whole)
    keys = keys.withColumn("whole", whole)

    entries = []
    for name, check in suite.checks.items():
        if isinstance(check, RowCheck):
            entries.append(F.when(F.col("keyed") == f"row {name}", _found(name, F.col("line"), F.col("n0"))))
    for name, check in suite.fused.items():
        entries.append(_fused(name, check, F.col("keyed") == check.keyed, key_of(check.keyed)))
    return _shown(suite, _summed(_with_always(suite, _exploded(keys, entries))))


def _slice_pass(suite: Suite, tables: Tables, slices: int, keep: Keep) -> list[DataFrame]:
    """What _key_pass gives, with the keys of one kind and one slice counted at a time.

    A key is in one slice, so its lines are whole there; totals are added up over all slices.
    Row checks report row by row and move nothing."""
    tables = {name: suite.lines[name](df) if name in suite.lines else df for name, df in tables.items()}
    fields = _key_fields(suite, tables)
    out = []
    for table, df in tables.items():
        own = {name: c for name, c in suite.checks.items() if isinstance(c, RowCheck) and c.table == table}
        if own:
            out.append(_exploded(df, [F.when(c.where(), _entry(suite.labels[name], F.struct(*c.payload()))) for name, c in own.items()]))
    found = keep(
        _summed(_kind_found(suite, tables, fields, keyed, k, count))
        for keyed in suite.sides
        for count in [1 if keyed in suite.few else slices]
        for k in range(count)
    )
    totals = _summed(_with_always(suite, found.filter("line IS NULL")))
    return [*out, _shown(suite, found.filter("line IS NOT NULL")), _shown(suite, totals)]


def _kind_found(suite: Suite, tables: Tables, fields: Mapping[str, T.DataType], keyed: str, k: int, slices: int) -> DataFrame:
    """What the checks find in slice k of the keys of one kind."""
    sides = {table: side for table, side in suite.sides[keyed].items() if table in tables}
    rows, names = [], []
    for table, side in sides.items():
        df = tables[table].filter(side.where()) if side.where else tables[table]
        names, counts = df.select(*side.key()).columns, side.counts()
        key = [c.cast(fields[n]) for n, c in zip(names, side.key(), strict=True)]
        if slices > 1:
            df = df.filter(F.pmod(F.xxhash64(*key), F.lit(slices)) == k)
        amount = side.amount() if side.amount else F.lit(None)
        rows.append(
            df.select(
                *[c.alias(n) for n, c in zip(names, key, strict=True)],
                *[counts.get(n, F.lit(0)).cast("long").alias(n) for n in COUNTS],
                amount.cast(AMOUNT).alias("amount"),
            )
        )
    key = [F.col(n) for n in names]
    keys = _counted(reduce(DataFrame.unionByName, rows), *names).withColumn("whole", _whole(key))
    return _exploded(keys, [_fused(name, c, F.lit(True), key) for name, c in suite.fused.items() if c.keyed == keyed])


def _shown(suite: Suite, lines: DataFrame) -> DataFrame:
    """Report lines from (check, line, times, counts, most)."""
    made = []
    for name, label in suite.labels.items():
        check = suite.fused.get(name)
        here = F.col("check") == name
        if isinstance(check, KeyTotals):
            made.append(F.when(here, F.array(_entry(label, F.struct(*check.payload())))))
        else:
            made.append(F.when(here, F.array_repeat(_line(label, F.col("line")), F.col("times").cast("int"))))
    return lines.select(F.explode(F.coalesce(*made)).alias("r")).select("r.*")


def _total_pass(suite: Suite, df: DataFrame, checks: Mapping[str, TotalCheck]) -> DataFrame:
    structs = [F.struct(*c.measures()).alias(name) for name, c in checks.items()]
    lines = [_entry(suite.labels[name], F.col(name)) for name in checks]
    return df.agg(*structs).select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def errors(report: DataFrame, strict: bool = False) -> DataFrame:
    """Report rows that stop a run. ``strict`` also takes other spellings of ERROR."""
    severity = F.upper("severity") if strict else F.col("severity")
    return report.filter(severity == "ERROR")


def gate_verdict(report: DataFrame, table: str, strict: bool = False) -> DataFrame:
    severity = F.upper("severity") if strict else F.col("severity")
    return report.agg(F.count_if(severity == "ERROR").alias("errors")).select(
        F.lit(table).alias("table_name"), "errors", (F.col("errors") == 0).alias("passed")
    )


def gate(report: DataFrame, table: str, strict: bool = False) -> None:
    """Stop the run when the report holds an error."""
    if errors(report, strict).limit(1).count():
        raise TableAssertion(f"validation of {table} failed")
