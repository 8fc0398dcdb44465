"""Text clean-up as Column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import fixed


def trim_ws(c: Column) -> Column:
    """Strip every kind of Unicode white space; Spark's trim strips U+0020 only."""
    return F.regexp_replace(c, fixed.OUTER_SPACE, "")


def normalize_currency(c: Column) -> Column:
    """Three-letter code or NULL.

    The first run of three capitals is the code: a clean code is its own first
    run, so one extraction covers both cases.
    """
    text = F.upper(trim_ws(F.regexp_replace(c, fixed.SPACE_RUN, " ")))
    return F.when(text.rlike(fixed.DOLLAR_FORMS), F.lit("USD")).otherwise(
        F.regexp_substr(text, F.lit(fixed.CURRENCY_TOKEN))
    )


def status_plain(c: Column) -> Column:
    return F.upper(c)


def status_tight(c: Column) -> Column:
    """Upper case without blanks: 'Return Pending' reads RETURNPENDING."""
    return F.upper(F.replace(c, F.lit(" "), F.lit("")))


def status_spaced(c: Column) -> Column:
    """Upper case with runs of space separators folded to one blank."""
    return F.upper(trim_ws(F.regexp_replace(c, fixed.SPACE_RUN, " ")))


def clean_email(c: Column) -> Column:
    """Trim and lower; the placeholder becomes NULL, an empty text stays."""
    return F.nullif(F.lower(trim_ws(c)), F.lit(fixed.NO_EMAIL))


def phone_digits(c: Column) -> Column:
    return F.regexp_replace(F.lower(trim_ws(c)), fixed.NOT_PHONE, "")


def clean_phone(c: Column) -> Column:
    return F.nullif(phone_digits(c), F.lit(""))


def blank(c: Column) -> Column:
    return c.isNull() | (trim_ws(c) == "")


def blank_email(c: Column) -> Column:
    return blank(c) | (F.lower(trim_ws(c)) == fixed.NO_EMAIL)


def blank_phone(c: Column) -> Column:
    return c.isNull() | (phone_digits(c) == "")


def unknown_contact(email: Column, first: Column, last: Column, phone: Column) -> Column:
    """True when nothing identifies the person."""
    return F.coalesce(
        blank_email(email) & blank(first) & blank(last) & blank_phone(phone), F.lit(False)
    )


def mask_email(c: Column) -> Column:
    at = F.instr(c, "@")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("XXXXX"), F.when(at > 1, F.substr(c, at)).otherwise(F.lit("")))
    )


def mask_phone(c: Column) -> Column:
    """Keep the last four characters of four or more; hide shorter numbers whole."""
    size = F.length(c)
    kept = F.when(size >= 4, F.lit(4)).otherwise(F.lit(0))
    return F.concat(F.repeat(F.lit("X"), size - kept), F.right(c, kept))


def json_text(c: Column) -> Column:
    """JSON text that keeps NULL fields and writes a NULL input as 'null'."""
    return F.coalesce(F.to_json(c, {"ignoreNullFields": "false"}), F.lit("null"))


def stable_key(*parts: Column) -> Column:
    """Repeatable surrogate key; a random one would change when a task is retried."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def marked(c: Column, marker: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(marker))


def register_functions(spark: SparkSession) -> None:
    """Make normalize_currency callable from SQL text for the session."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION normalize_currency(s STRING) RETURNS STRING RETURN (
          SELECT IF(t RLIKE r'{fixed.DOLLAR_FORMS}', 'USD', regexp_substr(t, r'{fixed.CURRENCY_TOKEN}'))
          FROM (SELECT upper(regexp_replace(regexp_replace(s, r'{fixed.SPACE_RUN}', ' '),
                                            r'{fixed.OUTER_SPACE}', '')) AS t))
        """
    )
