"""Policy screen over a log of query texts: one verdict and reason per query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import fixed
from turnstile.functions.text import trim_ws
from turnstile.operators.views.governed import APPROVED


def query_log_screen(
    queries: DataFrame,
    project: str,
    dataset: str,
    views: Sequence[str] = APPROVED,
    blocked: Sequence[str] = fixed.BLOCKED_WORDS,
) -> DataFrame:
    """(query_id, allowed, reason); the first rule that fails gives the reason.

    A query may only read, be one statement, use no blocked word (not even inside a
    text), and quote at least one name, each of them an approved view in full.
    """
    text = trim_ws(F.col("sql"))
    rows = queries.select(
        "query_id",
        F.upper(F.regexp_replace(text, r"\s+", " ")).alias("flat"),
        F.regexp_replace(text, r";+\z", "").alias("body"),
        F.regexp_extract_all("sql", F.lit("`([^`]+)`"), F.lit(1)).alias("names"),
    )
    flat, body, names = F.col("flat"), F.col("body"), F.col("names")
    word = F.regexp_substr(flat, F.lit(rf"\b({'|'.join(blocked)})\b"))

    def fault(name: Column) -> Column:
        parts = F.split(name, r"\.")
        return (
            F.when(F.size(parts) != 3, F.concat(F.lit("not a full name: "), name))
            .when(parts[0] != project, F.concat(F.lit("project not approved: "), parts[0]))
            .when(parts[1] != dataset, F.concat(F.lit("dataset not approved: "), parts[1]))
            .when(~parts[2].isin(*views), F.concat(F.lit("view not approved: "), parts[2]))
        )

    reason = F.coalesce(
        F.when(~flat.rlike("^(SELECT|WITH)"), F.lit("not a read-only query")),
        F.when(F.contains(body, F.lit(";")), F.lit("more than one statement")),
        F.concat(F.lit("blocked word "), word),
        F.when(F.size(names) == 0, F.lit("no quoted name")),
        F.get(F.filter(F.transform(names, fault), lambda x: x.isNotNull()), F.lit(0)),
    )
    return rows.select("query_id", reason.isNull().alias("allowed"), reason.alias("reason"))
