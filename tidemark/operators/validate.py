"""Validation of raw event text into typed rows and rejects, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import contract
from tidemark.schema import ERROR_CATEGORIES, PARSED_FIELDS, REQUIRED_FIELDS


def validate(df: DataFrame, raw: str = "value") -> DataFrame:
    """Add ``error`` (struct category, detail; NULL when valid) and the fifteen typed columns.

    Each record is decoded once.  The stages are separate projections so that the decoded fields,
    their types and the typed values are computed one time and only referred to afterwards.  The
    verdict leaves through a one-element explode: a filter on it then stays above the work, where
    it would otherwise be pushed down together with a second copy of all of it.  The typed columns
    are meaningful only where ``error`` is NULL.
    """
    clash = sorted(set(df.columns) & {"error", "is_valid", *PARSED_FIELDS})
    if clash:
        raise ValueError(f"input columns named like output columns: {clash}")
    names = [f"`{name}`" for name in df.columns]
    times = [name for name, rule in contract.CHECK_ORDER if rule == "instant"]
    rules = contract.all_rules(f"`{raw}`", "_single", "_kinds", "_values", "_instants")

    def struct_of(fields, expression) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {expression(n)}" for n in fields) + ")"

    kinds = struct_of(REQUIRED_FIELDS, lambda n: f"schema_of_variant(_record.{n})")
    instants = struct_of(times, lambda n: contract.instant(f"_values.{n}"))
    return (
        df.selectExpr(
            "*",
            f"{contract.parse_elements(f'`{raw}`')} AS _elements",
            f"{contract.read_values(f'`{raw}`')} AS _values",
        )
        .selectExpr(
            *names, "_values", f"{contract.is_single_record('_elements')} AS _single", "_elements[0] AS _record"
        )
        .selectExpr(*names, "_values", "_single", f"{kinds} AS _kinds", f"{instants} AS _instants")
        .selectExpr("*", f"{contract.first_broken(rules)} AS _broken")
        .selectExpr("*", "explode(array(_broken)) AS _rule")
        .selectExpr(
            *names,
            f"{contract.describe('_rule', rules, '_kinds')} AS error",
            "_rule IS NULL AS is_valid",
            *[f"{'_instants' if n in times else '_values'}.{n} AS {n}" for n in REQUIRED_FIELDS],
            "unix_millis(_instants.event_time) AS event_time_ms",
        )
    )


def valid_rows(validated: DataFrame, *extra: str) -> DataFrame:
    """The accepted records as the fifteen parsed columns, after any extra ones asked for."""
    return validated.filter("is_valid").select(*extra, *PARSED_FIELDS)


def invalid_rows(validated: DataFrame, raw: str = "value", *extra: str) -> DataFrame:
    """The rejected records: text, category and detail."""
    return validated.filter("NOT is_valid").select(
        *extra,
        F.col(raw).alias("raw_payload"),
        F.col("error.category").alias("error_category"),
        F.col("error.detail").alias("error_detail"),
    )


def outcome_counters():
    """Aggregates counting records seen, valid, invalid and invalid by category."""
    category = F.col("error.category")
    return [
        F.count(F.lit(1)).alias("records_seen"),
        F.count_if("is_valid").alias("records_valid"),
        F.count_if(~F.col("is_valid")).alias("records_invalid"),
        *[F.count_if(F.coalesce(category == c, F.lit(False))).alias(f"invalid_{c}") for c in ERROR_CATEGORIES],
    ]


def validation_counters(validated: DataFrame) -> DataFrame:
    return validated.agg(*outcome_counters())
