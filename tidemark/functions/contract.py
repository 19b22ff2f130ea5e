"""The event contract as Spark SQL expressions: strict JSON decoding, typing and first-failure order.

Every function returns the text of an expression over the columns it is given, so a whole record
check reaches Spark as a handful of expressions instead of a thousand separate calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.functions.text import NOT_BLANK
from tidemark.schema import (
    ERROR_CATEGORIES,
    EVENT_SCHEMA,
    INVALID_JSON,
    INVALID_TIMESTAMP,
    INVALID_TYPE,
    LONG_MAX,
    MISSING_FIELD,
    REQUIRED_FIELDS,
)

# The forms of a date, a clock time and an offset.
DATE_PART = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
TIME_PART = (
    r"((?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?|[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?)"
)
OFFSET_PART = (
    r"(Z|[+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d+)?)?|[0-5]\d(?:[0-5]\d(?:\.\d+)?)?)?)"
)
COMMON_ZONED = (
    r"^\d{4}-\d{2}-\d{2}[T ](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,9})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)$"
)
ZONED = rf"^{DATE_PART}.{TIME_PART}{OFFSET_PART}$"
NAIVE = rf"^{DATE_PART}(?:.{TIME_PART})?$"

# The storable range and the texts of the rejection details.
EARLIEST = "1900-01-01T00:00:00.000Z"
LATEST = "2299-12-31T23:59:59.999Z"
INTEGER_RANGE = {"schema_version": (1, 65_535), "producer_sequence": (0, LONG_MAX)}
NOT_DECODED = "JSON decoding failed"
NOT_OBJECT = "top-level JSON value must be an object"
MISSING_PREFIX = "missing required field(s): "
MUST_BE_INTEGER = "{name} must be an integer from {low} through {high}"
MUST_BE_NUMERIC = "{name} must be numeric"
MUST_BE_FINITE = "{name} must be finite"
MUST_BE_BOOLEAN = "{name} must be boolean"
MUST_BE_TEXT = "{name} must be a non-empty string"
MUST_BE_ISO = "{name} must be an ISO-8601 string"
NOT_ISO = "{name} is not a valid ISO-8601 timestamp"
NO_OFFSET = "{name} must include a UTC offset or Z suffix"
OUT_OF_RANGE = "{name} is outside ClickHouse DateTime64(3) range 1900-01-01 through 2299-12-31 UTC"

# The order in which the values of a complete record are checked.
CHECK_ORDER = (
    ("schema_version", "integer"),
    ("producer_sequence", "integer"),
    ("metric_value", "number"),
    ("injected_duplicate", "flag"),
    ("injected_late", "flag"),
    ("producer_run_id", "text"),
    ("produced_at", "instant"),
    ("event_id", "text"),
    ("tenant_id", "text"),
    ("device_id", "text"),
    ("metric_name", "text"),
    ("event_time", "instant"),
    ("region", "text"),
    ("firmware", "text"),
)

# Closes the text below; a record is whole only if the parser reaches this element.
END_MARK = "\\u0001end"
VALUE_TYPES = {name: "string" for name, rule in CHECK_ORDER if rule == "instant"}
FIELD_TYPES = ", ".join(f"{name}: variant" for name in REQUIRED_FIELDS)
NON_FINITE_TOKEN = r"([:\[,]\s*)(?:-?Infinity|NaN)(?=\s*[,}\]])"


def literal(value: str) -> str:
    """A string as a raw SQL literal, so patterns keep their backslashes."""
    return "r'" + value + "'"


def parse_elements(raw: str) -> str:
    """The record and the end mark as a two-element array of structs of VARIANT fields.

    The parser stops at the end of the first value, so the text is read as the first element of an
    array that ends in a mark: anything after the record either breaks the array or moves the mark.
    NULL or another shape means the text is not one JSON object.
    """
    mark = literal(f', {{"schema_version":"{END_MARK}"}}]')
    return (
        f"from_json(concat('[', {raw}, {mark}), 'array<struct<{FIELD_TYPES}>>', map('allowSingleQuotes', 'false'))"
    )


def read_values(raw: str) -> str:
    """The record's values in their own types, clocks as text; NULL for a value of another type.

    Reading typed values straight from the text is much cheaper than converting VARIANT values one
    by one.  Text fields would also take numbers here; the JSON types tell those apart.
    """
    fields = ", ".join(f"{f.name}: {VALUE_TYPES.get(f.name, f.dataType.simpleString())}" for f in EVENT_SCHEMA)
    return f"from_json({raw}, 'struct<{fields}>', map('allowSingleQuotes', 'false'))"


def is_single_record(elements: str) -> str:
    mark = f"try_variant_get({elements}[1].schema_version, '$', 'string')"
    return (
        f"coalesce(size({elements}) = 2 AND {elements}[0] IS NOT NULL AND {mark} = concat(char(1), 'end'), false)"
    )


def decode(raw: str) -> str:
    """The one JSON value of any kind a text holds, as VARIANT; NULL when it is not exactly one value.

    The text is read inside an array, which rejects a second value or a stray brace, and inside an
    object, which rejects a stray bracket.  Bare non-finite numbers are let through as text.
    """

    def one_value(text: str) -> str:
        in_array = f"try_parse_json(concat('[', {text}, ']'))"
        in_object = f"""json_object_keys(concat('{{"w":', {text}, '}}'))"""
        return (
            f"CASE WHEN try_variant_get({in_array}, '$[1]', 'variant') IS NULL AND {in_object} IS NOT NULL"
            f" THEN try_variant_get({in_array}, '$[0]', 'variant') END"
        )

    # A colon before and a comma after let the pattern see a token that is the whole text.
    token = literal(NON_FINITE_TOKEN)
    quoted = f"""regexp_replace(concat(':', {raw}, ','), {token}, '$1"non-finite"')"""
    repaired = f"substring({quoted}, 2, length({quoted}) - 2)"
    return f"coalesce({one_value(raw)}, {one_value(repaired)})"


def is_object(doc: str) -> str:
    return f"startswith(schema_of_variant({doc}), 'OBJECT<')"


def part(text: str, pattern: str, group: int) -> str:
    return f"regexp_extract({text}, {literal(pattern)}, {group})"


def day_of(date: str) -> str:
    """A calendar or week date in any of its forms as DATE; NULL for a day that does not exist."""
    digits = f"replace({date}, '-', '')"
    week = f"replace({digits}, 'W', '')"
    fourth = f"try_to_date(concat(left({week}, 4), '-01-04'), 'yyyy-MM-dd')"
    monday = f"date_sub({fourth}, weekday({fourth}))"
    number, weekday = f"int(substring({week}, 5, 2))", f"int(if(length({week}) > 6, substring({week}, 7, 1), '1'))"
    found = f"date_add({monday}, ({number} - 1) * 7 + {weekday} - 1)"
    real = f"{weekday} BETWEEN 1 AND 7 AND {number} >= 1 AND weekofyear({found}) = {number}"
    return (
        f"CASE WHEN {date} RLIKE 'W' THEN CASE WHEN {real} THEN {found} END"
        f" ELSE try_to_date({digits}, 'yyyyMMdd') END"
    )


def micros_of(clock: str) -> str:
    """Microseconds of a clock time with or without colons; digits beyond the sixth of a fraction are cut."""
    digits = f"replace(replace({clock}, ':', ''), ',', '.')"
    whole = f"rpad(split_part({digits}, '.', 1), 6, '0')"
    fraction = f"bigint(rpad(left(split_part({digits}, '.', 2), 6), 6, '0'))"
    return (
        f"(((bigint(substring({whole}, 1, 2)) * 60 + bigint(substring({whole}, 3, 2))) * 60"
        f" + bigint(substring({whole}, 5, 2))) * 1000000 + {fraction})"
    )


def instant(text: str) -> str:
    """Read ISO-8601 text with an offset as a UTC instant; NULL for any other text.

    The common form is left to Spark's own reader; the others are split into date, clock and offset.
    """
    date, clock, offset = (part(text, ZONED, i) for i in (1, 2, 3))
    day = f"unix_date({day_of(date)}) * 86400000000L"
    sign = f"if(startswith({offset}, '-'), -1, 1)"
    away = f"if({offset} = 'Z', 0L, {sign} * {micros_of(f'substring({offset}, 2)')})"
    return (
        f"CASE WHEN {text} RLIKE {literal(COMMON_ZONED)} THEN try_to_timestamp({text})"
        f" WHEN {text} RLIKE {literal(ZONED)} THEN timestamp_micros({day} + {micros_of(clock)} - {away}) END"
    )


def is_naive(text: str) -> str:
    """A readable date and time without an offset."""
    return f"({text} RLIKE {literal(NAIVE)} AND {day_of(part(text, NAIVE, 1))} IS NOT NULL)"


@dataclass(frozen=True)
class Rule:
    """One way a record can fail."""

    broken: str
    category: str
    detail: str

    def __post_init__(self) -> None:
        if self.category not in ERROR_CATEGORIES:
            raise ValueError(f"unbounded error category: {self.category}")


def field_rules(name: str, rule: str, kind: str, typed: str, text: str) -> list[Rule]:
    """The failures of one field in the order they are tried."""
    if rule == "integer":
        low, high = INTEGER_RANGE[name]
        good = f"coalesce({kind} = 'BIGINT' AND {typed} BETWEEN {low} AND {high}, false)"
        return [Rule(f"NOT {good}", INVALID_TYPE, MUST_BE_INTEGER.format(name=name, low=low, high=high))]
    if rule == "number":
        numeric = f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"
        finite = f"coalesce(NOT isnan({typed}) AND abs({typed}) < double('Infinity'), false)"
        return [
            Rule(f"NOT {numeric}", INVALID_TYPE, MUST_BE_NUMERIC.format(name=name)),
            Rule(f"NOT {finite}", INVALID_TYPE, MUST_BE_FINITE.format(name=name)),
        ]
    if rule == "flag":
        return [Rule(f"{kind} <> 'BOOLEAN'", INVALID_TYPE, MUST_BE_BOOLEAN.format(name=name))]
    if rule == "text":
        good = f"coalesce({kind} = 'STRING' AND {typed} RLIKE {literal(NOT_BLANK)}, false)"
        return [Rule(f"NOT {good}", INVALID_TYPE, MUST_BE_TEXT.format(name=name))]
    in_range = f"{typed} BETWEEN TIMESTAMP '{EARLIEST}' AND TIMESTAMP '{LATEST}'"
    return [
        Rule(f"{kind} <> 'STRING'", INVALID_TIMESTAMP, MUST_BE_ISO.format(name=name)),
        Rule(f"{typed} IS NULL AND {is_naive(text)}", INVALID_TIMESTAMP, NO_OFFSET.format(name=name)),
        Rule(f"{typed} IS NULL", INVALID_TIMESTAMP, NOT_ISO.format(name=name)),
        Rule(f"NOT ({in_range})", INVALID_TIMESTAMP, OUT_OF_RANGE.format(name=name)),
    ]


def missing_fields(kinds: str) -> str:
    """The absent required fields, comma separated in declared order."""
    return "concat_ws(', ', " + ", ".join(f"if({kinds}.{n} IS NULL, '{n}', NULL)" for n in REQUIRED_FIELDS) + ")"


def all_rules(raw: str, single: str, kinds: str, values: str, instants: str) -> list[Rule]:
    """Every rule in the order of the contract; the first broken one decides.

    ``kinds``, ``values`` and ``instants`` name structs holding, by field, the JSON type (NULL when
    the field is absent), the value, and the instant a clock's text stands for.
    """
    incomplete = " OR ".join(f"{kinds}.{n} IS NULL" for n in REQUIRED_FIELDS)
    rules = [
        Rule(f"NOT {single} AND {decode(raw)} IS NULL", INVALID_JSON, NOT_DECODED),
        Rule(f"NOT {single}", INVALID_TYPE, NOT_OBJECT),
        Rule(incomplete, MISSING_FIELD, MISSING_PREFIX),
    ]
    for name, rule in CHECK_ORDER:
        typed = f"{instants if rule == 'instant' else values}.{name}"
        rules += field_rules(name, rule, f"{kinds}.{name}", typed, f"{values}.{name}")
    return rules


def first_broken(rules: list[Rule]) -> str:
    """The 1-based number of the first broken rule; NULL for a valid record."""
    return "CASE " + " ".join(f"WHEN {rule.broken} THEN {n}" for n, rule in enumerate(rules, start=1)) + " END"


def describe(number: str, rules: list[Rule], kinds: str) -> str:
    """struct(category, detail) of a rule number; NULL for NULL.

    The longest list of missing fields stays within the limit for details, so it needs no cutting.
    """
    categories = ", ".join(f"'{r.category}'" for r in rules)
    details = ", ".join(f"'{r.detail}'" for r in rules)
    category = f"element_at(array({categories}), {number})"
    detail = f"element_at(array({details}), {number})"
    listed = f"if({category} = '{MISSING_FIELD}', concat({detail}, {missing_fields(kinds)}), {detail})"
    return f"if({number} IS NULL, NULL, named_struct('category', {category}, 'detail', {listed}))"
