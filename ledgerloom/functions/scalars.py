"""Column expressions with the exact scalar semantics the operators need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MICROS_PER_DAY = 86_400_000_000


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A small constant relation built from literals, without a Python or file source."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def moment(text: str) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed_days(earlier: Column, later: Column) -> Column:
    """Whole 24-hour periods between two instants, rounded down also for negative spans."""
    span = _micros(later) - _micros(earlier)
    return ((span - F.pmod(span, F.lit(MICROS_PER_DAY))) / MICROS_PER_DAY).cast("bigint")


def second_boundaries(start: Column, end: Column) -> Column:
    """Number of clock-second boundaries crossed (0.9 s to 2.1 s is two)."""
    return F.unix_seconds(F.date_trunc("second", end.cast("timestamp"))) - F.unix_seconds(
        F.date_trunc("second", start.cast("timestamp"))
    )


def trunc_ntz(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_number(ts: Column) -> Column:
    """Months since year 0, so that a difference is a month offset."""
    return F.year(ts) * 12 + F.month(ts)


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def last_four(number: Column) -> Column:
    return F.right(number.cast("string"), F.lit(4))


def digits(number: Column) -> Column:
    return F.length(number.cast("string"))


def share(part: Column, whole: Column) -> Column:
    """Percentage as double; NULL when the whole is zero."""
    return part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0))


def choose(cases: Mapping[str, Column], default: Column | None = None) -> Column:
    """Ordered label -> condition mapping as one CASE; the first true condition wins."""
    expr = None
    for label, condition in cases.items():
        expr = F.when(condition, label) if expr is None else expr.when(condition, label)
    return expr if default is None else expr.otherwise(default)


# Amounts above each bound and the label of their range; anything else has the last label.
AMOUNT_RANGES = ((1000, ">1000"), (500, "500-1000"), (100, "100-500"))
LOWEST_RANGE = "<100"


def amount_bucket(amount: Column) -> Column:
    return choose({label: amount > bound for bound, label in AMOUNT_RANGES}, F.lit(LOWEST_RANGE))


def anonymous_number(number: Column) -> Column:
    """Stable non-negative 16-digit stand-in for an identifier."""
    return F.pmod(F.xxhash64(number), F.lit(9999999999999999))


def json_value(document: Column, path: str, data_type: str) -> Column:
    """Typed value at a path of a variant; JSON null and a missing path are SQL NULL."""
    return F.variant_get(document, path, data_type)


def json_value_or_null(document: Column, path: str, data_type: str) -> Column:
    """As :func:`json_value`, but a value that does not fit the type is NULL instead of an error."""
    return F.try_variant_get(document, path, data_type)


def sql_null(document: Column) -> Column:
    """Variant null (JSON ``null``) normalised to SQL NULL."""
    return F.when(~F.is_variant_null(document), document)
