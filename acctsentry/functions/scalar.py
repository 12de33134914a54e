"""Row-wise column expressions (no UDFs): codes, clock fields, guarded maths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctsentry import schema as S

MICROS = 1_000_000
DAY_US = 86_400 * MICROS


def event_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a session-zone timestamp (NULL stays)."""
    return F.unix_micros(ts)


def amount(c: Column | None = None) -> Column:
    """Numeric amount; NULL, NaN and text that is no number become 0."""
    value = (c if c is not None else F.col(S.AMOUNT)).try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def amount_of(df: DataFrame) -> Column:
    """``transaction_amount`` where a table has it, else the raw amount."""
    return amount(F.col("transaction_amount" if "transaction_amount" in df.columns else S.AMOUNT))


def flag_amount(t: Column) -> Column:
    """1 when the upper-cased type is 'S'."""
    return F.when(F.upper(t) == "S", F.lit(1)).otherwise(F.lit(0))


def type_encoded(t: Column) -> Column:
    """Model code of the upper-cased type, unknown or NULL -> 0."""
    return F.coalesce(S.map_literal(S.TRANSFER_TYPE_ENCODED)[F.upper(t)], F.lit(S.TYPE_ENCODED_DEFAULT))


def type_risk(t: Column) -> Column:
    """P5: risk weight of the upper-cased type, unknown or NULL -> 0.5."""
    return F.coalesce(
        S.map_literal(S.TRANSFER_TYPE_RISK)[F.upper(t)].cast("double"), F.lit(S.TYPE_RISK_DEFAULT)
    )


def type_name(t: Column) -> Column:
    """Display name of an exact type code (NULL when unknown)."""
    return S.map_literal(S.TRANSFER_TYPE_NAME)[t]


def hour_of_day(ts: Column) -> Column:
    """Hour, NULL -> 12."""
    return F.coalesce(F.hour(ts), F.lit(S.NULL_HOUR))


def day_of_week(ts: Column) -> Column:
    """P10: Monday = 0 ... Sunday = 6, NULL -> 0."""
    return F.coalesce(F.weekday(ts), F.lit(S.NULL_DAY_OF_WEEK))


def is_weekend(dow: Column) -> Column:
    """P11."""
    return (dow >= 5).cast("int")


def is_night(hour: Column) -> Column:
    """Before 06:00 or from 22:00."""
    return ((hour < S.NIGHT_BEFORE_HOUR) | (hour >= S.NIGHT_FROM_HOUR)).cast("int")


def safe_ratio(num: Column, den: Column) -> Column:
    """Num / den with a zero denominator replaced by 1."""
    return num / F.when(den == 0, F.lit(1.0)).otherwise(den)


def velocity(gap_seconds: Column) -> Column:
    """Transfers per hour implied by the gap; a 0 s gap counts as 1 s."""
    return F.lit(1.0) / (F.when(gap_seconds == 0, F.lit(1.0)).otherwise(gap_seconds) / F.lit(3600.0))


def sample_std(values: Column) -> Column:
    """Sample standard deviation of a short array (two-pass); < 2 values -> 0."""
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n < 2, F.lit(0.0)).otherwise(F.sqrt(ss / (n - 1)))


def money(x: Column) -> Column:
    """P25: ``{x:,.2f}``."""
    return F.format_number(x, 2)


def fixed4(x: Column) -> Column:
    """P25: ``{x:.4f}`` (no grouping)."""
    return F.call_function("format_number", x, F.lit("0.0000"))
