"""Limit and velocity rules (R1-R6) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.functions.scalar import money


def type_limit(user_avg: Column, user_std: Column, transfer_type: Column) -> Column:
    """max(avg + multiplier * std, floor); the type must match exactly."""
    mult = F.coalesce(S.map_literal(S.TRANSFER_MULTIPLIERS)[transfer_type], F.lit(S.MULTIPLIER_DEFAULT))
    floor = F.coalesce(
        S.map_literal(S.TRANSFER_MIN_FLOORS)[transfer_type].cast("double"), F.lit(float(S.FLOOR_DEFAULT))
    )
    return F.greatest(user_avg + mult * user_std, floor)


def all_limits(user_avg: Column, user_std: Column) -> Column:
    """R2: array of (transfer_type, limit) for the five types, in display order."""
    return F.array(*[
        F.struct(F.lit(t).alias("transfer_type"), type_limit(user_avg, user_std, F.lit(t)).alias("limit"))
        for t in S.LIMIT_TYPE_ORDER
    ])


def velocity_10min_reason(n: Column) -> Column:
    """R3."""
    return F.when(
        n > S.MAX_VELOCITY_10MIN,
        F.concat(
            F.lit("Velocity limit exceeded: "), n.cast("string"),
            F.lit(f" transactions in last 10 minutes (max allowed {S.MAX_VELOCITY_10MIN})"),
        ),
    )


def velocity_1hour_reason(n: Column) -> Column:
    """R4."""
    return F.when(
        n > S.MAX_VELOCITY_1HOUR,
        F.concat(
            F.lit("Hourly velocity limit exceeded: "), n.cast("string"),
            F.lit(f" transactions in last 1 hour (max allowed {S.MAX_VELOCITY_1HOUR})"),
        ),
    )


def monthly_reason(projected: Column, threshold: Column) -> Column:
    """R5."""
    return F.when(
        projected > threshold,
        F.concat(
            F.lit("Monthly spending AED "), money(projected),
            F.lit(" exceeds limit AED "), money(threshold),
        ),
    )


def rule_check(
    amount: Column,
    user_avg: Column,
    user_std: Column,
    transfer_type: Column,
    txn_count_10min: Column,
    txn_count_1hour: Column,
    monthly_spending: Column,
) -> Column:
    """struct(violated, reasons, threshold); reasons in order R3, R4, R5."""
    threshold = type_limit(user_avg, user_std, transfer_type)
    projected = monthly_spending + amount
    reasons = F.array_compact(
        F.array(
            velocity_10min_reason(txn_count_10min),
            velocity_1hour_reason(txn_count_1hour),
            monthly_reason(projected, threshold),
        )
    )
    return F.struct(
        (F.size(reasons) > 0).alias("violated"),
        reasons.alias("reasons"),
        threshold.alias("threshold"),
    )
