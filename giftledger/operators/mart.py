"""Donor mart: one row per donor with recency, frequency and monetary scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AMOUNT, MART, SCORE


@dataclass(frozen=True)
class ScoreRules:
    """Bucket limits. Scores run from 1 to 5; the source of these rules leaves the limits open, so they are ours."""

    recency_days: Sequence[tuple[int, int]] = ((90, 5), (180, 4), (365, 3), (730, 2))  # at most n days: score
    frequency: Sequence[tuple[int, int]] = ((1, 1), (2, 2), (5, 3), (10, 4))  # at most n gifts: score
    monetary: Sequence[tuple[int, int]] = ((100, 1), (500, 2), (1000, 3), (5000, 4))  # below this total: score
    # The weights of the engagement score.
    weights: tuple[Decimal, Decimal, Decimal] = (Decimal("0.4"), Decimal("0.3"), Decimal("0.3"))


def _bucket(steps: Sequence[tuple[int, int]], fits, otherwise: int) -> Column:
    """First step that fits decides; null fits none."""
    score = None
    for limit, value in steps:
        score = F.when(fits(limit), value) if score is None else score.when(fits(limit), value)
    return score.otherwise(otherwise)


def recency_score(days: Column, rules: ScoreRules = ScoreRules()) -> Column:
    return _bucket(rules.recency_days, lambda limit: days <= limit, 1)


def frequency_score(gifts: Column, rules: ScoreRules = ScoreRules()) -> Column:
    return _bucket(rules.frequency, lambda limit: gifts <= limit, 5)


def monetary_score(total: Column, rules: ScoreRules = ScoreRules()) -> Column:
    return F.when(total.isNull(), 1).otherwise(_bucket(rules.monetary, lambda limit: total < limit, 5))


def donor_summary(staged: DataFrame, dim: DataFrame, amount_type: T.DecimalType = AMOUNT) -> DataFrame:
    """Gift count, total, first and last date per donor.

    The join is one to one on the record id, on three and two columns; donors with many gifts are combined on the
    map side of the aggregation.
    """
    gifts = staged.select("sub_id", "contribution_amount", "contribution_date")
    return (
        gifts.join(dim.select("sub_id", "donor_id"), "sub_id")
        .groupBy("donor_id")
        .agg(
            F.count("*").alias("contribution_count"),
            F.sum("contribution_amount").cast(amount_type).alias("total_amount"),
            F.min("contribution_date").alias("first_contribution_date"),
            F.max("contribution_date").alias("last_contribution_date"),
        )
    )


def add_scores(summary: DataFrame, as_of: date, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Scores as of a given day - a parameter, never the clock, so a rerun gives the same mart."""
    recency_weight, frequency_weight, monetary_weight = (
        F.lit(w).cast(T.DecimalType(3, 2)) for w in rules.weights
    )
    points = T.DecimalType(2, 0)
    engagement = (
        recency_weight * F.col("recency_score").cast(points)
        + frequency_weight * F.col("frequency_score").cast(points)
        + monetary_weight * F.col("monetary_score").cast(points)
    )
    return (
        summary.withColumn("days_since_last", F.datediff(F.lit(as_of), "last_contribution_date"))
        .withColumns(
            {
                "recency_score": recency_score(F.col("days_since_last"), rules),
                "frequency_score": frequency_score(F.col("contribution_count"), rules),
                "monetary_score": monetary_score(F.col("total_amount"), rules),
            }
        )
        .withColumn("engagement_score", engagement.cast(SCORE))
    )


def build_mart(staged: DataFrame, dim: DataFrame, as_of: date, rules: ScoreRules = ScoreRules()) -> DataFrame:
    return add_scores(donor_summary(staged, dim), as_of, rules).select(*MART.fieldNames())


def lapsed_donors(mart: DataFrame, as_of: date, minimum: int = 500, months: int = 12) -> DataFrame:
    """Donors of at least ``minimum`` in total whose last gift is more than ``months`` months back."""
    return mart.where(
        (F.col("total_amount") >= minimum) & (F.col("last_contribution_date") < F.add_months(F.lit(as_of), -months))
    )
