"""What customers wrote and searched for."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, within


def review_summary(
    reviews: DataFrame, as_of: date, *, latest_days: int = 7, negative_up_to: int = 3
) -> DataFrame:
    """Rating, number, length and negative reviews of the last days.

    The case shown is the worst-rated review; the lowest post id among equals.
    """
    rating = F.col("rating_value")
    negative = rating <= negative_up_to
    since = as_of - timedelta(days=latest_days + 1)
    recent = reviews.filter((F.col("post_day") >= F.lit(since)) & F.col("product_id").isNotNull())
    return recent.groupBy("product_id").agg(
        np_round(F.avg(rating), 2).alias("avg_rating"),
        F.countDistinct("post_id").alias("review_count"),
        np_round(F.avg(F.length("message")), 2).alias("review_length"),
        F.count_if(negative).alias("negative_reviews"),
        F.min_by("message", F.when(negative, F.struct("rating_value", "post_id"))).alias(
            "negative_case"
        ),
    )


def search_inflow(searches: DataFrame, as_of: date, latest_days: int = 7) -> DataFrame:
    """Distinct searches that led to a product in the last days.

    Searches that led nowhere are dropped before they can form one big group.
    """
    return (
        searches.filter(F.col("product_id").isNotNull())
        .filter(within(F.col("day"), as_of - timedelta(days=latest_days), as_of))
        .groupBy("product_id")
        .agg(F.countDistinct("idx").alias("search_count"))
    )
