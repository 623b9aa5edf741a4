"""Businesses and their reviews: flatten, bucket the rating, join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the five ratings.
SENTIMENTS = {1: "very negative", 2: "negative", 3: "neutral", 4: "positive", 5: "very positive"}

EXPECTATIONS = {"name_not_null": "name IS NOT NULL", "noiselevel_not_null": "noiselevel IS NOT NULL"}


def sentiment(stars: Column) -> Column:
    chain = None
    for value, name in SENTIMENTS.items():
        chain = F.when(stars == value, name) if chain is None else chain.when(stars == value, name)
    return chain


def silver_business(raw: DataFrame) -> DataFrame:
    return raw.select(
        "business_id",
        "name",
        "address",
        "city",
        "hours",
        F.col("attributes.WiFi").alias("wifi"),
        F.col("attributes.NoiseLevel").alias("noiselevel"),
        F.coalesce("attributes.DogsAllowed", F.lit("False")).alias("dogsallowed"),
        F.col("attributes.Open24Hours").alias("open24hours"),
        "is_open",
        "review_count",
        "stars",
    )


def silver_review(raw: DataFrame) -> DataFrame:
    return raw.select(
        "business_id",
        "review_id",
        "user_id",
        "date",
        "text",
        "stars",
        sentiment(F.col("stars")).alias("review_sentiment"),
    )


def feedback(business: DataFrame, review: DataFrame) -> DataFrame:
    b = business.select(
        "business_id", "name", "address", "wifi", "noiselevel", "dogsallowed", "open24hours", "stars", "is_open"
    )
    return b.join(review.select("business_id", "review_id", "date", "text", "review_sentiment"), "business_id")
