"""Customer-dimension operators: base row (C1), distinct dimension subsets
(C2/C19), test-account flag (C22), classification fallback and labels (C23),
chained-key joins (J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import label

KEY = "customer_uid"

# Classifications that exclude a customer from bonuses.
DO_NOT_BONUS_CLASSES = ("D", "F", "KAMBI - Wiseguy", "KAMBI - Arber", "Wiseguy",
                        "Arber", "Monitoring", "Monitoring 1", "Monitoring 2")

SEGMENT_SCORES = [
    "cross_product_historical_value_score_current", "cross_product_historical_value_segment_current",
    "sports_historical_value_score_current", "sports_historical_value_segment_current",
    "casino_historical_value_score_current", "casino_historical_value_segment_current",
]


def customer_base(customers: DataFrame, classification: DataFrame, segmentation: DataFrame) -> DataFrame:
    """Customer dimension with its manual-classification flag (default
    false) and segmentation scores (NULL when the customer is unscored)."""
    fcc = classification.select("customer_id", "manually_classified")
    msm = segmentation.select(KEY, F.col("predicted_margin").cast("double").alias("predicted_margin"),
                              *SEGMENT_SCORES)
    return (customers.select("customer_id", KEY, "registration_date", "etl_created", "etl_modified",
                             "acquisition_channel")
            .join(fcc, "customer_id", "left")
            .join(msm, KEY, "left")
            .select("customer_id", KEY, "registration_date", "etl_created", "etl_modified",
                    "acquisition_channel",
                    F.coalesce("manually_classified", F.lit(False)).alias("manually_classified"),
                    "predicted_margin", *SEGMENT_SCORES))


def theoretical_margin(rating: DataFrame) -> DataFrame:
    """Distinct rating rows per customer."""
    return rating.select(
        F.col("uuid").alias(KEY),
        F.col("margin").cast("double").alias("predicted_margin"),
        F.col("margin_prematch").cast("double").alias("margin_prematch_predicted"),
        F.col("margin_live").cast("double").alias("margin_live_predicted"),
        F.col("betsize_prematch").alias("avg_prematch_betslip_predicted"),
        F.col("betsize_live").alias("avg_live_betslip_predicted")).distinct()


def last_stake(stats: DataFrame) -> DataFrame:
    """Distinct (customer, last stake) pairs."""
    return stats.select(KEY, F.col("last_betslip_stake").cast("double").alias("last_betslip_stake")).distinct()


def test_players(customers: DataFrame) -> DataFrame:
    """Distinct customers flagged as test players (the J10 subset)."""
    return customers.filter(F.col("is_test_player") == True).select(KEY, "customer_id").distinct()  # noqa: E712


def flag_join(customers: DataFrame, classification: DataFrame) -> DataFrame:
    """C22 + P5: ``test_account_flag`` from a left join to the distinct test
    subset, and ``manually_classified`` defaulted to false."""
    gta = test_players(customers).select(F.col(KEY).alias("_test_uid"))
    fcc = classification.select("customer_id", "manually_classified")
    return (customers.select(KEY, "customer_id")
            .join(gta, F.col(KEY) == F.col("_test_uid"), "left")
            .join(fcc, "customer_id", "left")
            .select(KEY, F.col("_test_uid").isNotNull().alias("test_account_flag"),
                    F.coalesce("manually_classified", F.lit(False)).alias("manually_classified")))


def classification_name(customers: DataFrame, classification: DataFrame, ref: DataFrame) -> DataFrame:
    """C23 lookup chain: customer -> classification fact -> reference name,
    falling back to the customer's own category."""
    return (customers.select(KEY, "customer_id", "punter_category_current")
            .join(classification.select("customer_id", "classification_id"), "customer_id", "left")
            .join(ref, "classification_id", "left")
            .select(KEY, F.coalesce("classification_name", "punter_category_current")
                    .alias("classification_name_current")))


def do_not_bonus(name: str | Column = "classification_name_current") -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return label(c.isin(*DO_NOT_BONUS_CLASSES), "True", "False")


def classification_fallback(customers: DataFrame, classification: DataFrame, ref: DataFrame) -> DataFrame:
    return classification_name(customers, classification, ref).select(
        KEY, "classification_name_current", do_not_bonus().alias("do_not_bonus"))


def labels_from_flags(customers: DataFrame) -> DataFrame:
    """Text labels and presence flags of the customer row."""
    return customers.select(
        KEY,
        do_not_bonus("punter_category_current").alias("do_not_bonus"),
        F.col("ftd_date").isNotNull().alias("deposited"),
        label("is_locked", "yes", "no").alias("locked_label"),
        label("is_test_player", "true", "false").alias("test_label"))


def chained_join(base: DataFrame, via: DataFrame, via_key: str, others: list[DataFrame],
                 key: str = KEY) -> DataFrame:
    """Left-join ``others`` on the key of an earlier, nullable side.

    The reference joins later inputs on ``via.customer_uid``; because that
    column equals ``base.customer_uid`` whenever it is set, the condition is
    written as the base key *plus* "``via`` matched". Results are the same,
    and Spark keeps the base's hash partitioning for every later join instead
    of re-shuffling the wide row on a second key.
    """
    out = base.join(via, key, "left")
    matched = F.col(via_key).isNotNull()
    for o in others:
        okey = f"_{id(o)}_k"
        o2 = o.withColumnRenamed(key, okey)
        out = out.join(o2, (F.col(key) == F.col(okey)) & matched, "left").drop(okey)
    return out
