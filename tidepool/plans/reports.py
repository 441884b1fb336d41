"""The daily business reports on reach, performance and cold start.

Every report adds up per user or per impression group before it counts users, so
that a user with very many impressions is one row by the time users are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.columns import least_strict, safe_ratio
from tidepool.functions.dates import in_window, shift_day
from tidepool.operators.behaviours import CART, DENIED_IDS, PURCHASE, VIEW
from tidepool.operators.joins import keep_known

WELFARE_CAP = 1e5
MICROS = 1e6


def selected_creatives(creatives: DataFrame, catalogs: Sequence[int]) -> DataFrame:
    chosen = creatives.filter(F.col("merchandise_catalog_id").isin(*catalogs))
    return chosen.select("creative_id")


def welfare(extension: DataFrame) -> DataFrame:
    return extension.select(
        "ots", least_strict(F.col("social_welfare"), WELFARE_CAP).alias("sw")
    )


def _ratios() -> list[Column]:
    """The rates of a row that holds ``sales, sales_e6, vimp, pb, click``."""
    sales, vimp, pb, click = (F.col(c) for c in ("sales", "vimp", "pb", "click"))
    return [
        safe_ratio(click, vimp, 5).alias("vctr"),
        safe_ratio(pb, click, 5).alias("cvr"),
        safe_ratio(pb, vimp, 5).alias("vctcvr"),
        safe_ratio(F.col("sales_e6") / F.lit(MICROS) * 1000, vimp, 0).alias("vrpm"),
        safe_ratio(sales, pb, 0).alias("cpa"),
    ]


def _is(name: str) -> Column:
    return F.when(F.col("behavior_name") == name, 1).otherwise(0)


ANY_AD = ("total_events", "users_count", "items_count", "view_count", "add_to_car_count", "revenue_count")
CATALOG_AD = ("total_events", "unique_users_count", "unique_items_count", "total_view_count",
              "total_add_to_car_count", "total_revenue_count")


def per_item_counts(events: DataFrame) -> DataFrame:
    """``ad_id, item_id, n, views, carts, purchases``."""
    return events.groupBy("ad_id", "item_id").agg(
        F.count("*").alias("n"),
        F.sum(_is(VIEW)).alias("views"),
        F.sum(_is(CART)).alias("carts"),
        F.sum(_is(PURCHASE)).alias("purchases"),
    )


def _event_totals(events: DataFrame, users: DataFrame, names: Sequence[str]) -> DataFrame:
    per_item = per_item_counts(events)
    return totals(keep_known(per_item, users, "ad_id"), names)


def totals(per_item: DataFrame, names: Sequence[str]) -> DataFrame:
    total, n_users, n_items, views, carts, purchases = names
    return per_item.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(total),
        F.count_distinct("ad_id").alias(n_users),
        F.count_distinct("item_id").alias(n_items),
        F.sum("views").alias(views),
        F.sum("carts").alias(carts),
        F.sum("purchases").alias(purchases),
    )


def event_totals(events: DataFrame, impressions: DataFrame, as_of: str) -> DataFrame:
    """Yesterday's events of the users who saw any ad within 30 days."""
    seen = impressions.filter(in_window(F.col("dt"), as_of, -29, 0))
    day = events.filter(in_window(F.col("dt"), as_of, -1, -1))
    return _event_totals(day, seen, ANY_AD)


def event_totals_catalog(
    events: DataFrame,
    impressions: DataFrame,
    creatives: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
) -> DataFrame:
    """A week's events of the users who saw an ad of the given catalogues within 30 days."""
    seen = impressions.filter(in_window(F.col("dt"), as_of, -29, 0)).join(
        selected_creatives(creatives, catalogs), "creative_id"
    )
    week = events.filter(in_window(F.col("dt"), as_of, -7, -1))
    return _event_totals(week, seen, CATALOG_AD)


def user_overlap(events: DataFrame, impressions: DataFrame, as_of: str) -> DataFrame:
    """How many of yesterday's event users saw an ad within 30 days."""
    seen = impressions.filter(in_window(F.col("dt"), as_of, -29, 0)).select("ad_id").distinct()
    active = events.filter(in_window(F.col("dt"), as_of, -1, -1)).select("ad_id").distinct()
    return active.join(seen, "ad_id", "left_semi").agg(F.count("ad_id").alias("users_count"))


def item_response(
    impressions: DataFrame,
    items: DataFrame,
    extension: DataFrame,
    creatives: DataFrame,
    events: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
    denied_ids: Sequence[str] = DENIED_IDS,
) -> DataFrame:
    """Impressions of a week with what the user did on the shown item the same day.

    An impression counts once per kind of behaviour found (and once when there is none).
    """
    def week(df: DataFrame) -> DataFrame:
        return df.filter(in_window(F.col("dt"), as_of, -7, -1))

    shown = (
        week(impressions)
        .filter(~F.col("ad_id").isin(*denied_ids))
        .join(selected_creatives(creatives, catalogs), "creative_id")
        .join(week(items).select("ots", "mc_item_id"), "ots")
        .join(week(extension).select("ots"), "ots")
        .groupBy("dt", "ad_id", "mc_item_id")
        .agg(
            F.sum("sales_e6").alias("sales_e6"),
            F.sum(F.col("sales_e6") / F.lit(MICROS)).alias("sales"),
            F.count("ots").alias("vimp"),
            F.sum("postback").alias("pb"),
            F.sum("click").alias("click"),
        )
    )
    kinds = week(events).select("ad_id", "item_id", "dt", "behavior_name").distinct()
    done = kinds.groupBy("ad_id", "item_id", "dt").agg(
        F.count("*").alias("kinds"),
        F.max(_is(VIEW)).alias("view"),
        F.max(_is(CART)).alias("cart"),
        F.max(_is(PURCHASE)).alias("purchase"),
    ).withColumnRenamed("item_id", "mc_item_id")

    joined = shown.join(done, ["ad_id", "mc_item_id", "dt"], "left")
    times = F.coalesce(F.col("kinds"), F.lit(1))

    def total(column: str) -> Column:
        return F.sum(F.col(column) * times).alias(column)

    def found(flag: str) -> Column:
        return F.sum(F.col("vimp") * F.coalesce(F.col(flag), F.lit(0))).alias(flag)

    # One row per day and item: counting these rows counts distinct items.
    per_item = joined.groupBy("dt", "mc_item_id").agg(
        F.max(F.when(F.col("kinds").isNotNull(), 1)).alias("met"),
        found("view"), found("cart"), found("purchase"),
        total("sales_e6"), total("sales"), total("vimp"), total("pb"), total("click"),
    )
    per_day = per_item.groupBy("dt").agg(
        F.count("mc_item_id").alias("unique_active_item_count"),
        F.count("met").alias("unique_behavior_item_count"),
        F.sum("view").alias("active_ui_view_count"),
        F.sum("cart").alias("active_ui_add_to_car_count"),
        F.sum("purchase").alias("active_ui_revenue_count"),
        *[F.sum(c).alias(c) for c in ("sales_e6", "sales", "vimp", "pb", "click")],
    )
    return per_day.select("*", *_ratios()).drop("sales_e6").orderBy("dt")


def performance(
    impressions: DataFrame,
    extension: DataFrame,
    creatives: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
) -> DataFrame:
    """Yesterday's reach, sales and rates of the given catalogues' ads."""
    shown = (
        impressions.filter(in_window(F.col("dt"), as_of, -1, -1))
        .join(selected_creatives(creatives, catalogs), "creative_id")
        .join(welfare(extension), "ots")
    )
    per_user = shown.groupBy("dt", "uuid").agg(
        F.sum("sales_e6").alias("sales_e6"),
        F.sum(F.col("sales_e6") / F.lit(MICROS)).alias("sales"),
        F.count("ots").alias("vimp"),
        F.sum("postback").alias("pb"),
        F.sum("click").alias("click"),
        F.sum("sw").alias("sw"),
    )
    per_day = per_user.groupBy("dt").agg(
        F.count("uuid").alias("uu"),
        *[F.sum(c).alias(c) for c in ("sales_e6", "sales", "vimp", "pb", "click", "sw")],
    )
    return per_day.select(
        "dt", "uu", "sales", "vimp", "pb", "click", *_ratios(), "sw"
    ).orderBy("dt")


def cold_start(
    impressions: DataFrame,
    extension: DataFrame,
    creatives: DataFrame,
    events: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
    min_impressions: int = 100,
    min_behaviours: int = 10,
) -> DataFrame:
    """Ad results of the last three days by what was known of the user in the six days before.

    A user is ad-cold with fewer than ``min_impressions`` impressions then, and
    behaviour-cold with fewer than ``min_behaviours`` events; none at all sets no flag.
    """
    def baseline(df: DataFrame) -> DataFrame:
        return df.filter(in_window(F.col("dt"), as_of, -9, -4))

    ad_cold = (
        baseline(impressions).groupBy("ad_id").agg(F.count("*").alias("n"))
        .filter(F.col("n") < min_impressions)
        .select("ad_id", F.lit(1).alias("ad_cold_start"))
    )
    behaviour_cold = (
        baseline(events).groupBy("ad_id").agg(F.count("behavior_name").alias("n"))
        .filter(F.col("n") < min_behaviours)
        .select("ad_id", F.lit(1).alias("behavior_cold_start"))
    )
    capped = welfare(extension.filter(in_window(F.col("dt"), as_of, -9, -1)))
    per_user = (
        impressions.filter(in_window(F.col("dt"), as_of, -3, -1))
        .join(selected_creatives(creatives, catalogs), "creative_id")
        .join(capped, "ots")
        .groupBy("ad_id")
        .agg(
            F.sum(F.col("sales_e6") / F.lit(MICROS)).alias("sales"),
            F.sum("sw").alias("sw"),
            F.count("*").alias("vimp"),
            F.sum("click").alias("click"),
            F.sum("postback").alias("pb"),
        )
        .join(ad_cold, "ad_id", "left")
        .join(behaviour_cold, "ad_id", "left")
    )
    label = (
        F.when(F.col("ad_cold_start") == 1, "ad_cold_start")
        .when(F.col("behavior_cold_start") == 1, "behavior_cold_start")
        .otherwise("without_cold_start")
    )

    def flagged(flag: str) -> Column:
        return F.count(F.when(F.col(flag) == 1, F.col("ad_id")))

    return per_user.groupBy(
        F.lit(shift_day(as_of, -4)).alias("dt"), label.alias("label")
    ).agg(
        F.count("ad_id").alias("cold_start_user_count"),
        F.sum("sales").alias("sales"),
        F.sum("sw").alias("sw"),
        F.sum("vimp").alias("vimp"),
        F.sum("click").alias("click"),
        F.sum("pb").alias("pb"),
        flagged("ad_cold_start").alias("ad_cold_start_user_count"),
        flagged("behavior_cold_start").alias("behavior_cold_start_user_count"),
    ).orderBy("dt", "label")


def reach_split(
    impressions: DataFrame,
    extension: DataFrame,
    creatives: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
) -> DataFrame:
    """Two days of reach and results: all ads, ads with a catalogue, ads of the given catalogues."""
    def window(df: DataFrame) -> DataFrame:
        return df.filter(in_window(F.col("dt"), as_of, -2, -1))

    # Creatives without a catalogue match too, with a NULL catalogue.
    catalogue = creatives.select("creative_id", "merchandise_catalog_id")
    joined = (
        window(impressions)
        .select("dt", "ots", "ad_id", "creative_id",
                (F.col("sales_e6") / F.lit(MICROS)).alias("sales"),
                F.lit(1).alias("vimp"), F.col("postback").alias("pb"), "click")
        .join(welfare(window(extension)), "ots")
        .join(catalogue, "creative_id", "left")
    )
    catalog = F.col("merchandise_catalog_id")
    groups = {
        "": F.lit(True),
        "_catalogue": catalog.isNotNull(),
        "_selected": F.coalesce(catalog.isin(*catalogs), F.lit(False)),
    }
    measures = ("sales", "vimp", "pb", "click", "sw")
    per_user = joined.groupBy("dt", "ad_id").agg(*[
        column
        for suffix, member in groups.items()
        for column in [
            F.max(F.when(member, 1)).alias(f"seen{suffix}"),
            *[F.sum(F.when(member, F.col(m)).otherwise(0)).alias(f"{m}{suffix}")
              for m in measures],
        ]
    ])
    per_day = []
    for suffix in groups:
        users = F.count(F.when(F.col(f"seen{suffix}") == 1, F.col("ad_id")))
        per_day.append(users.alias(f"active{suffix}_user_count"))
        per_day += [F.sum(f"{m}{suffix}").alias(f"{m}{suffix}") for m in measures]
    return per_user.groupBy("dt").agg(*per_day).orderBy("dt")
