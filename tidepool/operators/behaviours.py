"""Raw event logs to one row per user, item and event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.columns import category_of, first_of, normalise_item_id
from tidepool.functions.dates import in_window

# The logged event names, their codes, and the prefix the log puts before a name.
EVENT_PREFIX = "adjust:callback:"
EVENT_CODES = {"ViewContent": 1, "AddToCart": 2, "revenue": 3}
VIEW, CART, PURCHASE = EVENT_CODES
# Ids sent by devices that hide theirs. Known test devices are added by the caller.
DENIED_IDS = ("", "00000000-0000-0000-0000-000000000000")


def behaviour_code(name: Column) -> Column:
    """Code of an event name; NULL for any other name."""
    (first, code), *others = EVENT_CODES.items()
    cases = F.when(name == first, F.lit(code))
    for other, code in others:
        cases = cases.when(name == other, F.lit(code))
    return cases.cast("int")


def _item_rows(events: DataFrame, denied_ids: Sequence[str]) -> DataFrame:
    # A missing item list makes no row here, so no second look into the JSON is needed.
    kept = events.filter(~F.col("ad_id").isin(*denied_ids))
    listed = kept.withColumn("item", F.explode(F.split("items", ",")))
    return listed.select(
        "ad_id", normalise_item_id(F.col("item")).alias("item_id"), "behavior_name", "ts", "dt"
    )


def item_events(
    raw: DataFrame,
    stores: Sequence[str],
    denied_ids: Sequence[str] = DENIED_IDS,
    names: Sequence[str] = tuple(EVENT_CODES),
) -> DataFrame:
    """Events of the given stores and kinds, one row per item listed in the event.

    ``raw`` holds a map of string lists per row, a log type and a day.
    Rows without an item field, and denied or missing device ids, are left out.
    """
    data = F.col("data")
    items = F.get_json_object(first_of(data, "partnerparameters"), "$.content_id")
    events = raw.filter(
        F.col("log_type").isin(*[EVENT_PREFIX + name for name in names])
        & first_of(data, "storeid").isin(*stores)
    ).select(
        first_of(data, "adid").alias("ad_id"),
        items.alias("items"),
        F.replace(first_of(data, "event"), F.lit(EVENT_PREFIX), F.lit("")).alias("behavior_name"),
        first_of(data, "createdat").try_cast("bigint").alias("ts"),
        "dt",
    )
    return _item_rows(events, denied_ids)


def item_events_json(
    raw: DataFrame,
    stores: Sequence[str],
    denied_ids: Sequence[str] = DENIED_IDS,
    names: Sequence[str] = tuple(EVENT_CODES),
) -> DataFrame:
    """As :func:`item_events`, from a log with one JSON text per row (column ``row``)."""
    # Each text is parsed once for all its fields; rows of other kinds leave before the next one.
    kinds = raw.select(
        "dt", F.json_tuple("row", "_u", "_m", "timestamp", "_d").alias("ad_id", "event", "ts", "d")
    ).filter(F.col("event").isin(*[EVENT_PREFIX + name for name in names]))
    ours = kinds.select(
        "dt", "ad_id", "event", "ts",
        F.json_tuple("d", "StoreId", "PartnerParameters").alias("store", "parameters"),
    ).filter(F.col("store").isin(*stores))
    events = ours.select(
        "ad_id",
        F.get_json_object("parameters", "$.content_id").alias("items"),
        F.replace("event", F.lit(EVENT_PREFIX), F.lit("")).alias("behavior_name"),
        F.col("ts").try_cast("bigint").alias("ts"),
        "dt",
    )
    return _item_rows(events, denied_ids)


def to_behaviours(events: DataFrame) -> DataFrame:
    """Item events as behaviour rows: names as codes, empty item ids left out."""
    return events.filter(~F.col("item_id").isin("", " ")).select(
        "ad_id",
        "item_id",
        behaviour_code(F.col("behavior_name")).alias("behavior_type"),
        "ts",
        "dt",
    )


def extract_behaviours(
    raw: DataFrame, stores: Sequence[str], denied_ids: Sequence[str] = DENIED_IDS
) -> DataFrame:
    return to_behaviours(item_events(raw, stores, denied_ids))


def extract_behaviours_json(
    raw: DataFrame, stores: Sequence[str], denied_ids: Sequence[str] = DENIED_IDS
) -> DataFrame:
    return to_behaviours(item_events_json(raw, stores, denied_ids))


def category_counts(events: DataFrame, as_of: str) -> DataFrame:
    """Events per item category on the day ``as_of``."""
    day = events.filter(in_window(F.col("dt"), as_of, 0, 0))
    return day.groupBy(category_of(F.col("item_id")).alias("category")).agg(
        F.count("*").alias("counts")
    ).withColumn("dt", F.lit(as_of))
