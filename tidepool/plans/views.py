"""The given tables as the inputs of the jobs: logs, impressions, creatives, documents, vectors."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepool.functions.columns import parse_int_list
from tidepool.operators.behaviours import (
    DENIED_IDS, EVENT_PREFIX, item_events, to_behaviours,
)
from tidepool.operators.evaluate import LISTS
from tidepool.operators.features import feature_config, impression_items, user_behaviour_json
from tidepool.operators.items import active_items
from tidepool.operators.joins import join_next_day
from tidepool.operators.sequences import (
    backfill_user_features, number_items, user_behaviour_arrays,
)
from tidepool.shared import cut_lineage

AS_OF = "2024-01-16"
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"
STORES = ("shop-app", "100200300")
DENIED = (*DENIED_IDS, "13")
CATALOGS = tuple(range(1, 11))
ACTIVE_CAP = 60
CONFIG = {
    "dense": ["label", "value", "value_text", "flag"],
    "sparse": ["kind", "hour"],
    "embedding": ["items", "ids", "parts", "none"],
    "weighted_embedding": ["weights", "empty"],
    "labels": ["ctr_label", "cvr_label"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores when the files give fewer splits than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def micros(name: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    ts = F.col(name).cast("timestamp_ntz")
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.expr(f"extract(second from cast({name} as timestamp_ntz))")
                                  * 1_000_000).cast("bigint")


def _day(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _in_january(ts: str) -> Column:
    """A day of the thirty in the log for any date."""
    days = F.pmod(F.datediff(F.to_date(ts), F.lit("1995-01-01").cast("date")), F.lit(30))
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), days), "yyyy-MM-dd")


def _item_of(k: Column) -> Column:
    return F.concat(F.lit("c"), (k % 10).cast("string"), F.lit(":"), k.cast("string"))


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    k, k2 = F.col("k"), (F.col("k") + 7) % 100
    one = F.concat(F.lit("9:"), _item_of(k))
    both = F.concat(one, F.lit(", 9:"), _item_of(k2))
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("ad_id"),
        micros("ts").alias("ts"),
        _day("ts").alias("dt"),
        # Sign-ups come from another store, errors are of another log type without items.
        F.when(kind == "signup", "elsewhere").when(kind == "view", STORES[0])
        .otherwise(STORES[1]).alias("store"),
        F.when(kind == "click", "AddToCart").when(kind == "purchase", "revenue")
        .when(kind == "error", "error").otherwise("ViewContent").alias("name"),
        F.when(kind != "error", F.when(F.col("event_id") % 2 == 0, both).otherwise(one))
        .alias("items"),
    )


def raw_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(column: Column) -> Column:
        return F.array(column.cast("string"))

    name = F.concat(F.lit(EVENT_PREFIX), F.col("name"))
    parameters = F.to_json(F.struct(F.col("items").alias("content_id")))
    return _logged(spark, sf_dir).select(
        F.create_map(
            F.lit("partnerparameters"), listed(parameters),
            F.lit("adid"), listed(F.col("ad_id")),
            F.lit("event"), listed(name),
            F.lit("createdat"), listed(F.col("ts")),
            F.lit("storeid"), listed(F.col("store")),
        ).alias("data"),
        name.alias("log_type"),
        "dt",
    )


def raw_tracker_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parameters = F.to_json(F.struct(F.col("items").alias("content_id")))
    row = F.struct(
        F.struct(parameters.alias("PartnerParameters"), F.col("store").alias("StoreId")).alias("_d"),
        F.col("ad_id").alias("_u"),
        F.concat(F.lit(EVENT_PREFIX), F.col("name")).alias("_m"),
        F.col("ts").alias("timestamp"),
    )
    return _logged(spark, sf_dir).select(F.to_json(row).alias("row"), "dt")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_events(raw_event_log(spark, sf_dir), STORES, DENIED)


def behaviours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_behaviours(events(spark, sf_dir))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_items(behaviours(spark, sf_dir), AS_OF, cap=ACTIVE_CAP)


def daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Behaviours and active items as the stored tables that the later jobs of a day read."""
    rows = cut_lineage(behaviours(spark, sf_dir))
    return rows, cut_lineage(active_items(rows, AS_OF, cap=ACTIVE_CAP))


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("ots"),
        F.col("o_custkey").cast("string").alias("ad_id"),
        (F.col("o_orderkey") % 200).alias("creative_id"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("uuid"),
        F.round(F.col("o_totalprice") * 1e6).cast("bigint").alias("sales_e6"),
        F.when(status == "F", 1).otherwise(0).alias("postback"),
        F.when(status != "O", 1).otherwise(0).alias("click"),
        _in_january("o_orderdate").alias("dt"),
    )


def extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ots"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("social_welfare"),
        _in_january("o_orderdate").alias("dt"),
    )


def shown_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("ots"),
        (F.col("l_orderkey") % 200).alias("creative_id"),
        _item_of(F.col("l_partkey") % 100).alias("mc_item_id"),
        _in_january("l_shipdate").alias("dt"),
    )


def creatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("creative_id"),
        F.when(F.col("p_size") <= 40, F.col("p_size")).alias("merchandise_catalog_id"),
    )


def catalogue_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impression_items(
        impressions(spark, sf_dir), shown_items(spark, sf_dir), creatives(spark, sf_dir),
        CATALOGS, AS_OF,
    )


def feature_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ots"),
        F.col("o_custkey").cast("string").alias("ad_id_plus"),
        F.concat(F.lit("cmp"), (F.col("o_orderkey") % 50).cast("string")).alias("campaign_id"),
        F.to_json(F.struct(price.alias("price"), F.lit("cf").alias("source"))).alias("cf"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("priority"))).alias("cxf"),
        F.to_json(F.struct(F.col("o_custkey").alias("customer"), F.lit("uf").alias("source")))
        .alias("uf"),
        F.when(F.col("o_orderstatus") != "O", 1.0).otherwise(0.0).alias("click"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("postback"),
        _in_january("o_orderdate").alias("dt"),
    )


def behaviour_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_behaviour_json(user_behaviour_arrays(events(spark, sf_dir), AS_OF))


def feature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature document per event, with values of every kind and some of wrong types."""
    events = spread(table(spark, sf_dir, "events")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    k, k2 = F.col("k"), (F.col("k") + 7) % 100
    category = F.concat(F.lit("c"), (k % 10).cast("string"))
    document = F.struct(
        F.col("value").alias("value"),
        F.col("value").cast("string").alias("value_text"),
        F.lit(True).alias("flag"),
        F.col("event_type").alias("kind"),
        F.hour("ts").alias("hour"),
        F.array(_item_of(k), _item_of(k2)).alias("items"),
        F.array(k, k2).alias("ids"),
        F.array(F.lit(0.5), F.lit(1.5)).alias("parts"),
        F.array().cast("array<string>").alias("none"),
        F.create_map(category, F.col("value"), F.lit("all"), F.lit(1.0)).alias("weights"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
        .alias("empty"),
        F.lit("x").alias("not_in_catalogue"),
    )
    return events.select(
        "event_id",
        F.to_json(document).alias("features"),
        F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("value") > 50, 1.0).otherwise(0.0).alias("cvr_label"),
    )


def catalogue(spark: SparkSession) -> DataFrame:
    return feature_config(spark, CONFIG)


def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every time a customer bought a part: the quantity."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item"), "l_quantity"
    )
    return lines.join(orders, "o_orderkey").select("user", "item", F.col("l_quantity").alias("score"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user-item scores: the quantities each customer bought of each part."""
    return purchase_lines(spark, sf_dir).groupBy("user", "item").agg(F.sum("score").alias("score"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item"), F.col("embedding").alias("vector")
    )


def _run_days() -> list[str]:
    first, last = date.fromisoformat(FIRST_DAY), date.fromisoformat(LAST_DAY)
    return [(first + timedelta(days=n + 1)).isoformat() for n in range((last - first).days + 1)]


def labelled_rows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Every behaviour of the month on an active item, with an id of its own."""
    return number_items(rows, items).select(
        "ad_id",
        F.concat_ws(":", "ad_id", F.col("ts").cast("string"), F.col("item_no").cast("string"),
                    F.col("behavior_type").cast("string")).alias("row_id"),
        "item_no",
        "dt",
    )


def month_profiles(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The features of every user and day of the month with five items or more."""
    features = backfill_user_features(rows, items, _run_days())
    enough = features.filter(F.col("n_items") >= 5)
    lists = [parse_int_list(F.col(name)).alias(name) for name in LISTS]
    return enough.select(
        "ad_id", "dt", F.concat_ws(":", "ad_id", "dt").alias("profile"), *lists
    )


def month_samples(rows: DataFrame, items: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every behaviour of the month with the user's profile of the day before, by its id."""
    known = profiles.select("ad_id", "dt", "profile").distinct()
    return join_next_day(labelled_rows(rows, items), known)


