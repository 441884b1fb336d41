"""Feature documents: user behaviour JSON, click samples, merging, typing and statistics."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepool.functions.columns import json_object, merge_json
from tidepool.functions.dates import in_window, shift_day
from tidepool.operators.joins import join_short, salted_join
from tidepool.operators.numbering import number_rows
from tidepool.operators.samples import downsample_negatives
from tidepool.shared import cut_lineage

KINDS = ("dense", "embedding", "sparse", "weighted_embedding", "labels")


def user_behaviour_json(arrays: DataFrame) -> DataFrame:
    """Behaviour arrays as one JSON document per slice, with the user's flags for views and carts."""
    document = F.struct(
        F.col("content_ids").alias("content_ids_list"),
        F.col("behavior_types").alias("behavior_types_list"),
        "has_view",
        "has_add_to_car",
    )
    return arrays.select(
        "ad_id",
        "part",
        F.to_json(document, {"ignoreNullFields": "false"}).alias("user_behavior_f"),
        "dt",
    )


def impression_items(
    impressions: DataFrame,
    items: DataFrame,
    creatives: DataFrame,
    catalogs: Sequence[int],
    as_of: str,
) -> DataFrame:
    """The impressions of the day before ``as_of`` that showed catalogue items.

    One row per impression and item row of the last days; item rows repeated on
    several days repeat the impression.
    """
    labels = creatives.filter(F.col("merchandise_catalog_id").isin(*catalogs)).select(
        "creative_id", F.col("merchandise_catalog_id").alias("core_label")
    )
    shown = (
        items.filter(F.col("dt") >= shift_day(as_of, -4))
        .select("ots", "creative_id", "mc_item_id")
        .join(labels, "creative_id")
        .select("ots", "mc_item_id", "core_label")
    )
    day = impressions.filter(in_window(F.col("dt"), as_of, -1, -1))
    return day.join(shown, "ots").select("mc_item_id", "core_label", *impressions.columns)


def ctr_sample(
    shown: DataFrame,
    material: DataFrame,
    user_features: DataFrame,
    day: str,
    rate: float = 0.2,
    seed: int = 7,
) -> DataFrame:
    """Shown items with the impression's features and labels and the user's behaviour document.

    All clicked rows stay, and the share ``rate`` of the others. One row per shown item, of
    the run day ``day`` also where the impression has no material; of a user with several
    behaviour documents the first, which has the newest events; :func:`with_documents` adds
    the others once for each user.
    """
    labelled = material.select(
        "ots",
        "campaign_id",
        "cf",
        "cxf",
        "uf",
        F.col("click").cast("double").alias("ctr_label"),
        F.col("postback").cast("double").alias("cvr_label"),
    )
    base = shown.select(
        "ots",
        F.col("ad_id").alias("ad_id_plus"),
        F.col("mc_item_id").alias("item_id"),
        F.col("core_label").cast("string").alias("core_label"),
    )
    users = user_features.filter(F.col("part") == 0).select(
        F.col("ad_id").alias("ad_id_plus"), F.col("user_behavior_f").alias("itemf")
    )
    with_labels = base.join(labelled, "ots", "left")
    kept = downsample_negatives(with_labels, "ctr_label", rate, ["ots", "item_id"], seed)
    return salted_join(kept, users, ["ad_id_plus"], "left", salt_by=["ots", "item_id"]).select(
        "ots", "ad_id_plus", "campaign_id", "item_id", "core_label", "itemf", "cf", "cxf", "uf",
        "ctr_label", "cvr_label", F.lit(day).alias("dt"),
    )


def with_documents(rows: DataFrame, user_features: DataFrame, column: str) -> DataFrame:
    """Rows with a user's first behaviour document in ``column`` and ``part`` 0, and beside them the further ones.

    A further document is a row of its own, once for each user of ``rows``, with the user, the
    day, ``column`` and its number as ``part`` only.
    """
    further = user_features.filter(F.col("part") > 0).select(
        F.col("ad_id").alias("ad_id_plus"), F.col("user_behavior_f").alias(column), F.col("part").cast("int").alias("part"))
    joined = salted_join(further, rows.select("ad_id_plus", "dt").distinct(), ["ad_id_plus"])
    own = rows.withColumn("part", F.lit(0))
    return own.unionByName(joined.select(*[
        F.col(name) if name in joined.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in own.dtypes
    ]))


def merge_features(sample: DataFrame, limit: int | None = None) -> DataFrame:
    """The documents of each sample row merged into one, later ones winning.

    Only rows with a behaviour and a user document are merged. With ``limit``
    the first rows by impression, item and user come out.
    """
    complete = sample.filter(F.col("itemf").isNotNull() & F.col("uf").isNotNull())
    if limit is not None:
        complete = complete.orderBy("ots", "item_id", "ad_id_plus", "core_label").limit(limit)
    features = merge_json(F.col("itemf"), F.col("uf"), F.col("cf"), F.col("cxf"))
    return complete.select(
        "ots", "ad_id_plus", "campaign_id", "item_id", "core_label",
        features.alias("features"), "ctr_label", "cvr_label", "dt",
    )


def load_feature_config(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names per kind from a JSON file; groups of shared vocabularies are not needed here."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return {kind: list(names) for kind, names in json.loads(text).items() if kind in KINDS}


def feature_config(spark: SparkSession, config: Mapping[str, Sequence[str]]) -> DataFrame:
    """The catalogue ``(name, kind)``. A label that is a feature as well is kept as the feature."""
    features = {name for kind in KINDS[:-1] for name in config.get(kind, ())}
    rows = [(name, kind) for kind in KINDS[:-1] for name in sorted(set(config.get(kind, ())))]
    rows += [(name, "labels") for name in sorted(set(config.get("labels", ())) - features)]
    return spark.createDataFrame(rows, "name string, kind string")


def typed_features(df: DataFrame, config: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature documents as typed rows, one per document and feature of the catalogue.

    ``df`` holds ``keys``, ``features`` (a JSON object), ``label`` and optionally
    ``cvr_label``; the labels also count as features ``label``, ``ctr_label`` and
    ``cvr_label``. Values of a type the kind does not take give no row, except that an
    embedding of other elements keeps its values for the statistics (``text_values`` NULL).
    """
    labels = {"label": "label", "ctr_label": "label"}
    if "cvr_label" in df.columns:
        labels["cvr_label"] = "cvr_label"
    label_entries = F.create_map(*[
        part for name, column in labels.items()
        for part in (F.lit(name), F.col(column).cast("double").cast("variant"))
    ])
    document = F.map_filter(json_object(F.col("features")), lambda name, _: ~name.isin(*labels))
    entries = F.coalesce(F.map_concat(document, label_entries), label_entries)
    # The map is made inside the generator: as a column of its own it would be made twice,
    # once more for the check that it is not empty.
    long = df.withColumn("label", F.col("label").cast("double")).select(
        *keys, "label", F.explode(entries).alias("name", "value")
    )
    # The catalogue is configuration: some hundred names, which is checked. The type is found out once per
    # value; as the output of a generator it is not worked out again where it is tested.
    known = join_short(long, config, ["name"]).select(
        "*", F.explode(F.array(F.schema_of_variant("value"))).alias("type")
    )

    kind, type_ = F.col("kind"), F.col("type")

    def as_(sql_type: str) -> Column:
        return F.try_variant_get("value", "$", sql_type)

    integer, text = type_ == "BIGINT", type_ == "STRING"
    number = integer | (type_ == "DOUBLE") | type_.startswith("DECIMAL")
    is_number = kind.isin("dense", "labels")
    is_list, is_map = kind == "embedding", kind == "weighted_embedding"
    fits = (
        ((kind == "sparse") & (integer | text))
        | (is_number & (number | (text & as_("double").isNotNull())))
        | (is_list & type_.startswith("ARRAY<") & (type_ != "ARRAY<VOID>"))
        | (is_map & type_.startswith("OBJECT<") & (type_ != "OBJECT<>"))
    )
    values = F.when(is_list, as_("array<string>"))
    return known.filter(fits).select(
        *keys,
        "label",
        "name",
        "kind",
        F.when(kind == "sparse", as_("string")).alias("text_value"),
        F.when(is_number, as_("double")).alias("number_value"),
        F.when(type_.isin("ARRAY<BIGINT>", "ARRAY<STRING>"), values).alias("text_values"),
        values.alias("counted_values"),
        F.when(is_map, as_("map<string,double>")).alias("weights"),
    )


NUMBERS = ("count", "positive", "min", "max", "mean", "square_mean", "variance")


def statistics(typed: DataFrame) -> DataFrame:
    """All statistics of a day in one pass: ``name, kind, whole, key`` and the numbers.

    ``whole`` rows stand for a feature: a dense one, or a sparse or embedding one by
    documents. The others stand for one value (``key``) of a sparse or embedding feature, or
    for one key of a weighted one. Every document is read and taken apart once; the numbers
    are added up before anything is moved.
    """
    none = F.lit(None)

    def entry(whole: bool, key: Column, x: Column) -> Column:
        return F.struct(F.lit(whole).alias("whole"), key.cast("string").alias("key"),
                        x.cast("double").alias("x"))

    kind = F.col("kind")
    itself = F.array(entry(True, none, none))
    entries = (
        F.when(kind == "dense", F.array(entry(True, none, F.col("number_value"))))
        .when(kind == "sparse", F.concat(itself, F.array(entry(False, F.col("text_value"), none))))
        .when(kind == "embedding", F.concat(
            itself, F.transform("counted_values", lambda value: entry(False, value, none))))
        .when(kind == "weighted_embedding", F.transform(
            F.map_entries("weights"), lambda pair: entry(False, pair["key"], pair["value"])))
    )
    x = F.col("x")
    return typed.select("name", "kind", "label", F.inline(entries)).groupBy(
        "name", "kind", "whole", "key"
    ).agg(
        F.count("*").alias("count"),
        F.sum("label").alias("positive"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        F.avg(x * x).alias("square_mean"),
        F.var_pop(x).alias("variance"),
    )


def dense_stats(typed: DataFrame) -> DataFrame:
    """Count, positives, range, mean and variance of every dense feature."""
    return statistics(typed.filter(F.col("kind") == "dense")).select("name", *NUMBERS)


def category_stats(typed: DataFrame) -> DataFrame:
    """How often each value of a sparse or embedding feature occurs (``n``), with the feature's
    own count and positives by documents."""
    found = cut_lineage(statistics(typed.filter(F.col("kind").isin("sparse", "embedding"))))
    values = found.filter(~F.col("whole")).select(
        "name", "kind", F.col("key").alias("value"), F.col("count").alias("n")
    )
    totals = found.filter("whole").select("name", "kind", "count", "positive")
    return values.join(totals, ["name", "kind"])


def weighted_stats(typed: DataFrame) -> DataFrame:
    """The statistics of a dense feature for every key of a weighted feature."""
    weighted = typed.filter(F.col("kind") == "weighted_embedding")
    return statistics(weighted).select("name", "key", *NUMBERS)


def stats_report(day: str, typed: DataFrame) -> DataFrame:
    """All statistics of a day as JSON rows ``dt, name, kind, key, rank, stats``.

    One row per dense feature, per value of a category feature and per key of a
    weighted one: a feature with very many values never becomes one document. ``rank``
    orders the values of a feature by falling count, from 1; a feature's own row has none.
    Rows come by name, kind and rank.
    """
    found = statistics(typed.filter(F.col("kind") != "labels"))
    order = [F.asc("name"), F.asc("kind"), F.desc("whole"), F.desc("count"), F.asc_nulls_last("key")]
    numbered = cut_lineage(number_rows(found, order, "_n"))
    first = numbered.filter(~F.col("whole")).groupBy("name", "kind").agg(F.min("_n").alias("_first"))
    counted = F.struct("count", "positive")
    stats = (
        F.when(F.col("kind").isin("dense", "weighted_embedding"), F.to_json(F.struct(*NUMBERS)))
        .when(F.col("whole"), F.to_json(counted))
        .otherwise(F.to_json(F.struct(F.col("count").alias("n"))))
    )
    rank = F.when(~F.col("whole"), F.col("_n") - F.col("_first") + 1)
    return numbered.join(first, ["name", "kind"], "left").orderBy("_n").select(
        F.lit(day).alias("dt"), "name", "kind", "key", rank.alias("rank"), stats.alias("stats")
    )
