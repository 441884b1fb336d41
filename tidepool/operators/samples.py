"""Training samples, typed examples and negatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.columns import hash_draw, parse_int_list, unique_sorted
from tidepool.functions.dates import next_day
from tidepool.operators.joins import join_next_day, salted_join
from tidepool.operators.sequences import number_items

SEQUENCE_COLUMNS = ("item_seq", "behavior_seq", "item_car", "item_purchase", "item_category")


def _one_per_user(sequences: DataFrame, min_items: int) -> DataFrame:
    """The first slice of every sequence with ``min_items`` items or more in all its slices."""
    return sequences.filter((F.col("part") == 0) & (F.col("n_items") >= min_items))


def _targets(behaviours: DataFrame, items: DataFrame, day: str) -> DataFrame:
    numbered = number_items(behaviours.filter(F.col("dt") == day), items)
    return numbered.select(
        "ad_id", F.col("item_no").alias("item_target"), F.col("behavior_type").alias("label"), "dt"
    )


def train_sample(
    behaviours: DataFrame, items: DataFrame, features: DataFrame, day: str, min_items: int = 5
) -> DataFrame:
    """Each behaviour of ``day`` as the target of the user's features of the day before.

    One row per behaviour. Users with fewer than ``min_items`` items are left out. A sequence
    of several slices is not copied to every target: the sample has the first one, and
    :func:`with_slices` adds the others once for each user.
    """
    enough = _one_per_user(features, min_items)
    joined = join_next_day(_targets(behaviours, items, day), enough)
    return joined.select("ad_id", *SEQUENCE_COLUMNS, "item_target", "label", "dt")


def train_sample_conversions(
    behaviours: DataFrame,
    items: DataFrame,
    sessions: DataFrame,
    day: str,
    labels: Sequence[int] = (2, 3),
    min_items: int = 5,
) -> DataFrame:
    """Carts and purchases of ``day`` as targets of the user's session of the day before.

    One row per behaviour; of a session of several slices the first, as in :func:`train_sample`.
    """
    enough = _one_per_user(sessions, min_items)
    targets = _targets(behaviours, items, day).filter(F.col("label").isin(*labels))
    return join_next_day(targets, enough).select(
        "ad_id", "item_nos", "behavior_types", "item_target", "label", "dt"
    )


def with_slices(sample: DataFrame, sequences: DataFrame) -> DataFrame:
    """The sample with ``part`` 0, and beside it the further slices of its users' sequences, so that none is cut.

    A further slice is a row with its number as ``part``, without ``item_target`` and ``label``, once for a user
    and day however many targets they have. Rows of part 0 are the targets; by user, day and part the
    lists of one target and those of the further parts are the whole sequence.
    """
    keys, kinds = ["ad_id", "dt"], dict(sample.dtypes)
    further = sequences.filter(F.col("part") > 0).withColumn("dt", next_day(F.col("dt")))
    rows = salted_join(further, sample.select(*keys).distinct(), keys, "left_semi")
    columns = [F.lit(None).cast(kinds[name]).alias(name) if name in ("item_target", "label") else F.col(name)
               for name in sample.columns]
    return sample.withColumn("part", F.lit(0)).unionByName(rows.select(*columns, F.col("part").cast("int").alias("part")))


def _further_values(features: DataFrame) -> DataFrame:
    """The distinct values that the slices after the first add to each list of a user and day.

    Lists hold numbers of listed items and codes, so a set is no longer than the item list.
    """
    entries = F.array(*[
        F.struct(F.lit(name).alias("list"), parse_int_list(F.col(name)).alias("entries"))
        for name in SEQUENCE_COLUMNS
    ])
    values = features.filter(F.col("part") > 0).select("ad_id", "dt", F.inline(entries)).select(
        "ad_id", "dt", "list", F.explode("entries").alias("value")
    )
    sets = values.groupBy("ad_id", "dt", "list").agg(F.collect_set("value").alias("more"))
    return sets.groupBy("ad_id", "dt").agg(*[
        F.max(F.when(F.col("list") == name, F.sort_array("more"))).alias(f"_more_{name}")
        for name in SEQUENCE_COLUMNS
    ])


def to_examples(
    samples: DataFrame, features: DataFrame | None = None, unique: bool = True, min_items: int = 5
) -> DataFrame:
    """Samples in text form as typed lists.

    With ``unique`` every list becomes its sorted distinct values, and only
    samples with more than ``min_items`` distinct items stay. ``features`` is the
    table the samples were made of; its slices after the first count, too.
    """
    lists = {name: parse_int_list(F.col(name)) for name in SEQUENCE_COLUMNS}
    if unique:
        if features is not None:
            following = _further_values(features).withColumn("dt", next_day(F.col("dt")))
            samples = salted_join(samples, following, ["ad_id", "dt"], "left")
            none = F.array().cast("array<bigint>")
            lists = {name: F.concat(values, F.coalesce(F.col(f"_more_{name}"), none))
                     for name, values in lists.items()}
        lists = {name: unique_sorted(values) for name, values in lists.items()}
    typed = samples.select(
        "ad_id",
        *[values.alias(name) for name, values in lists.items()],
        F.col("item_target").cast("bigint").alias("item_target"),
        F.col("label").cast("bigint").alias("label"),
    )
    return typed.filter(F.size("item_seq") > min_items) if unique else typed


def downsample_negatives(
    df: DataFrame, label: str, rate: float, key: Sequence[str], seed: int = 7
) -> DataFrame:
    """All rows with a positive label and the share ``rate`` of the others.

    A row is kept or not by a hash of its key: the same rows on every run and
    after any repartitioning. A missing label counts as negative.
    """
    steps = 1_000_000
    drawn = hash_draw(steps, *[F.col(k) for k in key], seed) < int(round(rate * steps))
    return df.filter(F.when(F.col(label) > 0, F.lit(True)).otherwise(drawn))


def sample_negatives(
    rows: DataFrame,
    positives: DataFrame,
    n_items: int,
    per_row: int = 10,
    row_id: str = "row_id",
    attempts: int = 8,
    seed: int = 0,
) -> DataFrame:
    """``per_row`` items of ``1 .. n_items`` per row, none of them a positive of the row's user.

    ``rows`` has ``ad_id`` and a unique ``row_id``; ``positives`` has ``ad_id`` and the
    array ``items`` (distinct, so ``n_items`` long at most). An item is drawn by hash
    up to ``attempts`` times; a draw that always met a positive is taken from the list
    of the remaining items. A user who has every item gets no negatives.
    """
    known = positives.select("ad_id", F.col("items").alias("_own"))
    joined = salted_join(rows, known, ["ad_id"], "left")
    own = F.coalesce(F.col("_own"), F.array().cast("array<bigint>"))

    def attempt(draw: Column, number: Column) -> Column:
        return hash_draw(n_items, F.col("ad_id"), F.col(row_id), draw, number, seed) + 1

    def if_free(draw: Column, number: Column) -> Column:
        found = F.filter(F.array(attempt(draw, number)), lambda item: ~F.array_contains("_own", item))
        return F.get(found, 0)

    every_item = F.sequence(F.lit(1).cast("bigint"), F.lit(n_items).cast("bigint"))

    def negative(draw: Column) -> Column:
        # Nothing more is drawn once an item is found.
        free = F.aggregate(
            F.sequence(F.lit(0), F.lit(attempts - 1)), F.lit(None).cast("bigint"),
            lambda found, number: F.coalesce(found, if_free(draw, number)),
        )
        left_over = F.transform(
            F.array(F.array_except(every_item, F.col("_own"))),
            lambda rest: F.get(rest, F.pmod(
                attempt(draw, F.lit(attempts)), F.greatest(F.size(rest), F.lit(1))).cast("int")),
        )[0]
        return F.struct(draw.alias("draw"), F.coalesce(free, left_over).alias("negative"))

    # The user's items stay in the one row: only the results of its draws are exploded.
    draws = F.transform(F.sequence(F.lit(0), F.lit(per_row - 1)), negative)
    drawn = joined.withColumn("_own", own).select(*rows.columns, F.inline(draws))
    return drawn.filter(F.col("negative").isNotNull())


def pair_triples(negatives: DataFrame, target: str) -> DataFrame:
    """``ad_id, positive, negative``: every drawn item next to the item its row is about."""
    return negatives.select("ad_id", F.col(target).alias("positive"), "negative")


def labelled_pairs(
    rows: DataFrame, negatives: DataFrame, carried: Sequence[str], target: str
) -> DataFrame:
    """Positives with label 1 and their negatives with label 0, in one table."""
    seen = rows.select(
        "ad_id", *carried, F.col(target).cast("bigint").alias("item_no"), F.lit(1).alias("label")
    )
    unseen = negatives.select(
        "ad_id", *carried, F.col("negative").alias("item_no"), F.lit(0).alias("label")
    )
    return seen.unionByName(unseen)
