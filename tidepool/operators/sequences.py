"""Time-ordered sequences per user.

A sequence is stored in slices of ``PART_EVENTS`` events, numbered by ``part`` from 0 in
sequence order and cut by rank within the user, so that no task ever gathers an unbounded
group and no event is dropped. What is said about the whole sequence (its length, which
events occur in it) stands in every slice. Whoever needs one row per user takes part 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.columns import category_of
from tidepool.functions.dates import in_window, shift_day
from tidepool.operators.behaviours import CART, EVENT_CODES, PURCHASE, VIEW
from tidepool.operators.joins import join_short, salted_join
from tidepool.operators.numbering import running_total
from tidepool.shared import cut_lineage

PART_EVENTS = 1_000_000


def number_items(behaviours: DataFrame, items: DataFrame) -> DataFrame:
    """Behaviours on listed items, with the item's number."""
    return join_short(behaviours, items.select("item_id", "item_no"), ["item_id"])


def _sliced(
    rows: DataFrame, keys: Sequence[str], fields: Sequence[str], newest_first: bool, part_events: int
) -> DataFrame:
    """``keys, part, seq``: slices by rank within the key.

    Equal rows are counted first, and a running total over range partitions gives the ranks,
    so neither a key nor a moment with very many rows is ever one task's.
    """
    own = ["ts", *fields]
    counted = rows.groupBy(*keys, *own).agg(F.count("*").alias("_n"))
    turned = F.desc if newest_first else F.asc
    order = [*[F.asc(key) for key in keys], *[turned(name) for name in own]]
    placed = running_total(counted, order, "_n", "_at")
    first = placed.groupBy(*keys).agg(F.min("_at").alias("_first"))
    start = F.col("_at") - F.col("_first")
    end = start + F.col("_n")
    size = F.lit(part_events).cast("bigint")
    parted = salted_join(placed, first, keys).withColumn(
        "part", F.explode(F.sequence(F.floor(start / size), F.floor((end - 1) / size)))
    )
    within = F.least(end, (F.col("part") + 1) * size) - F.greatest(start, F.col("part") * size)
    entry = F.struct(F.struct(*own).alias("entry"), within.cast("int").alias("times"))
    gathered = F.sort_array(F.collect_list(entry), asc=not newest_first)
    repeated = F.flatten(F.transform("seq", lambda e: F.array_repeat(e["entry"], e["times"])))
    return parted.groupBy(*keys, F.col("part").cast("int").alias("part")).agg(
        gathered.alias("seq")
    ).withColumn("seq", repeated)


def user_sequences(
    rows: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    newest_first: bool = False,
    part_events: int = PART_EVENTS,
    totals: Sequence[Column] = (),
) -> DataFrame:
    """``keys, part, seq, n_items`` and ``totals``: structs of ``ts`` and ``fields`` in time order.

    The fields break ties among equal times, in the order given. ``n_items`` and ``totals``
    (named aggregates) are those of the key, the same in each of its slices.
    """
    stored = cut_lineage(rows.select(*keys, "ts", *fields))
    whole = [F.count("*").alias("n_items"), *totals]
    longest = stored.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0]
    if longest is not None and longest > part_events:
        by_key = stored.groupBy(*keys).agg(*whole)
        return _sliced(stored, keys, fields, newest_first, part_events).join(by_key, list(keys))
    # Grouped by the bare keys, the rows are already placed for a later join on them.
    gathered = F.sort_array(F.collect_list(F.struct("ts", *fields)), asc=not newest_first)
    found = stored.groupBy(*keys).agg(gathered.alias("seq"), *whole)
    return found.withColumn("part", F.lit(0))


def _text(entries: Column) -> Column:
    """Joined by commas; NULL instead of empty text. NULL entries are skipped."""
    return F.when(F.size(entries) > 0, F.array_join(entries, ","))


def _feature_rows(numbered: DataFrame, keys: Sequence[str], part_events: int) -> DataFrame:
    sequences = user_sequences(
        numbered.filter(F.col("item_no").isNotNull()),
        keys,
        ["item_id", "behavior_type", "item_no"],
        part_events=part_events,
    )

    def items_of(code: int) -> Column:
        chosen = F.filter("seq", lambda e: e["behavior_type"] == code)
        return _text(F.transform(chosen, lambda e: e["item_no"]))

    return sequences.select(
        "ad_id",
        "part",
        F.array_join(F.col("seq.item_no"), ",").alias("item_seq"),
        F.array_join(F.col("seq.behavior_type"), ",").alias("behavior_seq"),
        items_of(EVENT_CODES[CART]).alias("item_car"),
        items_of(EVENT_CODES[PURCHASE]).alias("item_purchase"),
        F.lit(None).cast("string").alias("item_category"),
        "n_items",
        *[key for key in keys if key != "ad_id"],
    )


def user_features(
    behaviours: DataFrame,
    items: DataFrame,
    as_of: str,
    days: int = 3,
    part_events: int = PART_EVENTS,
) -> DataFrame:
    """What each user viewed, put in the cart and bought in the ``days`` before ``as_of``."""
    window = behaviours.filter(in_window(F.col("dt"), as_of, -days, -1))
    rows = _feature_rows(number_items(window, items), ["ad_id"], part_events)
    return rows.withColumn("dt", F.lit(shift_day(as_of, -1)))


def backfill_user_features(
    behaviours: DataFrame,
    items: DataFrame,
    run_days: Sequence[str],
    days: int = 3,
    part_events: int = PART_EVENTS,
) -> DataFrame:
    """:func:`user_features` of several run days in one pass, with one item list for all.

    A behaviour counts for every run day up to ``days`` days after its own.
    """
    labels = sorted(shift_day(day, -1) for day in set(run_days))
    reach = F.date_format(F.date_add(F.to_date("dt"), days - 1), "yyyy-MM-dd")
    targets = F.filter(
        F.array(*[F.lit(label) for label in labels]),
        lambda label: (label >= F.col("dt")) & (label <= reach),
    )
    window = behaviours.filter(F.col("dt").between(shift_day(labels[0], 1 - days), labels[-1]))
    numbered = number_items(window, items).withColumn("dt", F.explode(targets))
    return _feature_rows(numbered, ["ad_id", "dt"], part_events)


def user_sessions(
    behaviours: DataFrame, items: DataFrame, day: str, part_events: int = PART_EVENTS
) -> DataFrame:
    """Item numbers and behaviour codes of one day per user, newest first."""
    numbered = number_items(behaviours.filter(F.col("dt") == day), items)
    sequences = user_sequences(
        numbered.filter(F.col("item_no").isNotNull()),
        ["ad_id"],
        ["item_id", "behavior_type", "item_no"],
        newest_first=True,
        part_events=part_events,
    )
    return sequences.select(
        "ad_id",
        "part",
        F.col("seq.item_no").alias("item_nos"),
        F.col("seq.behavior_type").alias("behavior_types"),
        "n_items",
        F.lit(day).alias("dt"),
    )


def user_behaviour_arrays(
    events: DataFrame,
    as_of: str,
    first: int = -7,
    last: int = -2,
    part_events: int = PART_EVENTS,
) -> DataFrame:
    """Item ids and event names per user over the window, newest first, stamped the day before.

    Whether the user has a view or a cart holds for the whole window.
    """
    def has(name: str) -> Column:
        return F.max(F.when(F.col("behavior_name") == name, 1).otherwise(0))

    window = events.filter(in_window(F.col("dt"), as_of, first, last))
    sequences = user_sequences(
        window.filter(F.col("item_id").isNotNull() & (F.col("item_id") != "")),
        ["ad_id"],
        ["item_id", "behavior_name"],
        newest_first=True,
        part_events=part_events,
        totals=[has(VIEW).alias("has_view"), has(CART).alias("has_add_to_car")],
    )
    return sequences.select(
        "ad_id",
        "part",
        F.col("seq.item_id").alias("content_ids"),
        F.col("seq.behavior_name").alias("behavior_types"),
        "has_view",
        "has_add_to_car",
        F.lit(shift_day(as_of, -1)).alias("dt"),
    )


def session_corpus(
    events: DataFrame, as_of: str, days: int = 10, part_events: int = PART_EVENTS
) -> DataFrame:
    """One text per user: the items of the last ``days`` days up to ``as_of``, in time order."""
    window = events.filter(in_window(F.col("dt"), as_of, 1 - days, 0))
    sequences = user_sequences(window, ["ad_id"], ["item_id"], part_events=part_events)
    return sequences.select(
        "ad_id",
        "part",
        F.array_join(F.col("seq.item_id"), " ").alias("events"),
        F.lit(f"{as_of}-{days}day").alias("dt"),
    )


def user_category_sequences(
    events: DataFrame, day: str, part_events: int = PART_EVENTS
) -> DataFrame:
    """Items and their categories per user and day, as parallel texts in time order."""
    rows = events.filter(F.col("dt") == day)
    sequences = user_sequences(rows, ["ad_id"], ["item_id"], part_events=part_events)
    items = F.col("seq.item_id")
    return sequences.select(
        "ad_id",
        "part",
        F.array_join(items, ",").alias("item_seq"),
        F.array_join(F.transform(items, category_of), ",").alias("category_seq"),
        F.lit(day).alias("dt"),
    )


def user_positives(behaviours: DataFrame, items: DataFrame) -> DataFrame:
    """The listed items each user touched, by number: text, and array for further use.

    A set holds distinct listed items only, so it is bounded by the length of the list.
    """
    numbered = number_items(behaviours, items).filter(F.col("item_no").isNotNull())
    positives = F.sort_array(F.collect_set("item_no"))
    return numbered.groupBy("ad_id").agg(positives.alias("items")).select(
        "ad_id", F.array_join("items", ",").alias("item"), "items"
    )
