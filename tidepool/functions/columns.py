"""Column helpers built from Spark's own functions; none of them leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The shape of a full item id, and what is kept of it.
ITEM_ID_PATTERN = r"^([0-9]+):([0-9a-zA-Z\-_]+):([0-9]+)$"
ITEM_ID_KEPT = "$2:$3"


def normalise_item_id(item: Column) -> Column:
    """Spaces removed; ``number:shop:number`` becomes ``shop:number``, other ids stay whole."""
    return F.regexp_replace(F.replace(item, F.lit(" "), F.lit("")), ITEM_ID_PATTERN, ITEM_ID_KEPT)


def category_of(item_id: Column) -> Column:
    """The text before the first colon."""
    return F.split_part(item_id, F.lit(":"), F.lit(1))


def first_of(data: Column, key: str) -> Column:
    """First value listed under ``key``; NULL when the key or the value is missing."""
    return F.get(data[key], 0)


def least_strict(value: Column, bound: float) -> Column:
    """The smaller of both, but NULL for a NULL value (Spark's ``least`` would give the bound)."""
    return F.when(value.isNotNull(), F.least(value, F.lit(bound)))


def safe_ratio(above: Column, below: Column, digits: int) -> Column:
    """Rounded quotient of doubles; NULL when the divisor is zero."""
    return F.round(F.try_divide(above.cast("double"), below.cast("double")), digits)


def parse_int_list(text: Column) -> Column:
    """``'1,2,3'`` to an array; NULL, empty text and the ``\\N`` mark give an empty array."""
    blank = text.isNull() | text.isin("", "\\N")
    numbers = F.transform(F.split(text, ","), lambda piece: piece.cast("bigint"))
    return F.when(blank, F.array().cast("array<bigint>")).otherwise(numbers)


def unique_sorted(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def min_length(sequence: Column, n: int, distinct: bool = False) -> Column:
    """At least ``n`` entries. NULL sequences do not pass."""
    entries = F.array_distinct(sequence) if distinct else sequence
    return F.coalesce(F.size(entries) >= n, F.lit(False))


def json_object(text: Column) -> Column:
    """A JSON object as a map from name to a typed value."""
    return F.from_json(text, "map<string,variant>")


def merge_objects(*objects: Column) -> Column:
    """Maps in one; for a name in several the value of the last stays. NULL maps are skipped."""
    entries = F.flatten(F.array_compact(F.array(*[F.map_entries(o) for o in objects])))

    # Every object is read once into the list. Sorted by name and place, the last entry of a
    # name is the one before another name.
    def last_only(held: Column) -> Column:
        placed = F.array_sort(F.transform(
            held, lambda e, i: F.struct(e["key"].alias("name"), i.alias("place"))))

        def merged(names: Column) -> Column:
            last = F.filter(names, lambda n, i: F.coalesce(
                F.get(names, i + 1)["name"] != n["name"], F.lit(True)))
            return F.map_from_entries(F.transform(last, lambda n: F.get(held, n["place"])))

        return F.transform(F.array(placed), merged)[0]

    return F.transform(F.array(entries), last_only)[0]


def merge_json(*texts: Column) -> Column:
    """JSON objects merged from left to right into one JSON object; NULL ones are skipped."""
    return F.to_json(merge_objects(*[json_object(text) for text in texts]))


def add_prefix(entries: Column, prefix: str) -> Column:
    """Every key of the map with ``prefix`` in front."""
    return F.transform_keys(entries, lambda key, _: F.concat(F.lit(prefix), key))


def text_to_map(text: Column, between_pairs: str = ",", in_pair: str = ":") -> Column:
    return F.str_to_map(text, F.lit(between_pairs), F.lit(in_pair))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimal columns as bigint when they hold whole numbers by type, as double otherwise."""
    def plain(field: T.StructField) -> Column:
        if not isinstance(field.dataType, T.DecimalType):
            return F.col(field.name)
        kind = "bigint" if field.dataType.scale == 0 else "double"
        return F.col(field.name).cast(kind).alias(field.name)

    return df.select(*[plain(field) for field in df.schema])


def hash_draw(upper: int, *parts: Column | str | int) -> Column:
    """A number in ``0 .. upper-1`` that depends on the parts alone.

    It is the same wherever and however often the row is computed, unlike ``rand``.
    """
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(upper))
