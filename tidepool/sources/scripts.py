"""SQL scripts of several statements with named values."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SEPARATOR = re.compile(r"^-- next --\s*$", re.MULTILINE)  # fixed value: the line between statements


def split_statements(text: str) -> list[str]:
    pieces = (piece.strip().rstrip(";").strip() for piece in SEPARATOR.split(text))
    return [piece for piece in pieces if piece]


def run_statements(
    spark: SparkSession, text: str, values: Mapping[str, object]
) -> list[DataFrame]:
    """The result of each statement of ``text``, in order.

    ``${name}``, quoted or not, takes its value from ``values``. The values are bound
    as parameters, so they are never read as SQL.
    """
    statements = split_statements(text)
    if not statements:
        raise ValueError("the script holds no statement")
    results = []
    for statement in statements:
        names = set(re.findall(r"\$\{(\w+)\}", statement))
        missing = names - values.keys()
        if missing:
            raise KeyError(f"no value for {sorted(missing)}")
        bound = re.sub(r"'\$\{(\w+)\}'|\$\{(\w+)\}", lambda m: f":{m[1] or m[2]}", statement)
        results.append(spark.sql(bound, args={name: values[name] for name in names}))
    return results
