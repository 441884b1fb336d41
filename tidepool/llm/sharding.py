"""Shards by rendezvous hashing of record keys.

Each shard draws a number for each key, and the key goes to the shard with the highest. A draw
depends on the key and the shard's name alone, so a new shard takes only the keys it wins, the
keys of a removed shard go to their second choices, and all others stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.common import fresh
from tidepool.shared import cut_lineage

#: Bytes that a record takes besides its text.
RECORD_BYTES = 8


def equal_shards(count: int) -> dict[int, float]:
    """Shards 0 to ``count`` - 1 of one weight."""
    if count < 1:
        raise ValueError("there must be a shard")
    return dict.fromkeys(range(count), 1.0)


def key_hash(key: Column) -> Column:
    """The hash of a record key as text, so that 7 and '7' are one key. NULL is a key as well."""
    return F.xxhash64(key.cast("string"))


def shard_column(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard (int) of a record key among ``shards``, their weights by number.

    A shard of twice the weight gets twice the keys. With u the draw of a shard, evenly
    between 0 and 1, the shard with the greatest ``weight / -ln u`` wins; of equal ones that with the
    smaller number. Only built-in functions run, one hash for each shard and row.
    """
    if not shards or any(w <= 0 for w in shards.values()):
        raise ValueError("there must be a shard, and weights above 0")
    hashed = key_hash(key)

    def score(shard: int, weight: float) -> Column:
        # 53 bits of the draw, in the middle of their step: never 0 or 1
        bits = F.shiftrightunsigned(F.xxhash64(hashed, F.lit(str(shard))), 11)
        drawn = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((F.lit(float(weight)) / -F.log(drawn)).alias("score"), F.lit(-shard).alias("shard"))

    scores = [score(shard, weight) for shard, weight in sorted(shards.items())]
    return (-F.array_max(F.array(*scores))["shard"]).cast("int")


def _placed(schema: list[str], shard: int) -> Callable:
    """Adds the task's number and each row's place among the task's rows of its shard."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            numbers = batch.column(shard).to_numpy(zero_copy_only=False)
            place = np.empty(len(numbers), dtype=np.int64)
            for number in np.unique(numbers).tolist():
                at = np.flatnonzero(numbers == number)
                before = seen.get(number, 0)
                place[at] = before + np.arange(len(at))
                seen[number] = before + len(at)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(place), part, dtype=np.int32)), pa.array(place)], schema)

    return of


def with_slots(rows: DataFrame, shard_col: str = "shard") -> DataFrame:
    """``rows`` with ``slot``: their number within the shard, gapless from 0.

    A slot is the row's place among the task's rows of its shard, plus the rows of that shard in the tasks
    before. So no row is moved or sorted, and a shard with a third of all rows is numbered
    by all tasks. The rows are stored in the shared folder first, as they must stay in
    their task; which slot a row gets within its shard depends on the layout of the input files.
    """
    part, place, before = (fresh(rows, name) for name in ("part", "place", "before"))
    names = [*rows.columns, part, place]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)
    at = rows.columns.index(shard_col)
    stored = cut_lineage(rows.mapInArrow(_placed(names, at), f"{fields}`{part}` int, `{place}` long"))
    counts = stored.groupBy(shard_col, part).agg(F.count("*").alias(before))
    earlier = Window.partitionBy(shard_col).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    return (stored.join(offsets, [shard_col, part])
            .select(*(f"`{c}`" for c in rows.columns), (F.col(place) + F.col(before)).alias("slot")))


def assigned(docs: DataFrame, shards: Mapping[int, float], grown: Mapping[int, float] | None = None,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard): a row for each row of ``docs``.

    The id and the shards decide alone; texts don't matter and are not moved. Rows that share an id
    share its shard, and rows with a NULL id are one key. ``size`` is the text's UTF-8 bytes (a NULL text has
    none) plus 8, and the crc32 of a NULL text that of an empty one. ``grown_shard`` is the shard
    among the ``grown`` shards, or NULL. No rows give no rows.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        key.alias("id"), (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), shard_column(key, shards).alias("shard"),
        (shard_column(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return with_slots(rows).select("id", "size", "text_crc32", "shard", "slot", "grown_shard")


def moves(docs: DataFrame, shards: Mapping[int, float], now: Mapping[int, float], id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose shard changes, all columns as they are, with ``from_shard`` and ``to_shard``.

    Only these have to be rewritten when the shards change. The added columns get a longer name where ``docs``
    has one of theirs.
    """
    old, new = fresh(docs, "from_shard"), fresh(docs, "to_shard")
    return (docs.withColumns({old: shard_column(F.col(id_col), shards), new: shard_column(F.col(id_col), now)})
            .where(F.col(old) != F.col(new)))


def write_shards(docs: DataFrame, path: str, shards: Mapping[int, float], id_col: str = "doc_id",
                 file_rows: int = 1_000_000) -> None:
    """Writes ``docs`` as Parquet, a folder ``shard=N`` for each shard, with all columns.

    Every task writes its own rows of each shard, so no shard is gathered in one task. A
    column named ``shard`` in ``docs`` gives way.
    """
    rows = docs.drop("shard").withColumn("shard", shard_column(F.col(id_col), shards))
    (rows.write.partitionBy("shard").option("maxRecordsPerFile", file_rows).mode("errorifexists").parquet(path))


def balance(docs: DataFrame, shards: Mapping[int, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, rows, bytes) of each shard that has rows."""
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + RECORD_BYTES
    return (docs.select(shard_column(F.col(id_col), shards).alias("shard"), size.cast("long").alias("size"))
            .groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")))
