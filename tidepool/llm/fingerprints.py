"""Digests of whole documents by quartiles of hashed byte-triplet counts, and their likeness."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.shared import cut_lineage

BUCKETS = 256
#: Bytes whose triplets are counted at a time.
STEP = 1 << 20
#: Growth of the byte count by which the length code rises by one; a difference of ``FAR`` codes
#: or more counts alike, each as ``LENGTH_WEIGHT`` bucket codes.
GROWTH, FAR, LENGTH_WEIGHT = 1.15, 16, 4
WORST = 3 * BUCKETS + FAR * LENGTH_WEIGHT


def digest(text: str | None) -> str:
    """The fingerprint of a whole text: two hex digits of its length, then two bits a bucket.

    Every three neighbouring bytes of the UTF-8 text are hashed into a bucket. A bucket's code
    says in which quartile of all bucket counts its count lies. NULL counts as empty; texts
    of fewer than three bytes differ by their length code only.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data) - 2, STEP):
        part = data[at:at + STEP + 2].astype(np.uint32)
        triplets = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
        counts += np.bincount((triplets * np.uint32(0x9E3779B1)) >> np.uint32(24), minlength=BUCKETS)
    ranked = np.sort(counts)
    code = sum((counts > ranked[BUCKETS * k // 4 - 1]).astype(np.uint8) for k in (1, 2, 3))
    packed = (code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6).astype(np.uint8)
    length = min(255, int(math.log(len(data) + 1) / math.log(GROWTH)))
    return f"{length:02x}{packed.tobytes().hex()}"


def _codes(fingerprint: str) -> tuple[int, np.ndarray]:
    packed = np.frombuffer(bytes.fromhex(fingerprint[2:]), dtype=np.uint8)
    return int(fingerprint[:2], 16), (packed[:, None] >> np.array([0, 2, 4, 6], dtype=np.uint8) & 3).astype(np.int16)


def likeness(one: str, other: str) -> float:
    """1 less the difference of two fingerprints as a share of the largest one: 1 for equal ones."""
    (m, a), (n, b) = _codes(one), _codes(other)
    return 1 - (int(np.abs(a - b).sum()) + min(FAR, abs(m - n)) * LENGTH_WEIGHT) / WORST


def digest_column(text: Column) -> Column:
    @F.pandas_udf("string")
    def of(texts_: pd.Series) -> pd.Series:
        return pd.Series([digest(x) for x in texts_], dtype="object")

    return of(text)


def likeness_column(one: Column, other: Column) -> Column:
    """NULL where a fingerprint is NULL."""
    @F.pandas_udf("double")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    return of(one, other)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(name, text: str, own: str, following: str, next_own: str) -> tuple:
    changed = edited(text, following)
    changed_own = digest(changed)
    return (name, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, changed_own,
            likeness(own, changed_own), likeness(own, next_own))


RESULT = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
NAMES = [field.split(" ")[0] for field in RESULT.split(", ")]
DONE, FIRST, LAST = 0, 1, 2


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of a sorted partition with the next one; its first and last row come out
    as they are, too, for the partitions beside it."""
    part = TaskContext.get().partitionId()
    held = None
    names = ["part", "place", "text", *NAMES]
    types = [pa.int32(), pa.int32(), pa.string(), *TYPES]
    blank = (None,) * (len(NAMES) - 1)
    for batch in batches:
        rows = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            own = digest(text)
            if held is None:
                rows.append((part, FIRST, text, name, *blank))
            else:
                rows.append((part, DONE, None, *_compared(*held, text, own)))
            held = name, text, own
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)
    if held is not None:
        last = (part, LAST, held[1], held[0], *blank)
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(last, types)], names)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for name, text, following in zip(*(batch.column(k).to_pylist() for k in range(3))):
            rows.append(_compared(name, text, digest(text), following, digest(following)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), TYPES)], NAMES)


def compared_along(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    Documents are in descending order of id (NULL last, rows of one id by a hash of the text);
    after the last comes the first. The edited text takes its last half from the beginning of
    the next document. The texts are dealt by range once and compared as they stream by; only
    the first and last row of each partition are joined afterwards, so there is no window over
    documents. A single document is its own next one; no documents give no rows.
    """
    # rows alike in id and text are dealt apart by where they come from
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("tie")]
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie"))
    stored = cut_lineage(ordered.mapInArrow(_along, f"part int, place int, text string, {RESULT}"))
    firsts = stored.where(F.col("place") == FIRST).select("part", F.col("text").alias("following"))
    lasts = stored.where(F.col("place") == LAST).select("part", "id", "text")
    # one row for each partition, without texts
    after = (firsts.select("part").groupBy().agg(F.sort_array(F.collect_list("part")).alias("parts"))
             .select(F.posexplode("parts").alias("k", "part"), "parts")
             .select("part", F.expr("parts[(k + 1) % size(parts)]").alias("after")))
    ends = (lasts.join(after, "part").drop("part")
            .join(firsts.withColumnRenamed("part", "after"), "after").select("id", "text", "following"))
    done = stored.where(F.col("place") == DONE).select(*NAMES)
    return done.unionAll(ends.mapInArrow(_across, RESULT))
