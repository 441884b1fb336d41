from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

from tidepool.operators import skipgram as K


def _pairs(found):
    out = Counter()
    for row in found.collect():
        words, contexts = (np.frombuffer(row[name], dtype="<i4") for name in ("words", "contexts"))
        assert (words % 2 == row["first"]).all() and (contexts % 2 == row["second"]).all() and len(words) == row["n"]
        out.update(zip(words.tolist(), contexts.tolist()))
    return out


def test_pairs_made_in_parts_are_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    sentences = [([int(x) for x in rng.integers(0, 9, size=n)],) for n in rng.integers(0, 30, size=40)]
    numbers = spark.createDataFrame(sentences, "numbers array<bigint>").coalesce(1)
    whole = _pairs(K.sampled_pairs(numbers, 2, 5, 3))
    monkeypatch.setattr(K, "PAIRED", 7)
    assert _pairs(K.sampled_pairs(numbers, 2, 5, 3)) == whole and sum(whole.values()) > 500


def _state(kind, block, vectors, met):
    n = len(vectors)
    row = (kind, block, np.arange(n, dtype="<i4").tobytes(), np.array(vectors, dtype="float32").tobytes(),
           np.ones(n).tobytes(), b"" if met is None else np.array(met, dtype="float64").tobytes())
    types = [pa.string(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], K._names(K.STATE))


def test_slices_of_a_block_are_added_one_by_one():
    taken = []

    def rows():
        for batch in (_state("word", 0, [[1, 1], [2, 2], [3, 3]], None), _state("word", 0, [[5, 5], [9, 9], [0, 0]], [1, 0, 1]),
                      _state("word", 0, [[8, 8], [9, 9], [6, 6]], [2, 0, 1]), _state("word", 1, [[4, 4]], None),
                      _state("word", 1, [[7, 7]], [1])):
            taken.append(batch)
            yield batch

    made = K._joined(rows())
    first = next(made)
    assert len(taken) == 4  # the other block's slices aren't read yet
    np.testing.assert_allclose(K._matrix(first["vectors"][0].as_py(), 3), [[7, 7], [2, 2], [3, 3]])
    second = next(made)
    np.testing.assert_allclose(K._matrix(second["vectors"][0].as_py(), 1), [[7, 7]])
    assert next(made, None) is None
