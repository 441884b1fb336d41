from __future__ import annotations

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidepool.llm import queries as Q


def test_the_entry_has_every_operator():
    """The entry leaves the operators out where they can't be imported; here they can."""
    names = set(queries())
    assert {int(name[2:].split("_")[0]) for name in names if name.startswith("op")} == set(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= names and set(Q.ORACLES) <= set(oracle_sql())


def test_the_pipeline_has_its_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
