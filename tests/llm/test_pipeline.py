from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.tables import documents, values, write_tables
from tests.llm.test_decontamination import plain
from tests.llm.test_packing import check_sequences
from tests.llm.test_secrets import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tidepool.llm.queries import SEQUENCE

ORDER = ["quality", "near_duplicates", "decontamination", "secrets", "packing"]


def test_every_stage_on_its_own_input(spark, sf_dir, tmp_path):
    assert [name for name, _ in P.STAGES] == ORDER
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = ([tuple(r) for r in before.collect()], docs.collect())
        if name != "packing":
            assert docs.columns == columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    given, good = kept["quality"]
    assert {tuple(r) for r in good} <= set(given)
    left = {r[0] for r in good}
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in left for k in bad) <= 0.1 * len(bad)
    assert sum(k not in left for k, q in labels.items() if q == 1) <= 0.02 * len(labels)

    given, single = kept["near_duplicates"]
    groups = plain_components({r[0]: plain_fingerprint(r[1]) for r in given}, 2)
    assert sorted(tuple(r) for r in single) == sorted(r for r in given if groups[r[0]] == r[0])

    given, clean = kept["decontamination"]
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(tuple(r) for r in clean) == sorted(r for r in given if not any(i in plain(r[1]) for i in items))

    given, masked = kept["secrets"]
    by_id = {r["doc_id"]: r for r in masked}
    assert len(masked) == len(given)
    for row in given:
        spans = plain_spans(row[1])
        own = by_id[row[0]]
        assert not plain_spans(own["text"]) or spans
        assert (own["text"] == row[1] and own["n_chars"] == row[4]) if not spans else \
            ("[SECRET]" in own["text"] and own["n_chars"] == len(own["text"]))

    given, packed = kept["packing"]
    assert {r["doc_id"] for r in packed} == {r[0] for r in given}
    assert check_sequences(packed, SEQUENCE) <= 1.02 * -(-sum(r["length"] for r in packed) // SEQUENCE) + 1


def test_run_is_the_stages_one_after_the_other(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert values(P.run(spark, sf_dir).select(pieces)) == values(docs.select(pieces))


def test_awkward_documents_pass_every_stage(spark, tmp_path, awkward):
    labels = [(k, int(k % 3 > 0), 0) for k in range(12)]
    docs = documents(spark, [*awkward, *[(200 + k, f"plain words number {k} in a text of its own kind") for k in range(20)]])
    more = docs.withColumns({name: F.lit("x") for name in ("score", "label", "id", "print", "masked", "leaks", "part", "length")})
    sf_dir = write_tables(spark, tmp_path / "t", docs, labels, [(1, "many words " * 12), (2, None)])
    for frame in (docs, more):
        for name, stage in P.STAGES:
            frame_after = stage(spark, frame, sf_dir)
            rows = frame_after.collect()
            if name != "packing":
                assert frame_after.columns == frame.columns
                assert Counter(r["doc_id"] for r in rows) <= Counter(r["doc_id"] for r in frame.collect())
    assert P.run(spark, sf_dir).count() > 0


def test_empty_tables(spark, tmp_path):
    sf_dir = write_tables(spark, tmp_path / "t", documents(spark, []))
    assert P.run(spark, sf_dir).collect() == []


