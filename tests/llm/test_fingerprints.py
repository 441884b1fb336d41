from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tests.llm.tables import documents, whole
from tidepool.llm import fingerprints as P
from tidepool.llm.queries import document_fingerprints


def plain_rows(rows: list[tuple]) -> dict:
    """What each document has beside the next one, in one loop over all of them."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (name, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        out[name] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), P.digest(text), P.digest(changed),
                     P.likeness(P.digest(text), P.digest(changed)), P.likeness(P.digest(text), P.digest(following)))
    return out


def test_whole_table(spark, sf_dir):
    expected = plain_rows([(r["doc_id"], r["text"]) for r in whole(spark, sf_dir)])
    rows = document_fingerprints(spark, sf_dir)
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = {r["doc_id"]: tuple(r[c] for c in columns) for r in rows.collect()}
    assert found == expected
    assert all(0 <= r[k] <= 1 for r in found.values() for k in (4, 5))
    assert sum(r[4] > r[5] for r in found.values()) > 0.98 * len(found)


def plain_digest(text: str) -> str:
    data = text.encode()
    counts = [0] * P.BUCKETS
    for k in range(len(data) - 2):
        triplet = data[k] | data[k + 1] << 8 | data[k + 2] << 16
        counts[(triplet * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
    ranked = sorted(counts)
    codes = [sum(c > ranked[P.BUCKETS * q // 4 - 1] for q in (1, 2, 3)) for c in counts]
    packed = bytes(a | b << 2 | c << 4 | d << 6 for a, b, c, d in zip(*(codes[k::4] for k in range(4))))
    import math
    return f"{min(255, int(math.log(len(data) + 1) / math.log(P.GROWTH))):02x}{packed.hex()}"


def test_digest_against_a_loop(monkeypatch):
    texts = ["", "a", "ab", "abc", "the quick brown fox " * 40, "é漢\U0001F600" * 30]
    whole_ = [P.digest(t) for t in texts]
    assert whole_ == [plain_digest(t) for t in texts]
    monkeypatch.setattr(P, "STEP", 7)
    assert [P.digest(t) for t in texts] == whole_
    assert P.digest(None) == P.digest("")


def test_likeness_is_bounded_and_symmetric():
    texts = ["", "a" * 500, "the quick brown fox " * 40, "the quick brown cat " * 40, "zyx wvu " * 3000]
    prints = [P.digest(t) for t in texts]
    for one in prints:
        assert P.likeness(one, one) == 1
        for other in prints:
            assert 0 <= P.likeness(one, other) == P.likeness(other, one) <= 1
    assert P.likeness(prints[2], prints[3]) > P.likeness(prints[2], prints[4])


def test_awkward_rows(spark, awkward):
    rows = P.compared_along(documents(spark, awkward).withColumns({"part": F.lit(1), "place": F.lit(2), "id": F.lit(0)})).collect()
    assert sorted((r["id"] or -1) for r in rows) == sorted((k or -1) for k, _ in awkward)
    by_id = {r["id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["n_chars"] == 0
    assert by_id[5]["fingerprint"] == by_id[6]["fingerprint"]
    assert by_id[None]["edited_sha256"] == hashlib.sha256(P.edited("no id here at all", "many words " * 30_000).encode()).hexdigest()
    one = P.compared_along(documents(spark, [(3, "abcd")])).collect()
    assert [(r["id"], r["near_next"], r["edited_sha256"]) for r in one] == [(3, 1.0, hashlib.sha256(b"abab").hexdigest())]
    assert P.compared_along(documents(spark, [])).count() == 0


def test_columns(spark):
    frame = documents(spark, [(1, "some text here"), (2, None)])
    row = frame.select(P.digest_column(F.col("text")).alias("a")).select("a", P.likeness_column(F.col("a"), F.lit(P.digest(""))).alias("b")).collect()
    assert row[0]["a"] == P.digest("some text here") and row[1]["b"] == 1.0
