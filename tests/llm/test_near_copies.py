"""Near copies by bands: what is read and moved, rows of one id, sets described a step at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ratefuse.llm import jaccard, minhash
from ratefuse.llm.common import mixed, shingles


def words(prefix: str, n: int = 120) -> list[str]:
    return [f"{prefix}{k}" for k in range(n)]


def test_bands_are_cut_in_the_pass_that_describes_the_sets(spark, monkeypatch):
    """No text is read, moved or hashed again for the buckets, and their keys move once."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, name)

    keep = minhash.stored
    monkeypatch.setattr(minhash, "stored", noted)
    docs = spark.createDataFrame([(k, " ".join(words("a")[: 100 + k])) for k in range(8)], "doc_id long, text string")
    got = minhash.near_copies(docs).collect()
    assert {r.component_id for r in got} == {0}
    assert len(plans) == 1
    assert "text" not in plans[0] and "ArrowEvalPython" not in plans[0] and "MapInArrow" not in plans[0]
    assert plans[0].count("Generate posexplode") == 1


def test_rows_of_one_id_link_through_each_of_their_texts(spark):
    one, two, other = words("a"), words("b"), words("c")
    edit = lambda w: w[:60] + ["new"] + w[61:]
    rows = [
        (1, one), (5, one), (5, two), (5, two), (7, edit(two)), (8, other), (9, edit(other)), (9, edit(other)),
        (10, []), (11, []), (12, words("d")), (None, other),
    ]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    got = minhash.near_copies(docs)
    assert got.count() == len(rows)
    found = {k: set() for k, _ in rows}
    for r in got.collect():
        found[r.doc_id].add(r.component_id)
    assert found == {
        1: {1}, 5: {1}, 7: {1}, 8: {8}, 9: {8}, 10: {10}, 11: {11}, 12: {12}, None: found[None],
    }


def test_sets_described_together_equal_sets_described_alone(monkeypatch):
    monkeypatch.setattr(jaccard, "PER_BUCKET", 30)  # some counts no longer fit into a byte
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, top, n)) for top, n in
             [(2, 40), (900, 400), (10**6, 20_000), (50, 3), (5, 1)] * 3]
    texts[4:4] = ["", None, " \n"]
    texts += ["x " * 90, "", None]
    column = pa.array(texts, pa.string())
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": column})
    (got,) = jaccard._summaries(5, "keys", minhash._band_keys(32))(iter([batch]))
    sig = minhash.signatures(column)
    for k, row in enumerate(got.to_pylist()):
        s = np.unique(shingles(column.slice(k, 1), 5)[0])
        assert row["n"] == len(s)
        assert row["h1"] == int(mixed(s).sum(dtype=np.uint64).astype(np.int64))
        assert row["h2"] == int(mixed(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).astype(np.int64))
        buckets = 1 << max(5, (len(s) // 30).bit_length())
        count = np.bincount((s % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        assert row["counts"] == (count.astype(np.uint8).tobytes() if len(s) and count.max() < 256 else b"")
        key = 0
        for value in sig[k, :4].tolist():
            key = (key * 0x9E3779B97F4A7C15 + value + 1) % 2**64
        assert row["keys"][0] % 2**64 == key and len(row["keys"]) == 32
    many = np.arange(300, dtype=np.uint64) << np.uint64(32)  # all in one bucket
    assert jaccard._bucket_counts(many) == b"" and jaccard._bucket_counts(many[:0]) == b""
    both = jaccard._counts(np.concatenate([many, many[:9]]), np.array([0, 300, 309]))
    assert both[0] == b"" and both[1] == bytes([9]) + bytes(31)
