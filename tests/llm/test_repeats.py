"""Removal of repeated passages against brute force, planted cases and odd inputs."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratefuse.llm import repeats
from ratefuse.llm.common import settle

SCHEMA = "doc_id long, text string, doc string, found string"


def brute(rows, length):
    first = {}
    rank = lambda i: (1 << 63) - 1 if i is None else i
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, t in raw:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            first[w] = min(first.get(w, rank(i)), rank(i))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < rank(i):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{'äbcß'[k % 4]}{k}" for k in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = say(60), say(13)
    rows = []
    for k in range(60):
        text = say(rng.randrange(0, 90))
        if k % 3 == 0:
            text += passage + say(20)
        if k % 2:
            text = say(5) + line + text + line
        rows.append((100 - k if k % 5 else k, text))
    rows += [(200 + k, rows[k][1]) for k in range(9)]
    rows += [(300 + k, "x" * (40 + 9 * k) + "\0" * (20 * k)) for k in range(8)]
    rows += [(400, None), (401, ""), (402, passage), (402, passage), (402, line + passage)]
    rows += [(None, passage), (None, passage + say(30)), (None, None)]
    return rows


@pytest.mark.parametrize("limit", [4000, 3])
def test_equals_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(repeats, "CONTEXTS", limit)
    rows = corpus(limit)
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    got = repeats.report(docs.repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 50)


def test_long_texts_in_several_steps(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STEP", 400)
    monkeypatch.setattr(repeats, "SORTED", 50)
    rows = corpus(7)
    rows.append((900, " ".join(t for _, t in rows if t)))
    for length, gram in ((50, 24), (20, 9)):
        docs = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
        got = repeats.remove_repeats(docs, length, gram).select(
            "doc_id", "n_bytes", F.length("kept").alias("k"), F.sha2("kept", 256).alias("h")
        ).collect()
        want = [(i, n, n - r, h) for i, n, r, _, h in brute(rows, length)]
        assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_factors_look_both_ways():
    shared = np.array([0, 60, 55, 10, 70, 50])
    docs = np.array([5, 3, 4, 1, 2, 2])
    assert list(repeats.previous_factors(shared, docs, 50)) == [60, 0, 55, 0, 70, 50]


def test_empty_table(spark):
    assert repeats.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keys_come_once_a_step_with_their_documents():
    texts = pa.array(["a passage that repeats itself word for word, over and over. " * 4] * 3 + [None, "b" * 90])
    doc = pa.array([5, 2, 9, 1, 7], pa.int64())
    part = pa.array([0] * 5, pa.int64())
    for share in range(repeats.SHARES):
        batch = pa.RecordBatch.from_arrays([doc, part, texts], ["doc", "part", "text"])
        runs = pa.Table.from_batches(list(repeats._contexts(50, 20, share)([batch])))
        least = runs.group_by("key").aggregate([("doc", "min"), ("doc", "max")]).select(["key", "doc_min", "doc_max"])
        short = pa.RecordBatch.from_arrays([doc, texts], ["doc", "text"])
        keys = pa.Table.from_batches(list(repeats._keys(50, 20, share)([short])))
        rows = lambda t: sorted(zip(*(t.column(k).to_pylist() for k in range(3))))
        assert rows(keys) == rows(least) and len(keys) < len(runs)


def test_stored_contexts_go_share_by_share(spark, monkeypatch):
    """Contexts of one share lie on disk at a time, and nothing but the marks at the end."""
    live, most = {}, {}

    def settle(df, name, of=repeats.settle):
        out = of(df, name)
        live.update({f.rsplit("/", 1)[0]: name for f in out.inputFiles()})
        for n in set(live.values()):
            most[n] = max(most.get(n, 0), sum(x == n for x in live.values()))
        return out

    def discard(table, of=repeats.discard):
        for f in table.inputFiles():
            live.pop(f.rsplit("/", 1)[0], None)
        of(table)

    monkeypatch.setattr(repeats, "settle", settle)
    monkeypatch.setattr(repeats, "discard", discard)
    rows = corpus(5)
    rows += [(None if i is None else i + 1000, t) for i, t in rows]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    got = repeats.report(docs.repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 50)
    assert most["repeats-contexts"] == most["repeats-folded"] == 1
    assert not {"repeats-keys", "repeats-contexts", "repeats-folded", "repeats-bytes"} & set(live.values())


def test_shuffle_files_go_when_a_table_is_settled(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {
        name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name
    }
    settle(spark.range(10), "before")
    time.sleep(1)
    there = files()
    table = spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    settle(table, "after")
    until = time.time() + 20
    while files() - there and time.time() < until:
        time.sleep(0.2)
    assert not files() - there
