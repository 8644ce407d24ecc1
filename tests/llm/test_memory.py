"""What a worker holds while it hashes a batch of texts, and how many workers there are."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ratefuse.llm import jaccard, mixing, secret_scan, toxicity
from ratefuse.llm.common import read


def test_hashing_a_batch_takes_little_memory():
    texts = pa.array([" ".join(f"w{(7 * i + k * k) % 977}" for k in range(700)) for i in range(1000)])
    list(jaccard._each_set(texts[:1], 5))  # the powers of the base stay
    tracemalloc.start()
    try:
        sets = sum(1 for _ in jaccard._each_set(texts, 5))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sets == 1000 and peak < 20 << 20, peak


def test_looking_for_candidates_takes_little_memory():
    word = "a-name_of-24-characters! "
    texts = pa.array([f"{word * 40}{i}" for i in range(4000)])
    tracemalloc.start()
    try:
        found = secret_scan.interesting(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.all() and peak < 12 << 20, peak


@pytest.fixture
def plans(monkeypatch, capsys):
    """The plans of the tables that two modules store, by name."""
    seen = {}
    for module in (toxicity, mixing):
        def noted(df, name, real=module.stored):
            capsys.readouterr()
            df.explain()
            seen[name] = capsys.readouterr().out
            return real(df, name)

        monkeypatch.setattr(module, "stored", noted)
    return seen


def test_a_task_of_the_lexicon_needs_one_worker(spark, sf_dir, plans):
    """Two Python steps in a task take two workers, which live on in later stages."""
    toxicity.learn(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    assert len(re.findall("EvalPython|MapInArrow", plans["toxicity-folded"])) == 1


def test_a_text_without_words_teaches_no_term(spark):
    texts = ["", None, "...", "one two", "two, ONE!", "three"]
    rows = [(i, t, i % 2) for i, t in enumerate(texts)] + [(9, "two one", 1)]
    docs = spark.createDataFrame(rows, "id int, text string, y int").select("y", "text")
    got = docs.mapInArrow(toxicity._marked, "y int, text string, mark string").collect()
    marks = {r.text: r.mark for r in got}
    assert sorted(marks) == ["one two", "three", "two one", "two, ONE!"]
    assert len({marks[t] for t in ("one two", "two one", "two, ONE!")}) == 1 != len(set(marks.values()))


def test_mixing_starts_no_second_set_of_workers(spark, sf_dir, plans):
    """Rows of Python reach Spark through workers of another kind, which live on beside the others."""
    rows = mixing.mix(read(spark, sf_dir, "documents")).collect()
    assert plans["mix-rules"] and not [n for n, p in plans.items() if "ExistingRDD" in p]
    assert np.isfinite([r.target for r in rows]).all()
