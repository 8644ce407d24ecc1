"""Every query and every pipeline stage on empty tables and on tables with odd rows."""

import collections

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratefuse.llm import mixing, secret_scan, toxicity
from ratefuse.llm.common import PYTHON_WORDS, read
from ratefuse.llm.queries import QUERIES
from test_corpus import components

TABLES = ["documents", "labels", "pages", "embeddings", "conversations"]
#: Names that the operators use for columns of their own.
CLASHING = ["key", "size", "draw", "again", "own", "d", "times", "rank", "id", "part", "place", "found",
            "__found", "__toxicity", "component", "host", "score", "held_out"]

#: Columns that each query has to return.
COLUMNS = {
    "op1_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_language": "doc_id held_out lang_pred score",
    "op3_jaccard_join": "doc_id n_shingles component_id",
    "op4_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_toxicity": "doc_id held_out score predicted",
    "op6_html_text": "page_id url text n_chars",
    "op7_mixing": "doc_id size source_size target taken",
    "op8_topk": "query_id rank vec_id score",
    "op9_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op10_minhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op11_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_quality": "doc_id held_out score predicted",
}
#: Queries that return a row for each row of documents.
BY_ROW = ["op1_secrets", "op2_language", "op4_repeats", "op5_toxicity", "op7_mixing", "op10_minhash", "op11_runs",
          "op13_quality"]


@pytest.fixture(scope="module")
def empty_dir(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        pq.write_table(pq.read_table(f"{sf_dir}/{name}.parquet").slice(0, 0), folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd_dir(spark, sf_dir, tmp_path_factory):
    """Given rows and rows without id, text or source, repeated and copied ones, and more columns."""
    folder = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = docs.orderBy("doc_id").first().text
    long = " ".join(f"word{k}" for k in range(30_000))
    rows = [
        (90_001, text), (90_002, text), (90_003, text + " end"), (90_004, None), (90_005, ""),
        (90_006, " \n\t"), (90_007, long), (90_008, "x" * 200_000), (90_009, "password = hunter2hunter2"),
        (90_010, "one text"), (90_010, "another text of the same id"), (90_011, "twice"), (90_011, "twice"),
        (None, "no id"), (None, "no id"), (None, None), (90_012, "no source"),
    ]
    more = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "source", F.when(~F.col("text").startswith("no source"), F.lit("odd"))
    )
    for c, kind in docs.dtypes:
        if c not in more.columns:
            more = more.withColumn(c, F.lit(None).cast(kind))
    both = docs.unionByName(more.select(docs.columns))
    both = both.withColumns({c: F.lit("own") for c in CLASHING if c not in docs.columns})
    both.repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    none = labels.limit(2).select(*[F.lit(None).cast(t).alias(c) for c, t in labels.dtypes])
    labels.unionByName(none).unionByName(labels.limit(3)).write.parquet(f"{folder}/labels.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(20)
    bare = pages.limit(1).withColumns({"html": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    blank = pages.limit(1).withColumn("html", F.lit(""))
    pages.unionByName(pages.limit(2)).unionByName(bare).unionByName(blank).withColumn(
        "key", F.lit(1)
    ).write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.mark.parametrize("name", COLUMNS)
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    out = QUERIES[name](spark, empty_dir)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    assert out.collect() == []


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_odd_row(spark, odd_dir, name):
    ids = collections.Counter(r.doc_id for r in read(spark, odd_dir, "documents").collect())
    rows = QUERIES[name](spark, odd_dir).collect()
    assert collections.Counter(r.doc_id for r in rows) == ids
    may_be_null = {"doc_id", "source"} | ({"start", "length", "period", "exponent_milli"} if "runs" in name else set())
    for r in rows:
        assert not [c for c in COLUMNS[name].split() if c not in may_be_null and r[c] is None], r
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(tuple(r[c] for c in r.asDict() if c not in ("near_next", "edited_sha256", "held_out",
                            "edited_fingerprint", "near_edited", "taken", "n_removed", "n_spans", "kept_sha256")))
    assert len(by_id[90_011]) == 1


def test_odd_rows_of_join_packing_and_pages(spark, odd_dir):
    docs = read(spark, odd_dir, "documents")
    joined = {r.doc_id: r for r in QUERIES["op3_jaccard_join"](spark, odd_dir).collect()}
    assert set(joined) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert joined[None].component_id is None and joined[90_004].n_shingles == joined[90_005].n_shingles == 0
    assert joined[90_001].component_id == joined[90_002].component_id < 90_001
    pieces = QUERIES["op9_packing"](spark, odd_dir).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id for r in pieces} == set(joined)
    assert {r.doc_id: r.n for r in pieces}[90_004] == 1
    pages = QUERIES["op6_html_text"](spark, odd_dir).collect()
    assert len(pages) == 24 and sum(r.text == "" for r in pages) >= 2
    assert all(r.n_chars == len(r.text) for r in pages)


def test_pipeline_of_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def words(text):
    return len(PYTHON_WORDS.findall(text or ""))


def test_pipeline_stage_by_stage(spark, odd_dir):
    docs = read(spark, odd_dir, "documents")
    columns = docs.columns
    tables = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, odd_dir).collect(), stage(spark, docs, odd_dir).schema)
        tables[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert all(r[c] == "own" for r in tables[name] for c in CLASHING if c in columns)
    ids = {k: collections.Counter(r.doc_id for r in rows) for k, rows in tables.items()}
    whole = read(spark, odd_dir, "documents")

    scored = toxicity.score_documents(whole, read(spark, odd_dir, "labels"))
    clean = collections.Counter(r.doc_id for r in scored.filter("predicted = 0").collect())
    assert ids["toxicity"] == clean != ids["documents"]

    left = [r for r in tables["toxicity"] if r.doc_id is not None]
    left = sorted({(r.doc_id, r.text) for r in left}, key=lambda r: (r[0], r[1] or ""))
    top = components([t for _, t in left], 5, 4, 5)
    want = {left[k][0] for k, t in enumerate(top) if left[t][0] == left[k][0]}
    assert set(ids["near_copies"]) - {None} == want
    assert 90_002 not in want and ids["near_copies"][90_010] == 2 and ids["near_copies"][90_011] == 1

    assert ids["secrets"] == ids["near_copies"]
    texts = {(r.doc_id, r.text) for r in tables["near_copies"]}
    for r in tables["secrets"]:
        assert not secret_scan.base_spans(r.text or "")
        assert (r.doc_id, r.text) in texts or "[secret]" in r.text
    assert {r.text for r in tables["secrets"] if r.doc_id == 90_004} == {None}

    totals, taken = collections.Counter(), collections.Counter()
    for r in tables["secrets"]:
        totals[r.source] += words(r.text)
    for r in tables["mixing"]:
        taken[r.source] += words(r.text)
    for source, goal in mixing.targets(dict(totals)).items():
        longest = max(words(r.text) for r in tables["secrets"] if r.source == source)
        assert abs(taken[source] - goal) <= max(2 * longest, 0.02 * goal)
    assert all(n <= 2 * ids["secrets"][i] for i, n in ids["mixing"].items())

    assert set(ids["packing"]) == set(ids["mixing"])
    sequences = collections.defaultdict(list)
    for r in tables["packing"]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0
