"""MinHash fingerprints of documents, and near copies found through their bands.

The shingles of a text (five words, lower case) go through many universal hash permutations,
vectorised in numpy; the signature holds the smallest value of each. A fingerprint is one
byte of every value, so that the likeness of two fingerprints is the share of equal bytes,
corrected for chance.

Defined results: a null text is empty. Texts without words share one fingerprint, which is
like no other. A null id comes after all others in descending order; rows of one id go by a
hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from ratefuse.llm import jaccard
from ratefuse.llm.common import shingles, steps
from ratefuse.operators.stored import stored

WORDS = 5
PERMUTATIONS = 128


def _permutations(n: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda: rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    return draw() | np.uint32(1), draw()


def _smallest(hashes: np.ndarray, begin: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """The ``n`` smallest values of each text's shingles; repeated shingles change nothing."""
    out = np.full((len(begin) - 1, n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        mult, add = _permutations(n)
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        value, starts = np.empty_like(x), begin[:-1][full]
        for k in range(n):
            np.multiply(x, mult[k], out=value)
            value += add[k]
            out[full, k] = np.minimum.reduceat(value, starts)
    return out


def signatures(texts: pa.Array, n: int = PERMUTATIONS, width: int = WORDS) -> np.ndarray:
    """One row of ``n`` smallest values a text; all ones for a text without words."""
    out = np.empty((len(texts), n), np.uint32)
    for lo, hi in steps(texts, 256 << 10):
        out[lo:hi] = _smallest(*shingles(texts.slice(lo, hi - lo), width), n)
    return out


def marks(sig: np.ndarray) -> np.ndarray:
    """The byte of each value that the fingerprint keeps."""
    return (sig & np.uint32(0xFF)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    equal = (a == b).mean(axis=-1)
    return np.clip((equal - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def _rows(ids: list, texts: list[str], after: list[str]) -> pa.RecordBatch:
    changed = [edited(t, n) for t, n in zip(texts, after)]
    own = marks(signatures(pa.array(texts, pa.large_string())))
    other = marks(signatures(pa.array(changed, pa.large_string())))
    last = marks(signatures(pa.array(after[-1:], pa.large_string())))
    following = np.concatenate([own[1:], last])
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [row.tobytes().hex() for row in own],
            "edited_fingerprint": [row.tobytes().hex() for row in other],
            "near_edited": likeness(own, other), "near_next": likeness(own, following),
        }
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket in descending order; those marked as border only follow the last."""
    ids: list = []
    texts: list[str] = []
    size, closed = 0, False
    for batch in batches:
        for doc_id, text, border in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if closed:
                continue
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            closed = border
            if len(ids) > 1 and (closed or size > 1 << 20):
                yield _rows(ids[:-1], texts[:-1], texts[1:])
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])


def fingerprint_edits(docs: DataFrame, rows_a_bucket: int = 2000) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness.

    The documents are dealt out by ranges of the id (bounds from a sketch of the ids), so texts
    move once. The first document of the range that follows is sent along.
    """
    spark = docs.sparkSession
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = min(20_000, max(1, -(-docs.count() // rows_a_bucket)))
    shares = [k / buckets for k in range(1, buckets)] or [0.5]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 8 * buckets))).first()[0]
    edges = np.unique(np.array(bounds if bounds and buckets > 1 else [], np.int64))

    @arrow_udf("int")
    def place(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(edges, known, "right").astype(np.int32))

    dealt = whole.withColumn("bucket", place(F.col("doc_id").cast("long")))
    tops = dealt.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).collect()  # one a bucket
    tops = sorted(tops, key=lambda r: -r["bucket"])
    sent = [
        (top["doc_id"], before["bucket"])
        for before, top in zip(tops, tops[1:] + tops[:1]) if top["doc_id"] is not None
    ]
    if not tops:
        return spark.createDataFrame([], _OUT)
    heads = spark.createDataFrame(sent, "doc_id long, to int")
    first = F.max(F.struct(F.xxhash64("text").alias("mark"), F.col("text")))
    border = (
        whole.join(F.broadcast(heads), "doc_id").groupBy("doc_id", "to").agg(first.alias("f"))
        .select("doc_id", F.col("f.text").alias("text"), F.col("to").alias("bucket"))
    )
    if any(top["doc_id"] is None for top in tops):  # only nulls in the range: any text follows
        to = [b["bucket"] for b, t in zip(tops, tops[1:] + tops[:1]) if t["doc_id"] is None]
        nulls = whole.filter(F.col("doc_id").isNull()).agg(first.alias("f"))
        border = border.unionByName(
            nulls.select(
                F.lit(None).cast("long").alias("doc_id"), F.col("f.text").alias("text"),
                F.explode(F.array(*map(F.lit, to))).cast("int").alias("bucket"),
            )
        )
    every = dealt.withColumn("border", F.lit(False)).unionByName(
        border.withColumn("border", F.lit(True))
    )
    return (
        every.repartitionById(len(edges) + 1, F.col("bucket"))
        .sortWithinPartitions(
            "border", F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))
        )
        .select(F.col("doc_id").cast("long"), "text", "border").mapInArrow(_neighbours, _OUT)
    )


def _band_keys(bands: int):
    rows = PERMUTATIONS // bands

    def keys(every: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        sig = _smallest(every, begin).reshape(-1, bands, rows)
        out = np.zeros(sig.shape[:2], np.uint64)
        for k in range(rows):
            out = out * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k] + np.uint64(1)
        return list(out.astype(np.int64))

    return keys


def near_copies(
    docs: DataFrame, bands: int = 32, similarity: tuple[int, int] = (4, 5)
) -> DataFrame:
    """Verified near copies: doc_id, n_shingles, component_id.

    Signatures are cut into bands, whose keys are made in the pass that describes the sets; from
    there on only keys move, once. Documents that share a band with the band's smallest id are
    joined with it in Spark; what is left of a band's bucket meets in groups and salted blocks,
    but for documents that are in one component already. Pairs count after their exact Jaccard
    similarity is checked, and linked documents form a component.
    """
    summed = jaccard.described(docs, WORDS, "keys", _band_keys(bands))
    sets = jaccard.distinct_sets(summed)
    reps = sets.filter("n > 0").select(F.col("rep").alias("doc_id")).distinct()
    banded = summed.filter("n > 0").join(reps, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"), "h1",
        F.posexplode("keys").alias("band", "key"),
    )
    # A bucket is an index list whose key has no position.
    buckets = banded.select(F.xxhash64("band", "key").alias("s"), "id", "n", "h1")
    lead = F.min("id").over(Window.partitionBy("s"))
    lists = buckets.withColumn("lead", lead).filter("id <> lead").distinct().select(
        "s", "id", "n", "h1", F.lit(0).alias("k"), "lead"
    )
    links = jaccard.links_of_lists(docs, stored(lists, "lists"), summed, WORDS, similarity)
    return jaccard.with_components(sets, links)
