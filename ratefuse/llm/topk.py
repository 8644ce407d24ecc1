"""Exact top-k search by inner product with a bit-sliced index.

Vectors are quantised to integers. A block of vectors holds one bitmap for each attribute and
bit, 64 rows a word. For a query, the slices are added up, weighted by the query's bits, with
carry-save bitmap arithmetic; the sums come out as slices again. The k best rows are taken
from the most significant slice downward, and rows that tie at the boundary are settled by id.
Blocks of vectors meet blocks of queries, so no task holds more than one of either.

Vectors with a quantised component of 2**20 or more meet all others outside the index, in exact
whole numbers of any size.

Defined results: vectors that are null, empty, or hold a null or a non-finite component take no
part. A score that int64 does not hold is given as the nearest number that it does, and ranked
by its exact value. Vectors of different lengths do not meet. A repeated query id is
asked once, with its least vector; repeated candidates count one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratefuse.operators.stored import stored

ROWS = 32_768  # vectors of a block
WIDE_ROWS = 4096  # vectors of a block outside the index
LIMIT = float(1 << 20)  # quantised components of the index are smaller
QUERIES = 4096  # queries of a block, at most
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Block:
    """Bitmaps of a block of integer vectors, above the smallest component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.low = int(values.min())
        shifted = (self.values - self.low).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length())
        words = -(-len(ids) // 64)
        self.slices = np.zeros((values.shape[1], self.bits, words), np.uint64)
        for j in range(self.bits):
            flags = ((shifted >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T
            packed = np.packbits(flags, axis=1, bitorder="little")
            self.slices[:, j].view(np.uint8)[:, : packed.shape[1]] = packed
        self.valid = np.zeros(words, np.uint64)
        every = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        self.valid.view(np.uint8)[: len(every)] = every

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the inner product plus a constant, least significant first.

        An attribute with a negative weight adds its complement, so all terms are positive.
        """
        size = np.abs(query)
        signed = self.slices ^ np.where(query < 0, _ALL, np.uint64(0))[:, None, None]
        columns: dict[int, list[np.ndarray]] = {}
        for i in range(int(size.max()).bit_length()):
            dims = np.flatnonzero((size >> i) & 1)
            for j in range(self.bits):
                columns.setdefault(i + j, []).append(signed[dims, j])
        out, weight = [], 0
        while columns:
            rows = columns.pop(weight, [])
            column = np.concatenate(rows) if rows else np.zeros((0, len(self.valid)), np.uint64)
            while len(column) > 1:
                third = len(column) // 3
                if third:  # three bitmaps become a sum and a carry
                    a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
                    half = a ^ b
                    carry = (a & b) | (c & half)
                    column = np.concatenate([half ^ c, column[3 * third :]])
                else:
                    carry = column[:1] & column[1:]
                    column = column[:1] ^ column[1:]
                columns.setdefault(weight + 1, []).append(carry)
            out.append(column[0] if len(column) else np.zeros(len(self.valid), np.uint64))
            weight += 1
        return out

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows, without those of the id ``own``."""
        tied = self.valid.copy()
        lo, hi = np.searchsorted(self.ids, (own, own + 1))
        for row in range(lo, hi):
            tied[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        chosen = np.zeros_like(tied)
        for bitmap in reversed(self.sums(query)):
            more = chosen | (tied & bitmap)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                tied &= bitmap
            else:
                chosen = more
                tied &= ~bitmap
                if n == k:
                    break
        rows = _rows(chosen)
        if len(rows) < k:
            rows = np.concatenate([rows, _rows(tied)[: k - len(rows)]])
        return self.ids[rows], self.values[rows] @ query


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_FOUND = "query_id long, vec_id long, score long, beyond binary"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _search(k: int):
    def search(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        dim = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
        ids, out = [], ([], [], [])
        if rows.num_rows and queries.num_rows:
            block = Block(
                rows["vec_id"].to_numpy(), _matrix(rows["v"], dim)
            )
            wanted = _matrix(queries["v"], dim)
            ids = queries["vec_id"].to_numpy()
            for own, query in zip(ids, wanted):
                found, scores = block.best(query, int(own), k)
                out[0].append(np.full(len(found), own))
                out[1].append(found)
                out[2].append(scores)
        whole = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
        table = pa.table(
            {n: pa.array(a, pa.int64()) for n, a in zip(("query_id", "vec_id", "score"), whole)}
        )
        return table.append_column("beyond", pa.nulls(len(whole[0]), pa.binary()))

    return search


def _integers(column: pa.ChunkedArray, dim: int, scale: float) -> np.ndarray:
    """Exact whole numbers of quantised components that are given divided by the scale."""
    values = _matrix(column, dim)
    if np.abs(values).max() * scale < float(1 << 62):
        return (values * scale).astype(np.int64)
    times = int(scale)
    whole = [int(x * scale) if abs(x) < 1e300 else int(x) * times for x in values.ravel()]
    return np.array(whole, object).reshape(values.shape)


def _ordered(score: int) -> bytes | None:
    """Bytes in the order of the scores that int64 cuts off at one end; None for the others."""
    if _LEAST < score < _MOST:
        return None
    return (score + (1 << 2175)).to_bytes(272, "big")


def _search_wide(k: int, scale: float):
    def search(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        dim = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
        out = ([], [], [], [])
        if rows.num_rows and queries.num_rows:
            ids, values = rows["vec_id"].to_numpy(), _integers(rows["w"], dim, scale)
            wide = rows["wide"].to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            ids, values, wide = ids[order], values[order], wide[order]
            most = int(np.abs(values).max())
            for own, query, far in zip(
                queries["vec_id"].to_numpy(), _integers(queries["w"], dim, scale),
                queries["wide"].to_numpy(zero_copy_only=False),
            ):
                # pairs within the index are not asked again
                at = np.flatnonzero((ids != own) & (wide | far))
                if dim * most * int(np.abs(query).max()) < 1 << 62:
                    scores = values[at].astype(np.int64) @ query.astype(np.int64)
                    best = np.argsort(-scores, kind="stable")[:k]
                else:
                    scores = values[at].astype(object) @ query.astype(object)
                    best = sorted(range(len(at)), key=lambda i: -scores[i])[:k]
                for i in best:
                    score = int(scores[i])
                    out[0].append(int(own))
                    out[1].append(int(ids[at[i]]))
                    out[2].append(min(max(score, _LEAST), _MOST))
                    out[3].append(_ordered(score))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ("query_id", "vec_id", "score", "beyond")
        return pa.table({n: pa.array(a, t) for n, a, t in zip(names, out, kinds)})

    return search


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """Rows that take part: vec_id, dim, whether they are too wide for the index, v and w.

    v are the quantised components as longs (null if too wide), w the same divided by the scale.
    """
    number = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(
        number, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)
    )
    whole = F.transform(  # a large double is whole
        number,
        lambda x: F.when(
            F.abs(x) < float(1 << 44), F.floor(x * scale).cast("double") / scale
        ).otherwise(x),
    )
    wide = F.exists(number, lambda x: F.abs(x * scale) >= LIMIT)
    longs = F.transform(number, lambda x: F.floor(x * scale))
    return vectors.filter(
        F.col("vec_id").isNotNull() & F.coalesce(sound & (F.size("embedding") > 0), F.lit(False))
    ).select(
        F.col("vec_id").cast("long"), F.when(~wide, longs).alias("v"), whole.alias("w"),
        wide.alias("wide"), F.size("embedding").alias("dim"),
    )


def _met(left: DataFrame, right: DataFrame, rows: int, work, n: int, m: int) -> DataFrame:
    """Blocks of the n vectors of ``left`` with packs of the m queries of ``right``."""
    blocks = max(1, -(-n // rows))
    packs = max(1, -(-m // min(QUERIES, max(64, m * blocks // 12))))
    part = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    one_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.select("*", part(1, blocks).alias("block"), one_of(packs).alias("pack"))
    right = right.select("*", part(2, packs).alias("pack"), one_of(blocks).alias("block"))
    keys = ("dim", "block", "pack")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, _FOUND)


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """Each query's k best rows: query_id, rank, vec_id, score."""
    ready = stored(quantised(vectors, scale), "topk-vectors")
    asked = ready.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(
        F.min("w").alias("w")
    )
    asked = asked.withColumn("wide", F.exists("w", lambda x: F.abs(x * scale) >= LIMIT))
    query = F.when(F.col("vec_id") % every == 0, F.col("vec_id"))
    total, wide, queries, wide_queries = ready.agg(
        F.count("*"), F.count_if("wide"), F.countDistinct(query),
        F.countDistinct(F.when(F.col("wide"), query)),
    ).first()
    longs = F.transform("w", lambda x: (x * scale).cast("long")).alias("v")
    found = _met(
        ready.filter("NOT wide").select("vec_id", "dim", "v"),
        asked.filter("NOT wide").select("vec_id", "dim", longs), ROWS, _search(k), total, queries,
    )
    if wide:
        columns = ("vec_id", "dim", "w", "wide")
        near, far = (asked.filter(c).select(*columns) for c in ("NOT wide", "wide"))
        rows = ready.select(*columns)
        work = _search_wide(k, scale)
        if wide_queries:
            found = found.unionByName(_met(rows, far, WIDE_ROWS, work, total, wide_queries))
        found = found.unionByName(_met(rows.filter("wide"), near, WIDE_ROWS, work, wide, queries))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
