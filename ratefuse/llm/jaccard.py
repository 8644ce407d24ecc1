"""Exact Jaccard join of documents on word shingles, and its connected components.

Documents of equal sets fold into the one with the smallest id. Any two linked sets share a
shingle of their prefixes, under one order of all shingles in which those found in many
prefixes come last. The index lists of the prefix shingles are then used with two kinds of
skipping:

* by position and size: a short list is cut into blocks of similar set size, entries of blocks
  that are too small or large are never met (a long list is cut by id), and an entry is passed
  over if the shingles behind its position cannot give the overlap that is needed;
* by relations between sets: each list's first set meets all others. Sets that are in one
  component already need no further comparison, and sets that are similar to a first set, or to
  one that is, form a group whose answers come from one another: block by block as bit matrices over
  the group's shingles, without making candidate pairs.

What is left meets pair by pair. No pair of different components goes unexamined. Before two
sets are compared, the counts of their shingles by hash bucket bound what they can share.

Defined results: documents without words or text have an empty set and are linked with
nothing. Rows of one id with different texts are one document with several sets. A null id
stays alone (component null). Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from ratefuse.llm.common import Shared, discard, give_back, mixed, shingles, steps
from ratefuse.llm.components import components
from ratefuse.operators.stored import stored

#: A shingle is frequent if more prefixes hold it.
FREQUENT = 64
#: Frequent shingles sent to every task, at most; beyond it the bar is raised.
MOST_FREQUENT = 1_000_000
#: Ids that are sent to every task instead of being joined by a shuffle, at most.
SMALL_SIDE = 1_000_000
#: Shingles of one side of a block of a group.
BLOCK_SHINGLES = 250_000
#: Cells of a matrix within a block, about.
STRIP_CELLS = 4_000_000
#: Index lists of more entries are worked through block by block, shorter ones by a join.
LONG_LIST = 64
#: Entries of one side of a block of a long list.
BLOCK_ENTRIES = 1024

#: Shingles of a set for each bucket of the counts that bound an overlap, about.
PER_BUCKET = 4
#: Bytes of text that one step hashes; it takes dozens of times as much memory.
SET_BYTES = 128 << 10

Ratio = tuple[int, int]


def prefix_length(n: int, ratio: Ratio) -> int:
    return n - -(-ratio[0] * n // ratio[1]) + 1


def _steps_of_sets(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of a few texts at a time, each sorted: all shingles, and where each set begins."""
    for lo, hi in steps(texts, SET_BYTES):
        hashes, begin = shingles(texts.slice(lo, hi - lo), width)
        for k in range(hi - lo):
            hashes[begin[k] : begin[k + 1]].sort()
        new = np.ones(len(hashes), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
        new[begin[:-1][np.diff(begin) > 0]] = True
        yield hashes[new], np.concatenate(([0], np.cumsum(new)))[begin]


def _each_set(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for every, begin in _steps_of_sets(texts, width):
        for k in range(len(begin) - 1):
            yield every[begin[k] : begin[k + 1]]


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    out = np.zeros(len(begin) - 1, np.uint64)
    full = np.diff(begin) > 0
    if len(values):
        out[full] = np.add.reduceat(values, begin[:-1][full])
    return out.astype(np.int64)


def _counts(every: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Counts of each set's shingles by their last bits, a byte each; empty if a byte is too small."""
    size = np.diff(begin)
    buckets = np.where(size, 1 << np.maximum(5, np.frexp(size // PER_BUCKET)[1].astype(np.int64)), 0)
    base = np.concatenate(([0], np.cumsum(buckets)))
    low = every & np.repeat((buckets - 1).astype(np.uint64), size)
    count = np.bincount(low.astype(np.int64) + np.repeat(base[:-1], size), minlength=base[-1])
    kept = np.zeros(len(size), bool)
    if len(every):
        kept[size > 0] = np.maximum.reduceat(count, base[:-1][size > 0]) < 256
    flat = count.astype(np.uint8).tobytes()
    return [flat[base[k] : base[k + 1]] if kept[k] else b"" for k in range(len(size))]


def _bucket_counts(s: np.ndarray) -> bytes:
    return _counts(s, np.array([0, len(s)]))[0]


def _most_common(a: bytes, b: bytes, size: int) -> int:
    """Upper bound of the shingles that two sets of together ``size`` can share."""
    if not a or not b:
        return size
    x, y = (np.frombuffer(c, np.uint8).astype(np.int32) for c in (a, b))
    buckets = min(len(x), len(y))
    apart = x.reshape(-1, buckets).sum(axis=0) - y.reshape(-1, buckets).sum(axis=0)
    return (size - int(np.abs(apart).sum())) // 2


def _heads(ratio: Ratio):
    def prefixes(every: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        sets = (every[lo:hi] for lo, hi in zip(begin[:-1], begin[1:]))
        return [s[: prefix_length(len(s), ratio) if len(s) else 0].astype(np.int64) for s in sets]

    return prefixes


def _summaries(width: int, name: str, made):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, counts, column = [], [], [], [], []
            for every, begin in _steps_of_sets(batch.column("text"), width):
                n.extend(np.diff(begin).tolist())
                one.extend(_sums(mixed(every), begin).tolist())
                two.extend(_sums(mixed(every ^ np.uint64(0x5DEECE66D)), begin).tolist())
                counts.extend(_counts(every, begin))
                column.extend(made(every, begin))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()),
                    "counts": pa.array(counts, pa.binary()),
                    "h1": pa.array(one, pa.int64()), "h2": pa.array(two, pa.int64()),
                    name: pa.array(column, pa.list_(pa.int64())),
                }
            )
            del n, one, two, counts, column
            give_back()

    return work


def _prefixes(width: int, ratio: Ratio, frequent: Shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for batch in batches:
            n, one, prefix = [], [], []
            for s in _each_set(batch.column("text"), width):
                n.append(len(s))
                one.append(int(mixed(s).sum(dtype=np.uint64).astype(np.int64)))
                if len(last) and len(s):
                    late = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s
                    s = np.concatenate([s[~late], s[late]])
                prefix.append(s[: prefix_length(len(s), ratio)].astype(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()),
                    "h1": pa.array(one, pa.int64()),
                    "prefix": pa.array(prefix, pa.list_(pa.int64())),
                }
            )
            del n, one, prefix
            give_back()

    return work


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def described(docs: DataFrame, width: int, name: str, made) -> DataFrame:
    """One row a document: size and hashes of its set, counts by bucket, and a column of longs.

    That column is made from the sets of some texts, (all shingles, where each set begins), in
    the same pass over the texts.
    """
    schema = f"doc_id long, n long, counts binary, h1 long, h2 long, {name} array<long>"
    return stored(_texts(docs).mapInArrow(_summaries(width, name, made), schema), "sets")


def summaries(docs: DataFrame, width: int, ratio: Ratio) -> DataFrame:
    """One row a document: size and hashes of its set, prefix, counts by bucket."""
    return described(docs, width, "prefix", _heads(ratio))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row a document: doc_id, n, rep (smallest id with an equal set), h1."""
    reps = sets.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("least"))
    own = sets.select("doc_id", "n", "h1", "h2")
    joined = own.join(reps, ["n", "h1", "h2"], "left")
    return stored(
        joined.select("doc_id", "n", F.coalesce("least", "doc_id").alias("rep"), "h1"),
        "distinct-sets",
    )


def _frequent(sets: DataFrame) -> np.ndarray:
    df = sets.select(F.explode("prefix").alias("s")).groupBy("s").count()
    df = stored(df.filter(F.col("count") > FREQUENT), "frequent")
    bar = FREQUENT
    while df.filter(F.col("count") > bar).count() > MOST_FREQUENT:
        bar *= 2
    found = df.filter(F.col("count") > bar).select("s").toArrow()["s"].to_numpy()
    return np.sort(found.astype(np.uint64))


def _size_fits(a: Column, b: Column, ratio: Ratio) -> Column:
    return F.least(a, b) * ratio[1] >= F.greatest(a, b) * ratio[0]


def _place_fits(n: Column, k: Column, m: Column, j: Column, ratio: Ratio) -> Column:
    """Whether what is left behind a shared shingle can give the overlap that is needed."""
    return F.least(n - k, m - j) * sum(ratio) >= ratio[0] * (n + m)


def _few(ids: DataFrame) -> DataFrame:
    """Ids to be sent along, if their number allows it."""
    ids = stored(ids.distinct(), "ids")
    return F.broadcast(ids) if ids.count() <= SMALL_SIDE else ids


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, s) with the sorted shingles of the chosen documents."""

    @arrow_udf("array<long>")
    def shingled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            every = [s.astype(np.int64) for s in _each_set(texts, width)]
            yield pa.array(every, pa.list_(pa.int64()))
            del every
            give_back()

    chosen = _texts(docs).join(_few(ids), "doc_id", "left_semi")
    return chosen.select("doc_id", shingled(F.col("text")).alias("s"))


@arrow_udf(LongType())
def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    """Common elements of two sorted arrays without repeats."""
    out = np.zeros(len(a), np.int64)
    for i in range(len(a)):
        x, y = (c[i].values.to_numpy().view(np.uint64) for c in (a, b))
        if len(x) > len(y):
            x, y = y, x
        if len(y):
            out[i] = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return pa.array(out)


def possible(pairs: DataFrame, sets: DataFrame, ratio: Ratio) -> DataFrame:
    """The pairs (a, b) whose counts by bucket do not rule the ratio out."""

    @arrow_udf("boolean")
    def fits(na: pa.Array, nb: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        size = na.to_numpy() + nb.to_numpy()
        most = [_most_common(*c) for c in zip(a.to_pylist(), b.to_pylist(), size.tolist())]
        return pa.array(np.array(most, np.int64) * sum(ratio) >= size * ratio[0])

    side = lambda k: sets.select(
        F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("counts").alias(f"c{k}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.filter(fits("na", "nb", "ca", "cb")).select("a", "b").distinct()


def _compared(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The stored pairs (a, b) with the sizes of both sets and of what they share."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))
    )
    sets = stored(sets_of(docs, ids, width), "pair-sets")
    one = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    joined = pairs.join(one, "a").join(two, "b")
    out = stored(
        joined.select(
            "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"),
            overlap("sa", "sb").alias("common"),
        ),
        "compared",
    )
    discard(sets)
    return out


def _alike(ratio: Ratio) -> Column:
    union = F.col("na") + F.col("nb") - F.col("common")
    return (F.col("common") * ratio[1] >= union * ratio[0]) & (F.col("common") > 0)


def verified(
    docs: DataFrame, pairs: DataFrame, sets: DataFrame, width: int, ratio: Ratio
) -> DataFrame:
    """The pairs whose exact similarity reaches the ratio."""
    pairs = stored(possible(pairs, sets, ratio), "pairs")
    return _compared(docs, pairs, width).filter(_alike(ratio)).select("a", "b")


class Postings:
    """Which sets of one side hold a shingle; ``met`` counts the shingles looked up."""

    def __init__(self, column: np.ndarray, row: np.ndarray, sets: int, columns: int) -> None:
        order = np.argsort(column, kind="stable")
        self.row = row[order]
        self.start = np.searchsorted(column[order], np.arange(columns + 1))
        self.sets, self.met = sets, 0

    def shares(self, change: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """What each row of changes (1, -1 or 0 by column) adds to its overlap with every set."""
        out = np.zeros((len(change), self.sets), np.float32)
        used = change.any(axis=0)
        change, columns = change[:, used], columns[used]
        wide = max(1, STRIP_CELLS // max(self.sets, 1))
        for lo in range(0, len(columns), wide):
            part = columns[lo : lo + wide]
            count = self.start[part + 1] - self.start[part]
            own = np.repeat(np.arange(len(part)), count)
            at = np.arange(count.sum()) + (self.start[part] - np.cumsum(count) + count)[own]
            held = np.zeros((len(part), self.sets), np.float32)
            held[own, self.row[at]] = 1
            out += change[:, lo : lo + wide] @ held
        self.met += len(columns)
        return out


def derived_overlaps(
    sets: list[np.ndarray], postings: Postings
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of some sets (sorted columns), and their overlaps with every set of the other side.

    Sets with equal smallest and largest columns, which similar ones mostly have, are neighbours.
    The first set of a strip takes its overlaps from the first one of the strip before, and all
    others of the strip take theirs from it: only shingles in which two sets differ are looked
    up. That is exact however much they differ.
    """
    order = sorted(range(len(sets)), key=lambda i: (*sets[i][:1].tolist(), *sets[i][-1:].tolist()))
    largest = max((len(s) for s in sets), default=0)
    strip = int(max(1, min(64, (STRIP_CELLS / max(largest, 1)) ** 0.5)))
    known, base = np.zeros(0, np.int64), np.zeros(postings.sets, np.float32)
    for lo in range(0, len(order), strip):
        places = order[lo : lo + strip]
        rows = [known, *[sets[i] for i in places]]
        columns = np.unique(np.concatenate(rows))
        held = np.zeros((len(rows), len(columns)), np.float32)
        for k, own in enumerate(rows):
            held[k, np.searchsorted(columns, own)] = 1
        base = base + postings.shares(held[1:2] - held[0], columns)[0]
        known = rows[1]
        yield np.array(places), base + postings.shares(held[1:] - held[1], columns)


def _cell(ratio: Ratio):
    def links(key: tuple, rows: pa.Table) -> pa.Table:
        """Links between sets of a block of a group, or of two blocks, that join components."""
        ids, comp = rows["id"].to_numpy(), rows["component"].to_numpy()
        chunk = rows["chunk"].to_numpy()
        flat = rows["s"].combine_chunks()
        size = np.diff(flat.offsets.to_numpy())
        vocabulary, column = np.unique(flat.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(ids)), size)
        column = column[np.lexsort((column, row))]  # sorted within each set
        left = np.flatnonzero(chunk == chunk.min())
        right = np.flatnonzero(chunk == chunk.max())
        at = np.full(len(ids), -1)
        at[right] = np.arange(len(right))
        there = at[row] >= 0
        postings = Postings(column[there], at[row[there]], len(right), len(vocabulary))
        start = np.cumsum(size) - size
        sets = [column[start[i] : start[i] + size[i]] for i in left]
        parent = {int(k): int(k) for k in comp}

        def top(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        out = ([], [])
        for places, common in derived_overlaps(sets, postings):
            strip = left[places]
            total = size[strip][:, None] + size[right][None, :]
            good = (common * sum(ratio) >= total * ratio[0]) & (
                comp[strip][:, None] != comp[right][None, :]
            )
            x, y = np.nonzero(good)
            for i, j in zip(strip[x], right[y]):
                p, q = top(int(comp[i])), top(int(comp[j]))
                if p != q:  # one link between two components is enough
                    parent[max(p, q)] = min(p, q)
                    out[0].append(int(ids[i]))
                    out[1].append(int(ids[j]))
        del row, column, sets, postings
        give_back()
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return links


def _folded(counts: list[bytes], buckets: int) -> np.ndarray:
    parts = [np.frombuffer(c, np.uint8).reshape(-1, buckets).sum(axis=0) for c in counts]
    return np.array(parts, np.int16).reshape(-1, buckets)


def _list_cell(ratio: Ratio):
    def pairs(key: tuple, rows: pa.Table) -> pa.Table:
        """Pairs of a block of a long list that neither place nor counts rule out."""
        ids, n, k, comp, host, chunk = (
            rows[c].to_numpy() for c in ("id", "n", "k", "component", "host", "chunk")
        )
        counts = [c or b"" for c in rows["counts"].to_pylist()]
        width = np.array([len(c) for c in counts])
        one = np.flatnonzero(chunk == chunk.min())
        two = np.flatnonzero(chunk == chunk.max())
        out = ([], [])
        for p in np.unique(width[one]):
            for q in np.unique(width[two]):
                x, y = one[width[one] == p], two[width[two] == q]
                least = min(p, q)
                a, b = (
                    _folded([counts[i] for i in side], least) if least else None for side in (x, y)
                )
                for lo in range(0, len(x), 64):
                    i = x[lo : lo + 64, None]
                    total = n[i] + n[y]
                    good = (
                        (ids[i] < ids[y]) | ((chunk[i] != chunk[y]) & (ids[i] != ids[y]))
                    ) & (comp[i] != comp[y]) & ((host[i] != host[y]) | (host[i] < 0))
                    left = np.minimum(n[i] - k[i], n[y] - k[y])
                    good &= left * sum(ratio) >= total * ratio[0]
                    r, c = np.nonzero(good)
                    for at in range(0, len(r), 16_384):
                        u, v = r[at : at + 16_384], c[at : at + 16_384]
                        most = total[u, v]
                        if least:
                            apart = np.abs(a[lo + u] - b[v]).sum(axis=1, dtype=np.int64)
                            most = (most - apart) // 2
                        keep = most * sum(ratio) >= total[u, v] * ratio[0]
                        out[0].append(ids[x[lo + u[keep]]])
                        out[1].append(ids[y[v[keep]]])
        whole = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
        return pa.table({"a": pa.array(whole[0], pa.int64()), "b": pa.array(whole[1], pa.int64())})

    return pairs


def _long_lists(rest: DataFrame, summed: DataFrame, ratio: Ratio) -> DataFrame:
    """Pairs that long lists leave possible; a list is cut into blocks that meet each other."""
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    # An id may have several sets; each entry of a list meets the counts of its own.
    counts = summed.select(F.col("doc_id").alias("id"), "n", "h1", "counts").dropDuplicates(
        ["id", "n", "h1"]
    )
    cells = (
        rest.withColumn("chunks", F.ceil(F.col("entries") / BLOCK_ENTRIES).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .withColumn("other", other)
        .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
        .withColumn("host", F.coalesce("host", F.lit(-1)))
        .join(counts, ["id", "n", "h1"])
    )
    return cells.groupBy("s", "i", "j").applyInArrow(_list_cell(ratio), "a long, b long")


def _group_links(
    docs: DataFrame, members: DataFrame, width: int, ratio: Ratio
) -> DataFrame:
    """Links within groups (id, n, host, component) of similar sets; the host names the group."""
    groups = members.groupBy("host").agg(
        F.sum("n").alias("weight"), F.min("component").alias("lo"), F.max("component").alias("hi")
    ).filter("lo <> hi")
    open_ = stored(
        members.join(groups, "host").withColumn(
            "chunks", F.ceil(F.col("weight") / F.lit(BLOCK_SHINGLES)).cast("int")
        ).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .select("id", "host", "component", "chunk", "chunks"),
        "groups",
    )
    sets = sets_of(docs, open_.select(F.col("id").alias("doc_id")), width)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = (
        open_.withColumn("other", other)
        .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
        .join(sets.withColumnRenamed("doc_id", "id"), "id")
        .select("host", "i", "j", "id", "component", "chunk", "s")
    )
    return cells.groupBy("host", "i", "j").applyInArrow(_cell(ratio), "a long, b long")


def links(
    docs: DataFrame, summed: DataFrame, sets: DataFrame, width: int, ratio: Ratio
) -> DataFrame:
    """Pairs (a, b) of representatives that are linked and connect all components."""
    frequent = Shared(docs.sparkSession, _frequent(summed))
    reps = sets.filter("n > 0 AND doc_id = rep").select("doc_id", "n", "h1").distinct()
    prefixes = _texts(docs).mapInArrow(
        _prefixes(width, ratio, frequent), "doc_id long, n long, h1 long, prefix array<long>"
    )
    prefixes = stored(
        prefixes.join(reps, ["doc_id", "n", "h1"], "left_semi").select(
            F.col("doc_id").alias("id"), "n", "h1", "prefix"
        ),
        "prefixes",
    )
    index = prefixes.select(
        "id", F.col("n").cast("int").alias("n"), "h1", F.posexplode("prefix").alias("k", "s")
    )
    first = index.groupBy("s").agg(F.min("id").alias("lead"))
    lists = stored(index.join(first, "s").filter("id <> lead"), "lists")
    discard(prefixes)
    return links_of_lists(docs, lists, summed, width, ratio)


def links_of_lists(
    docs: DataFrame, lists: DataFrame, summed: DataFrame, width: int, ratio: Ratio
) -> DataFrame:
    """Links (a, b) that connect the components of all sets that share an index list.

    The lists are rows (s, id, n, h1, k, lead) without the lead's own entry: the set ``id`` of
    size n and hash h1 has the list's key at its position k; lead is the list's smallest id.
    """
    near = (ratio[0] * 8, ratio[1] * 10)  # similar enough to share a group
    star = lists.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    star = stored(possible(star, summed, near), "pairs")
    star = _compared(docs, star, width)
    found = [star.filter(_alike(ratio)).select("a", "b")]
    known = components(found[0])
    groups = components(star.filter(_alike(near)).select("a", "b")).select(
        "id", F.col("component").alias("host")
    )
    sizes = star.select(F.inline(F.array(
        F.struct(F.col("a").alias("id"), F.col("na").alias("n")),
        F.struct(F.col("b").alias("id"), F.col("nb").alias("n")),
    ))).groupBy("id").agg(F.min("n").alias("n"))
    hosts = groups.join(sizes, "id")
    own = F.coalesce("component", "id").alias("component")
    members = stored(hosts.join(known, "id", "left").select("id", "host", "n", own), "members")
    found.append(stored(_group_links(docs, members, width, ratio), "group-links"))

    rest = (
        lists.select("s", "id", "n", "h1", "k")
        .join(members.select("id", "host"), "id", "left").join(known, "id", "left")
        .select("s", "id", "n", "h1", "k", "host", own)
    )
    mixed_lists = rest.groupBy("s").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.count("*").alias("entries"),
    ).filter("lo <> hi").select("s", "entries")
    rest = stored(rest.join(mixed_lists, "s"), "rest")
    by_block = _long_lists(rest.filter(F.col("entries") > LONG_LIST), summed, ratio)
    rest = rest.filter(F.col("entries") <= LONG_LIST)
    block = F.floor(F.log("n") / F.log(F.lit(ratio[1] / ratio[0])))  # sets of similar size
    small = rest.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    large = rest.withColumn("block", block)
    x, y = small.alias("x"), large.alias("y")
    left = x.join(y, ["s", "block"]).filter(
        "(x.n < y.n OR (x.n = y.n AND x.id < y.id)) AND x.component <> y.component"
        " AND NOT coalesce(x.host = y.host, false)"
    ).filter(
        _size_fits(F.col("x.n"), F.col("y.n"), ratio)
        & _place_fits(F.col("x.n"), F.col("x.k"), F.col("y.n"), F.col("y.k"), ratio)
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    left = stored(left.unionByName(by_block).distinct(), "left-pairs")
    found.append(verified(docs, left, summed, width, ratio))
    return reduce(DataFrame.unionByName, found)


def with_components(sets: DataFrame, linked: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    comp = components(linked).select(F.col("id").alias("rep"), "component")
    return sets.join(comp, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"),
    )


def join(docs: DataFrame, width: int = 3, ratio: Ratio = (9, 10)) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    summed = summaries(docs, width, ratio)
    sets = distinct_sets(summed)
    return with_components(sets, links(docs, summed, sets, width, ratio))


def keep_first(docs: DataFrame, width: int = 5, ratio: Ratio = (4, 5)) -> DataFrame:
    """One document of each component, the one with the smallest id; repeated rows go, too.

    Different texts of one id are one document and stay together.  Of rows that only differ in
    other columns the first one in the order of their JSON text stays.
    """
    joined = stored(join(docs, width, ratio).select("doc_id", "component_id"), "joined")
    removed = joined.filter("doc_id <> component_id").select("doc_id")
    repeated = stored(
        joined.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1")
        .select("doc_id"),
        "repeated",
    )
    kept = docs.join(_few(removed.unionByName(repeated)), "doc_id", "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = (
        docs.join(_few(repeated), "doc_id", "left_semi").groupBy("doc_id", "text")
        .agg(F.min_by(whole, F.to_json(whole)).alias("_first")).select("_first.*")
    )
    return kept.select(*docs.columns).unionByName(once.select(*docs.columns))
