"""Removal of passages that an earlier document has too, by longest-previous-factor arrays.

Every window of 50 bytes has a key, the smallest hash of the 20-byte strings in it, so equal
windows share a key. Neighbouring windows of one key form a context, and texts are compared
in this order:

1. Keys that occur in one document only are dropped, with all their windows.
2. Equal contexts are folded, pre-aggregated, to one in the smallest document. In every
   other document the whole context is a repeat; the marks of step 3 hold for all its places
   in the smallest one. Steps 1 and 2 go through the contexts a share of the keys after
   another, and keep of each only the places of repeats and of contexts for step 3.
3. The folded contexts of a key are put in suffix order. The nearest smaller documents before
   and after a suffix, with the common prefixes up to them, give its longest previous factor;
   a window is a repeat if that is 50 bytes or more.
4. A key of very many different contexts is dealt out by the windows themselves, which are
   folded like contexts and compared by a join that splits heavy windows.

Spans go back to their documents and are checked there against the hash of their context.
Texts move twice, a part of the documents after another the first time, the compared
contexts once.

Defined results: a null text is empty. A null id is later than all others; neither null ids
nor rows of one id repeat each other. Texts under 50 bytes keep everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratefuse.llm.common import discard, every_hash, prefix_hash, settle, span_hash, steps, utf8

LENGTH = 50
GRAM = 20
#: Bytes of text that one vectorised step works on.
STEP = 256 << 10
#: Contexts of one key that one task may sort; more go through their windows.
CONTEXTS = 4000
#: Shares of the keys that go through the first two steps one after another, which keeps what
#: lies on disk small; every share reads all texts. A power of two.
SHARES = 2
#: Parts of a share that are folded one after another. A power of two.
FOLDS = 2
#: Parts of the documents whose texts move to their listed contexts one after another.
PARTS = 2
#: Windows sorted at once.
SORTED = 100_000


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def runs_of_keys(
    data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, ...]:
    """Runs of windows that share a key: text, first byte, windows, key; sums of the bytes."""
    width = length - gram + 1
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_hash(data)
    key = smallest_in(every_hash(sums, gram), width)  # of the window that starts at each byte
    new = np.empty(len(key), bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    last = np.maximum(ends[1:] - length + 1, ends[:-1])  # behind the last window of each text
    edges = np.concatenate((ends[:-1], last))
    new[edges[edges < len(key)]] = True
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(key)))
    text = np.searchsorted(ends, start, "right") - 1
    whole = start < last[text]  # else over the end of a text
    start, n, text = start[whole], n[whole], text[whole]
    if len(n) and n.max() > width:  # repetitive text
        parts = -(-n // width)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + inner * width
        n = np.minimum(np.repeat(n, parts) - inner * width, width)
        text = np.repeat(text, parts)
    return text, start, n, key[start], sums


def contexts(
    data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, ...]:
    """Runs of windows that share a key: text, start in it, windows, key, hash of the bytes."""
    text, lo, n, key, sums = runs_of_keys(data, ends, length, gram)
    whole = span_hash(sums, lo, lo + n + length - 1)
    return text, lo - ends[text], n, key, whole


def _pieces(texts: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in steps: first row, offset in it, bytes, ends. Long texts come in several."""
    for lo, hi in steps(texts, STEP):
        data, ends = utf8(texts.slice(lo, hi - lo))
        if len(data) <= 2 * STEP:
            yield lo, 0, data, ends
            continue
        for at in range(0, len(data), STEP):
            part = data[at : at + STEP + length - 1]
            yield lo, at, part, np.array([0, len(part)])


#: A place is the start times 64 plus the number of windows, which is below 64. Columns that
#: compress well stand together; these rows are most of what is shuffled.
_CONTEXT = "part long, key long, whole long, doc long, place long"


def _contexts(length: int, gram: int, share: int):
    names = [c.split()[0] for c in _CONTEXT.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for row, offset, data, ends in _pieces(batch.column(2), length):
                text, lo, n, key, sums = runs_of_keys(data, ends, length, gram)
                own = np.flatnonzero(key & np.uint64(SHARES - 1) == share)
                text, lo, n, key = text[own], lo[own], n[own], key[own]
                whole = span_hash(sums, lo, lo + n + length - 1)
                place = lo - ends[text] + offset << 6 | n
                text = text + row
                columns = (part[text], key.view(np.int64), whole.view(np.int64), doc[text], place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names
                )

    return work


_KEYS = "key long, first long, last long"


def _keys(length: int, gram: int, share: int | None = None):
    """The keys, of a share or all, with the smallest and largest document that has them here."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            for row, _, data, ends in _pieces(batch.column(1), length):
                text, _, _, key, _ = runs_of_keys(data, ends, length, gram)
                if share is not None:
                    own = np.flatnonzero(key & np.uint64(SHARES - 1) == share)
                    text, key = text[own], key[own]
                at = doc[text + row]
                order = np.argsort(key)
                key, at = key[order], at[order]
                new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
                if len(new):
                    found = (
                        key[new].view(np.int64), np.minimum.reduceat(at, new),
                        np.maximum.reduceat(at, new),
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in found], ["key", "first", "last"]
                    )

    return work


def previous_factors(shared: np.ndarray, rank: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factors of suffixes in suffix order; 0 for those below ``least``.

    ``shared`` holds the common prefix of each suffix with the one before it (0 for the
    first) and ``rank`` the document. All suffixes look for the nearest smaller rank at once:
    one that meets no smaller rank takes over the pointer of the suffix that it met.
    """
    best = np.zeros(len(rank), np.int64)
    for turned in (False, True):
        order = rank[::-1] if turned else rank
        reach = np.append(shared[1:], 0)[::-1] if turned else shared
        reach = np.concatenate(([0], reach))  # entry 0 ends every chain
        reach[1] = 0
        point = np.arange(-1, len(order))
        point[0] = 0
        value = np.concatenate(([np.iinfo(np.int64).min], order))
        open_ = np.flatnonzero(reach >= least)
        while len(open_):
            open_ = open_[value[point[open_]] >= value[open_]]
            met = point[open_]
            low, onward = np.minimum(reach[open_], reach[met]), point[met]
            reach[open_], point[open_] = low, onward
            open_ = open_[low >= least]
        found = np.where(value[point] < value, reach, 0)[1:]
        best = np.maximum(best, found[::-1] if turned else found)
    return np.where(best >= least, best, 0)


def repeated_windows(
    data: np.ndarray, lo: np.ndarray, n: np.ndarray, doc: np.ndarray, length: int = LENGTH
) -> np.ndarray:
    """Bit j of each context is set if its window j also starts in a smaller document."""
    owner = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    windows = np.lib.stride_tricks.sliding_window_view(data, length)[lo[owner] + inner]
    order = np.argsort(np.ascontiguousarray(windows).view(f"S{length}").ravel(), kind="stable")
    windows = windows[order]
    differ = windows[1:] != windows[:-1]
    shared = np.zeros(len(order), np.int64)
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    again = order[previous_factors(shared, doc[owner[order]], length) >= length]
    bits = np.zeros(len(n), np.int64)
    np.bitwise_or.at(bits, owner[again], np.int64(1) << inner[again])
    return bits


_FOUND = "key long, whole long, bits long"


def _sorted(length: int):
    """Contexts that come ordered by key; a key is never cut."""

    def found(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        text = table["bytes"].combine_chunks().cast(pa.large_binary())
        _, offsets, buffer = text.buffers()
        at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text)]
        n, doc = table["n"].to_numpy(), table["doc"].to_numpy()
        data = np.frombuffer(buffer, np.uint8)
        bits = repeated_windows(data, at, n.astype(np.int64), doc, length)
        out = table.select(["key", "whole"]).append_column("bits", pa.array(bits, pa.int64()))
        return out.filter(pa.array(bits != 0)).combine_chunks()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held.append(table)
            windows += int(np.sum(batch.column("n").to_numpy()))
            if windows < SORTED:
                continue
            whole = pa.concat_tables(held)
            key = whole["key"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if cut:
                yield from found(whole.slice(0, cut)).to_batches()
            held = [whole.slice(cut)]
            windows = int(np.sum(held[0]["n"].to_numpy()))
        if windows:
            yield from found(pa.concat_tables(held)).to_batches()

    return work


def _cut(length: int):
    """The bytes of the contexts listed for each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "hot", "doc", "n", "whole", "bytes"]
        for batch in batches:
            lists = batch.column("contexts")
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(batch)), size)
            flat = lists.flatten()
            place, whole = (flat.field(k).to_numpy() for k in ("place", "whole"))
            lo, n = place >> 6, place & 63
            data, ends = utf8(batch.column("text"))
            good = ends[owner] + lo + n + length - 1 <= ends[owner + 1]  # else of a like id
            start = ends[owner] + lo
            good[good] = _hashes(data, start[good], n[good] + length - 1) == whole[good]
            pick = np.flatnonzero(good)
            raw, begin = data.tobytes(), start[pick]
            end = begin + n[pick] + length - 1
            of = pa.array(owner[pick])
            flat = flat.take(pa.array(pick))
            yield pa.RecordBatch.from_arrays(
                [
                    flat.field("key"), flat.field("hot"),
                    batch.column("doc").take(of), pa.array(n[pick]), flat.field("whole"),
                    pa.array([raw[a:b] for a, b in zip(begin, end)], pa.binary()),
                ],
                names,
            )

    return work


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of short spans, a step of the bytes at a time."""
    out = np.zeros(len(start), np.int64)
    order = np.argsort(start, kind="stable")
    cuts = np.searchsorted(start[order], np.arange(0, len(data) + STEP, STEP))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a == b:
            continue
        some, at = order[a:b], k * STEP
        first = start[some] - at
        sums = prefix_hash(data[at : at + int((first + size[some]).max())])
        out[some] = span_hash(sums, first, first + size[some]).view(np.int64)
    return out


def covered(lo: np.ndarray, n: np.ndarray, bits: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs of bytes under the marked windows, one (start, end) a row."""
    width = int(n.max()) if len(n) else 0
    marked = (bits[:, None] >> np.arange(width)) & 1 == 1
    start = np.unique((lo[:, None] + np.arange(width))[marked])
    if not len(start):
        return np.zeros((0, 2), np.int64)
    first = np.concatenate(([True], start[1:] > start[:-1] + length))
    last = np.append(first[1:], True)
    return np.stack([start[first], start[last] + length], axis=1)


def _removed(length: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            data, ends = utf8(batch.column("text"))
            lists = batch.column("found")
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.concatenate(([0], np.cumsum(size)))
            flat = lists.flatten()
            place, whole, bits = (
                flat.field(k).to_numpy(zero_copy_only=False) for k in ("place", "whole", "bits")
            )
            lo, n = place >> 6, place & 63
            bits = np.where(bits == 0, (np.int64(1) << n) - 1, bits)
            owner = np.repeat(np.arange(len(batch)), size)
            good = ends[owner] + lo + n + length - 1 <= ends[owner + 1]
            start = ends[owner] + lo
            good[good] = _hashes(data, start[good], n[good] + length - 1) == whole[good]
            for k in range(len(batch)):
                text = data[ends[k] : ends[k + 1]]
                own = slice(upto[k], upto[k + 1])
                use = good[own]
                runs = covered(lo[own][use], n[own][use], bits[own][use], length)
                stay = np.ones(len(text), bool)
                for a, b in runs:
                    stay[a:b] = False
                spans.append([{"start": int(a), "end": int(b)} for a, b in runs])
                kept.append(text[stay].tobytes() if len(runs) else text.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                    pa.array(spans, kind), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    return work


def _windows(hot: DataFrame, length: int) -> DataFrame:
    """The repeated windows of contexts whose key has very many of them."""
    each = hot.select(
        "key", "doc", "whole", "bytes",
        F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("j"),
    ).withColumn("window", F.substring(F.col("bytes"), F.col("j") + 1, F.lit(length)))
    each = each.drop("bytes")
    least = each.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    least = least.filter("first < last").drop("last")
    return (
        each.join(least, "window").filter("first < doc")
        .groupBy("key", "whole").agg(F.bit_or(F.expr("shiftleft(1L, j)")).alias("bits"))
    )


def _met(own: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts that are repeats or are to be compared with others of their key.

    Repeats have no key; of those to compare, one place of each is the leading one.
    """
    texts = own.select("doc", "part", "text")
    keys = (
        texts.select("doc", "text").mapInArrow(_keys(length, gram), _KEYS)
        .groupBy("key").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .filter("first < last").select("key")
    )
    keys = settle(keys, "repeats-keys")
    at = F.struct("doc", "part", "place")
    shares = []
    for share in range(SHARES):
        of_share = keys.filter(F.col("key").bitwiseAND(F.lit(SHARES - 1)) == share)
        runs = texts.mapInArrow(_contexts(length, gram, share), _CONTEXT)
        meet = settle(runs.join(of_share, "key", "left_semi"), "repeats-contexts")
        for fold in range(FOLDS):
            some = meet.filter(F.shiftright("key", 8).bitwiseAND(F.lit(FOLDS - 1)) == fold)
            folded = some.groupBy("key", "whole").agg(F.min(at).alias("at"))
            folded = settle(folded, "repeats-folded")
            sizes = folded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
            met = (
                some.join(folded.join(sizes, "key", "left"), ["key", "whole"])
                .filter("at.doc < doc or size is not null")
                .select(
                    "doc", "part", "place", "whole",
                    F.when(F.col("at.doc") == F.col("doc"), F.col("key")).alias("key"),
                    (at == F.col("at")).alias("lead"),
                    (F.col("size") > F.lit(CONTEXTS)).alias("hot"),
                )
            )
            shares.append(settle(met, "repeats-met"))
            discard(folded)
        discard(meet)
    discard(keys)
    return reduce(DataFrame.unionByName, shares)


#: Bits of 0 stand for all windows of a context.
_PLACED = ["doc", "part", "place", "whole", "bits"]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """What each document keeps: doc_id, n_bytes, removed spans, and the kept bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("part"),
        text.alias("text"),
    )
    met = _met(own, length, gram)
    bytes_ = []
    for k in range(PARTS):
        mine = F.pmod(F.xxhash64("doc", "part"), F.lit(PARTS)) == k
        listed = (
            met.filter(F.col("lead") & mine).groupBy("doc", "part")
            .agg(F.collect_set(F.struct("key", "hot", "place", "whole")).alias("contexts"))
        )
        cut = own.select("doc", "part", "text").filter(mine).join(listed, ["doc", "part"])
        cut = cut.mapInArrow(
            _cut(length), "key long, hot boolean, doc long, n long, whole long, bytes binary"
        )
        bytes_.append(settle(cut, "repeats-bytes"))
    bytes_ = reduce(DataFrame.unionByName, bytes_)
    in_order = (
        bytes_.filter(~F.col("hot")).drop("hot").repartition("key").sortWithinPartitions("key")
        .mapInArrow(_sorted(length), _FOUND)
    )
    marked = in_order.unionByName(_windows(bytes_.filter("hot"), length))
    marked = settle(marked, "repeats-marked")
    discard(bytes_)  # all parts
    bits = marked.groupBy("key", "whole").agg(F.bit_or("bits").alias("bits"))
    some = settle(met.join(bits, ["key", "whole"]).select(_PLACED), "repeats-found")
    discard(marked)
    found = met.filter("key is null").withColumn("bits", F.lit(0).cast("long")).select(_PLACED)
    by_doc = (  # moved row by row: few rows of a document stand together before
        found.unionByName(some).repartition("doc", "part").groupBy("doc", "part")
        .agg(F.collect_list(F.struct("place", "whole", "bits")).alias("found"))
    )
    return own.join(by_doc, ["doc", "part"], "left").select("doc_id", "text", "found").mapInArrow(
        _removed(length),
        "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary",
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, and the hash of what is kept."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
