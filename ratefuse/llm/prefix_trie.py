"""Prefix trie of conversations, built as double-array tries over ranges of the prefix order.

A conversation is the chain of its turns; a node is a distinct chain of first turns.  Rebuilt
conversations are put in the order of their chains and cut into shards at sampled split points
(chain, conversation), so that a first turn, or a whole conversation, that a large share of all
conversations begin with is split like any other.  Each shard numbers its turns densely, packs
them into BASE and CHECK arrays, walks all its chains through them and aggregates its nodes from
the leaves up.  Neighbouring shards can only share nodes that are first turns of the split point
between them: those are reported as parts, merged over all shards, and summed along their
ancestors.  There are at most (shards * length of a split point) of them, so what is broadcast
is counted first, and joined by a shuffle beyond ``SMALL_SIDE``.

The ids that end in a shared node are hashed as one stream of pieces in order, one piece in
memory at a time.

Defined results: a null role or text is empty.  Rows without a conv_id belong to no
conversation.  Equal turns are ordered by role and then by the checksum of role and text;
repeated rows are turns each.  An empty table has no nodes.  Other columns are ignored.  One
conversation is one row of 20 bytes a turn, so the longest has to fit into a task; the number of
conversations that share a prefix has no bound.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

from ratefuse.llm.common import Shared, give_back, word_count
from ratefuse.operators.stored import stored

#: Bytes of a turn in a chain: checksum of role and text, number of words.
TURN = 20
FAMILY = 20
SMALL_SIDE = 100_000
#: Turns that a shard should hold, and split candidates looked at for each shard.
SHARD_TURNS = 50_000
SAMPLES = 20
PIECE = 1 << 20
NO_IDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "kind string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, words long, path binary,"
    " shard long, piece long, ids string"
)


def chains(turns: DataFrame) -> DataFrame:
    """(conv_id, path): the turns of each conversation in order, ``TURN`` bytes each."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.concat(
        F.md5(said.cast("binary")), F.lpad(F.hex(F.least(word_count(text), F.lit(2**32 - 1))), 8, "0")
    )
    own = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), turn.alias("key")).alias("said"),
    )
    # Rows of a family of conversations meet in one partition, which the head join uses again.
    placed = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    listed = F.sort_array(F.collect_list("said"))
    keys = F.transform(listed, lambda s: s["key"])
    return (
        placed.repartition("family").groupBy("family", "conv_id")
        .agg(F.unhex(F.array_join(keys, "")).alias("path"))
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation with its first turns taken from the first one of its family."""
    heads = own.filter("conv_id = family").select(
        "family", F.substring("path", 1, 3 * TURN).alias("head")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    head = F.coalesce(F.col("head"), F.unhex(F.lit("")))
    first = F.expr(f"substring(head, 1, {TURN} * taken)")
    rest = F.expr(f"substring(path, {TURN} * taken + 1)")
    return (
        own.join(heads, "family", "left").withColumns({"head": head, "taken": taken})
        .select("conv_id", F.concat(first, rest).alias("path"))
    )


# ------------------------------------------------------------------------ one shard


class DoubleArray:
    """A trie over chains of dense numbers; state 0 is the root.

    The child of state s by number c is t = BASE[s] + c if CHECK[t] == s.
    """

    def __init__(self, chain: np.ndarray, begin: np.ndarray) -> None:
        """``chain``: numbers from 1 of all chains end to end; chains in order, each once."""
        self.chain, self.begin, self.size = chain, begin, np.diff(begin)
        self.base = np.zeros(1, np.int64)
        self.check = np.array([-2], np.int64)  # -1: free
        self.free_from = 1
        state = np.zeros(len(self.size), np.int64)
        live = np.arange(len(self.size))
        depth = 0
        while len(live := live[self.size[live] > depth]):
            number = chain[begin[live] + depth]
            parent = state[live]
            new = np.concatenate(
                ([True], (parent[1:] != parent[:-1]) | (number[1:] != number[:-1]))
            )
            child = self._pack(parent[new], number[new])
            state[live] = child[np.cumsum(new) - 1]
            depth += 1

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            more = max(more, len(self.check) // 2)
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def _pack(self, parent: np.ndarray, number: np.ndarray) -> np.ndarray:
        """States for the children (parent, number) of one level; a parent's lie together."""
        first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        count = np.diff(np.append(first, len(parent)))
        child = np.zeros(len(parent), np.int64)
        for at, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            own = number[at : at + n]
            base = self._fit(own)
            child[at : at + n] = base + own
            self.base[parent[at]] = base
            self.check[base + own] = parent[at]
        single = first[count == 1]
        if len(single):  # one child fits into any free place
            place = self._free(len(single))
            child[single] = place
            self.base[parent[single]] = place - number[single]
            self.check[place] = parent[single]
        return child

    def _free(self, n: int) -> np.ndarray:
        """The first n free places."""
        found, have, at, step = [], 0, self.free_from, max(4 * n, 256)
        while have < n:
            if at >= len(self.check):
                self._grow(len(self.check) + n)
            part = np.flatnonzero(self.check[at : at + step] == -1) + at
            found.append(part)
            have += len(part)
            at += step if at + step <= len(self.check) else len(self.check) - at
        places = np.concatenate(found)[:n]
        self.free_from = int(places[0])
        return places

    def _fit(self, own: np.ndarray) -> int:
        """A base that puts all numbers of a parent on free places."""
        low, high = int(own.min()), int(own.max())
        for place in self._free(16).tolist():
            base = place - low
            self._grow(base + high + 1)
            if (self.check[base + own] == -1).all():
                return base
        base = len(self.check) - low  # behind everything else
        self._grow(base + high + 1)
        return base

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, chains, states): every chain through the arrays, level by level."""
        state = np.zeros(len(self.size), np.int64)
        live = np.arange(len(self.size))
        yield 0, live, state.copy()
        depth = 0
        while len(live := live[self.size[live] > depth]):
            there = self.base[state[live]] + self.chain[self.begin[live] + depth]
            assert (self.check[there] == state[live]).all()
            state[live] = there
            depth += 1
            yield depth, live, there

    def child(self, state: int, number: int | None) -> int | None:
        if number is None:
            return None
        there = int(self.base[state]) + number
        if 0 < there < len(self.check) and self.check[there] == state:
            return there
        return None


def _numbered(paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dense numbers of the turns (level by level, so that siblings lie close), chain bounds,
    the bytes of each number, and its words."""
    turn = np.frombuffer(b"".join(paths), np.dtype(f"S{TURN}"))
    size = np.array([len(p) // TURN for p in paths], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    depth = np.arange(len(turn)) - np.repeat(begin[:-1], size)
    order = np.argsort(depth, kind="stable")
    kinds, first, number = np.unique(turn[order], return_index=True, return_inverse=True)
    rank = np.empty(len(kinds), np.int64)
    by_first = np.argsort(first)
    rank[by_first] = np.arange(1, len(kinds) + 1)
    chain = np.empty(len(turn), np.int64)
    chain[order] = rank[number]
    kinds = kinds[by_first]
    raw = np.zeros((len(kinds), TURN), np.uint8)
    if len(kinds):
        raw = np.frombuffer(kinds.tobytes(), np.uint8).reshape(-1, TURN)
    words = np.ascontiguousarray(raw[:, 16:]).view(">u4").reshape(-1).astype(np.int64)
    return chain, begin, raw, np.concatenate(([0], words))


def shard_nodes(
    shard: int, rows: list[tuple[bytes, int]], cuts: list[bytes]
) -> Iterator[dict]:
    """Nodes of one shard (kind ``node``), its parts of shared nodes (``part``) and the ids
    that end in those (``ids``).  ``cuts``: the chains of the split points around the shard.
    """
    rows.sort()
    paths, at = [], []
    for k, (path, _) in enumerate(rows):
        if not paths or path != paths[-1]:
            paths.append(path)
            at.append(k)
    at.append(len(rows))
    ids = np.array([c for _, c in rows], np.int64)
    chain, begin, turns, words_of = _numbered(paths)
    trie = DoubleArray(chain, begin)
    size = len(trie.check)
    members = np.diff(np.array(at))
    smallest = np.minimum.reduceat(ids, at[:-1])
    n_convs, depth_of, words = (np.zeros(size, np.int64) for _ in range(3))
    conv = np.full(size, np.iinfo(np.int64).max)
    levels, end = [], np.zeros(len(paths), np.int64)
    for depth, live, state in trie.walk():
        np.add.at(n_convs, state, members[live])
        np.minimum.at(conv, state, smallest[live])
        depth_of[state] = depth
        if depth:
            words[state] = words_of[chain[begin[live] + depth - 1]]
        end[live] = state
        levels.append(np.unique(state))

    known = {t.tobytes(): k for k, t in enumerate(turns, 1)} if cuts else {}
    shared = {0: b""}
    for cut in cuts:
        state = 0
        for k in range(len(cut) // TURN):
            state = trie.child(state, known.get(cut[TURN * k : TURN * k + TURN]))
            if state is None:
                break
            shared[state] = cut[: TURN * (k + 1)]
    is_shared = np.zeros(size, bool)
    is_shared[list(shared)] = True

    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for depth in range(len(levels) - 1, -1, -1):
        own = levels[depth][~is_shared[levels[depth]]]
        leaves[own[children[own] == 0]] = 1
        saved[own] += (n_convs[own] - 1) * words[own]
        if depth:
            parent = trie.check[own]
            np.add.at(children, parent, 1)
            np.add.at(leaves, parent, leaves[own])
            np.add.at(saved, parent, saved[own])

    digest = {}
    for k, state in enumerate(end.tolist()):
        here = ids[at[k] : at[k + 1]]
        if not is_shared[state]:
            digest[state] = hashlib.sha256(",".join(map(str, here.tolist())).encode()).hexdigest()
            continue
        step = PIECE // 20
        for piece in range(0, len(here), step):
            yield {
                "kind": "ids", "path": shared[state], "shard": shard, "piece": piece // step,
                "ids": ",".join(map(str, here[piece : piece + step].tolist())),
            }
    for state in np.concatenate(levels).tolist():
        row = {
            "kind": "part" if is_shared[state] else "node", "depth": int(depth_of[state]),
            "conv_id": int(conv[state]), "n_convs": int(n_convs[state]),
            "n_children": int(children[state]), "n_leaves": int(leaves[state]),
            "saved_tokens": int(saved[state]),
        }
        if is_shared[state]:
            yield row | {"path": shared[state], "words": int(words[state])}
            continue
        parent = int(trie.check[state])
        above = {"path": shared[parent]} if is_shared[parent] else {
            "parent_conv_id": int(conv[parent])}
        yield row | above | {"ends_sha256": digest.get(state, NO_IDS)}


# ------------------------------------------------------------------------ all shards


def split_points(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Cuts (chain, conv_id) into about equal shares, from a sample of bounded size.

    A chain is shortened to the turns that tell it from the cut before it.
    """
    if shards < 2:
        return []
    rank = F.xxhash64("conv_id")
    sample = sorted(
        (bytes(r["path"]), r["conv_id"])
        for r in paths.select("path", "conv_id").orderBy(rank, "conv_id").limit(SAMPLES * shards).collect()
    )
    picked = [sample[k * len(sample) // shards] for k in range(1, shards) if sample]
    cuts: list[tuple[bytes, int]] = []
    before = b""
    for path, conv_id in picked:
        k = 0
        while path[k : k + TURN] == before[k : k + TURN] and k < len(path):
            k += TURN
        # One turn beyond what is shared; of equal chains the id decides.
        short = path[: k + TURN]
        cut = (short, conv_id if short == path else -(2**63))
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
        before = path
    return cuts


def _shard_of(cuts: Shared) -> Column:
    @pandas_udf(IntegerType())
    def shard(path, conv_id):
        import pandas as pd

        points = cuts.value
        return pd.Series(
            [bisect_right(points, (bytes(p), c)) for p, c in zip(path, conv_id)], dtype="int32"
        )

    return shard("path", "conv_id")


def _build(cuts: Shared):
    def build(table: pa.Table) -> pa.Table:
        points = cuts.value
        shard = table.column("shard")[0].as_py()
        around = [points[k][0] for k in (shard - 1, shard) if 0 <= k < len(points)]
        rows = list(zip(table.column("path").to_pylist(), table.column("conv_id").to_pylist()))
        out = pa.Table.from_pylist(list(shard_nodes(shard, rows, around)), _schema(NODE))
        give_back()
        return out

    return build


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(","))])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each path from its pieces, which come in order."""
    path, state, done = None, None, []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [(), ()]
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())],
            ["path", "ends_sha256"],
        )

    for batch in batches:
        for own, ids in zip(batch.column("path"), batch.column("ids")):
            own, text = own.as_py(), ids.as_py().encode()
            if own != path:
                if state:
                    done.append((path, state.hexdigest()))
                path, state = own, hashlib.sha256(text)
            else:
                state.update(b"," + text)
        yield flush()
    if state:
        done.append((path, state.hexdigest()))
    yield flush()


def _merged(built: DataFrame, small: bool) -> DataFrame:
    """Shared nodes, complete: the parts of all shards summed, then summed over descendants."""
    parts = built.filter("kind = 'part'").groupBy("path", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("words").alias("words"), F.sum("n_children").alias("own_children"),
        F.sum("n_leaves").alias("own_leaves"), F.sum("saved_tokens").alias("own_saved"),
    )
    parts = stored(parts, "trie-shared")
    above = F.expr(f"substring(path, 1, {TURN} * (depth - 1))")
    below = parts.filter("depth > 0").select(above.alias("path")).groupBy("path").count()
    nodes = parts.join(below, "path", "left").withColumn(
        "n_children", F.col("own_children") + F.coalesce("count", F.lit(0))
    )
    nodes = nodes.withColumn(
        "own_leaves", F.col("own_leaves") + (F.col("n_children") == 0).cast("long")
    ).withColumn("own_saved", F.col("own_saved") + (F.col("n_convs") - 1) * F.col("words"))
    sums = (
        nodes.select(
            F.explode(F.sequence(F.lit(0), "depth")).alias("up"), "path", "own_leaves", "own_saved"
        )
        .groupBy(F.expr(f"substring(path, 1, {TURN} * up)").alias("path"))
        .agg(F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens"))
    )
    ids = built.filter("kind = 'ids'").select("path", "shard", "piece", "ids")
    digests = (
        ids.repartition("path").sortWithinPartitions("path", "shard", "piece")
        .select("path", "ids").mapInArrow(_streamed, "path binary, ends_sha256 string")
    )
    parents = parts.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.withColumn("up", F.when(F.col("depth") > 0, above))
        .join(F.broadcast(parents) if small else parents, "up", "left")
        .join(sums, "path").join(digests, "path", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    )


RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of (conv_id, path), each conversation once."""
    spark = paths.sparkSession
    paths = stored(paths, "trie-chains")
    total = paths.agg(F.sum(F.octet_length("path") / TURN + 1)).first()[0] or 0
    cuts = split_points(paths, int(total // shard_turns) + 1)
    shared = Shared(spark, cuts)
    sharded = paths.withColumn("shard", _shard_of(shared) if cuts else F.lit(0))
    built = stored(sharded.groupBy("shard").applyInArrow(_build(shared), NODE), "trie-shards")
    small = sum(len(path) // TURN + 1 for path, _ in cuts) <= SMALL_SIDE
    merged = stored(_merged(built, small), "trie-merged")
    tops = merged.select("path", F.col("conv_id").alias("top"))
    whole = built.filter("kind = 'node'").join(F.broadcast(tops) if small else tops, "path", "left")
    closed = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top"))
    return closed.select(*RESULT).unionByName(merged.select(*RESULT))


def family_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    return nodes(rebuilt(chains(turns)), shard_turns)
