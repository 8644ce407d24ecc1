"""Language of a text by prediction by partial matching.

Each language has a tree of byte contexts of orders 0 to ``order`` with symbol counts. A byte
costs the escapes of the contexts that do not know it and the code of the longest one that
does (escape probability: distinct symbols over distinct symbols plus count). The statistics
are frozen: the cost of each known context with symbol is worked out once, for all languages,
and a text is scored by looking its bytes up. The language with the shortest code wins.

Defined results: ``und`` with score 0 for a text that is null or has no letter, or if nothing
could be learnt; ties go to the language first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ratefuse.llm.common import Shared, held_out, letters_in, steps, utf8
from ratefuse.operators.stored import stored

# Texts that each language gives at least, and languages up to which the shares are broadcast.
FLOOR, FEW_LANGS = 20.0, 100_000
RESULT = "struct<lang_pred: string, score: double>"


def contexts(data: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The byte and the ``order`` bytes before it as one number; line ends before a text."""
    gram = data.astype(np.uint64)
    size = np.diff(ends)
    for back in range(1, order + 1):
        before = np.empty_like(data)
        before[back:] = data[:-back] if back < len(data) else 0
        before[:back] = 10
        for k in range(back):
            before[ends[:-1][size > k] + k] = 10
        gram |= before.astype(np.uint64) << np.uint64(8 * back)
    return gram


class Lookup:
    """Row of a key, or -1, by hash tables that each hold what collided in the one before."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.levels = keys, []
        left = np.arange(len(keys))
        salt = 0x9E3779B97F4A7C15
        while len(left):
            bits = max(8, int(4 * len(left)).bit_length())
            slot = (keys[left] * np.uint64(salt)) >> np.uint64(64 - bits)
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, -1, np.int32)
            table[slot[first]] = left[first]
            self.levels.append((np.uint64(salt), np.uint64(64 - bits), table))
            left = np.delete(left, first)
            salt = (salt * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        left = None
        for salt, shift, table in self.levels:
            part = keys if left is None else keys[left]
            row = table[(part * salt) >> shift]
            hit = (row >= 0) & (self.keys[row] == part)
            if left is None:
                out[hit] = row[hit]
                left = np.flatnonzero(~hit)
            else:
                out[left[hit]] = row[hit]
                left = left[~hit]
            if not len(left):
                break
        return out


@dataclass
class Model:
    langs: list[str]
    grams: list[Lookup]  # by order: context with symbol
    costs: list[np.ndarray]  # bits in each language
    known: list[Lookup]  # by order: context
    escapes: list[np.ndarray]

    @property
    def order(self) -> int:
        return len(self.grams) - 1

    def bits(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        cost = np.full((len(data), len(self.langs)), 8.0, np.float32)
        gram = contexts(data, ends, self.order)
        left, owed = np.arange(len(data)), None
        for k in range(self.order, -1, -1):
            key = gram[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            row = self.grams[k].find(key)
            hit = row >= 0
            found = self.costs[k][row[hit]]
            cost[left[hit]] = found if owed is None else found + owed[hit]
            miss = ~hit
            left, key = left[miss], key[miss]
            owed = np.zeros((len(left), len(self.langs)), np.float32) if owed is None else owed[miss]
            if not len(left):
                break
            context = self.known[k].find(key >> np.uint64(8))
            there = context >= 0
            owed[there] += self.escapes[k][context[there]]
        if len(left):
            cost[left] += owed
        sums = np.zeros((len(ends) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            sums[full] = np.add.reduceat(cost, ends[:-1][full], axis=0, dtype=np.float64)
        return sums

    def predict(self, texts: pa.Array) -> pa.Array:
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        usable = letters_in(texts)
        if self.langs:
            for lo, hi in steps(texts, 1 << 20):
                part = texts.slice(lo, hi - lo)
                bits = self.bits(*utf8(part))
                best = bits.argmin(axis=1)
                ordered = np.sort(bits, axis=1)
                ahead = ordered[:, 1] - ordered[:, 0] if bits.shape[1] > 1 else np.full(hi - lo, 64.0)
                ok = usable[lo:hi]
                lang[lo:hi][ok] = np.array(self.langs, object)[best[ok]]
                score[lo:hi][ok] = 1.0 / (1.0 + np.exp2(-np.minimum(ahead[ok], 64.0)))
        return pa.StructArray.from_arrays(
            [pa.array(lang.tolist(), pa.string()), pa.array(score)], ["lang_pred", "score"]
        )


def _counts(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text")
            for lo, hi in steps(texts, 1 << 20):
                for lang in sorted(set(langs[lo:hi])):
                    chosen = pa.array(langs[lo:hi] == lang)
                    data, ends = utf8(texts.slice(lo, hi - lo).filter(chosen))
                    gram, n = np.unique(contexts(data, ends, order), return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(gram), pa.string()),
                            "gram": pa.array(gram.astype(np.int64)), "n": pa.array(n, pa.int64()),
                        }
                    )

    return count


def learn(
    docs: DataFrame, order: int = 4, per_lang: int = 500, least: int = 2, sample: int = 100_000
) -> Model:
    """Trees from about ``per_lang`` whole texts of every language, ``sample`` texts in all.

    With so many languages that both bounds cannot hold, each gives fewer texts, but about
    ``FLOOR`` if it has as many; none is left out. The texts are chosen by a hash of the id among the rows that may be learnt from.
    Contexts with symbol seen fewer than ``least`` times are left out of the trees.
    """
    usable = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    ).select("doc_id", "lang", "text")
    ids = stored(usable.select("lang").groupBy("lang").count(), "languages")
    langs = ids.count()
    each = max(FLOOR, min(per_lang, sample / max(1, langs)))
    share = ids.select("lang", F.least(F.lit(1.0), each / F.col("count")).alias("share"))
    if langs <= FEW_LANGS:
        share = F.broadcast(share)
    spread = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.join(share, "lang").filter(spread < F.col("share"))
    counts = (
        chosen.mapInArrow(_counts(order), "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    )
    table = stored(counts, "language-counts").toArrow()
    return _model(
        np.array(table["lang"].to_pylist(), object),
        table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy().astype(float), order,
    )


def _model(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int) -> Model:
    langs = sorted(set(lang.tolist()))
    column = np.searchsorted(np.array(langs, object), lang) if langs else np.zeros(0, int)
    model = Model(langs, [], [], [], [])
    lower, lower_cost = None, np.full((1, len(langs)), 8.0)
    for k in range(order + 1):
        cut = gram & np.uint64((1 << 8 * (k + 1)) - 1)
        keys, row = np.unique(cut, return_inverse=True)
        count = np.zeros((len(keys), len(langs)))
        np.add.at(count, (row, column), n)
        known, of = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(known), len(langs)))
        distinct = np.zeros_like(total)
        np.add.at(total, of, count)
        np.add.at(distinct, of, count > 0)
        whole = total + distinct
        escape = np.where(total > 0, np.log2(np.maximum(whole, 1) / np.maximum(distinct, 1)), 0.0)
        coded = np.where(count > 0, np.log2(np.maximum(whole[of], 1) / np.maximum(count, 0.5)), 0.0)
        if lower is None:
            shorter = np.zeros(len(keys), int)
        else:
            shorter = np.searchsorted(lower, keys & np.uint64((1 << 8 * k) - 1))
        cost = np.where(count > 0, coded, escape[of] + lower_cost[shorter])
        model.grams.append(Lookup(keys))
        model.costs.append(cost.astype(np.float32))
        model.known.append(Lookup(known))
        model.escapes.append(escape.astype(np.float32))
        lower, lower_cost = keys, cost
    return model


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score."""
    shared = Shared(docs.sparkSession, model)

    @arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        return shared.value.predict(texts)

    return docs.select(
        "doc_id", held_out().alias("held_out"), predict(F.col("text")).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
