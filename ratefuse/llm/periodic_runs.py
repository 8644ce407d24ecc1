"""Periodic runs of words: found by seeds on diagonals, reported and collapsed.

A run is a longest stretch of words that repeats itself after q words, q being its smallest
period, of at least ``LEAST`` words and ``TIMES`` periods.  Words q apart match along the whole
run, so its diagonal (lag) q holds a matching stretch of a guaranteed length.  Lags are worked
through in classes [k/2, k) (the first: below k = 16): k-grams of words fit into the guaranteed
overlap of every lag of the class, and as they are no shorter than the lag, the next place of
the same k-gram in the document lies exactly one smallest period on.  So pairs of consecutive
places are enough seeds, never all pairs of a group.  A seed is extended word by word in both
directions, and a table of the furthest covered place of each lag skips seeds inside stretches
that were extended before.  The k-grams get exact names by doubling, from the words that still
repeat; nothing rests on a hash.

Work per text is about n log n; texts are worked through in steps of bounded bytes, several
short ones at once, a long one by itself.

Defined results: a null or empty text has no words, hence no runs.  A null id is not edited.
Repeated rows are reported each.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratefuse.llm.common import give_back, steps, strings

LEAST = 24
TIMES = 3
#: Words of the shortest seed: what two lagged copies share at least (LEAST, TIMES).
SEED = 16

OUT = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long,"
    " exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _names(*parts: np.ndarray) -> np.ndarray:
    """Numbers that are equal where all parts are."""
    out = parts[0]
    for part in parts[1:]:
        _, right = np.unique(part, return_inverse=True)
        _, out = np.unique(out * (int(right.max(initial=0)) + 1) + right, return_inverse=True)
    return out


def _next_place(name: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive places (here, next) of the same name in one document."""
    order = np.lexsort((at, name))
    here, there = order[:-1], order[1:]
    same = (name[here] == name[there]) & (doc[at[here]] == doc[at[there]])
    return at[here[same]], at[there[same]]


class Stretches:
    """Extends seeds along their lag; remembers how far each lag is covered."""

    def __init__(self, words: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        self.words, self.first, self.end = words, first, end  # end: of the document of a word
        self.covered: dict[int, int] = {}

    def extend(self, at: int, lag: int) -> tuple[int, int] | None:
        """The matching stretch [left, right) of the lag around a seed, unless it is known."""
        if at < self.covered.get(lag, -1):
            return None
        words, size = self.words, 64
        low, high = int(self.first[at]), int(self.end[at]) - lag
        right = at
        while right < high:
            stop = min(right + size, high)
            differ = np.flatnonzero(words[right:stop] != words[right + lag : stop + lag])
            if len(differ):
                right += int(differ[0])
                break
            right, size = stop, 2 * size
        left, size = at, 64
        while left > low:
            stop = max(left - size, low)
            differ = np.flatnonzero(words[stop:left] != words[stop + lag : left + lag])
            if len(differ):
                left = stop + int(differ[-1]) + 1
                break
            left, size = stop, 2 * size
        self.covered[lag] = right + 1
        return left, right


def find_runs(words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of documents laid end to end, by start and period.

    ``words`` holds a number for each different word, ``bounds`` where the documents begin and
    (last) end.  Runs do not cross documents.
    """
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(counts)), counts)
    first, end = np.repeat(bounds[:-1], counts), np.repeat(bounds[1:], counts)
    # A gram that would leave its document has no name; only words that still repeat go on.
    at, name, k = np.arange(len(words)), words.astype(np.int64), 1
    stretches, found, longest = Stretches(words, first, end), [], int(counts.max(initial=0))
    while len(at):
        low, high = (1, SEED) if k == SEED else (k // 2, k)
        if k >= SEED:
            here, there = _next_place(name, at, doc)
            lag = there - here
            seeds = (lag >= low) & (lag < high)
            for i, q in sorted(zip(here[seeds].tolist(), lag[seeds].tolist())):
                stretch = stretches.extend(i, q)
                if stretch and stretch[1] - stretch[0] + q >= max(LEAST, TIMES * q):
                    found.append((stretch[0], stretch[1] - stretch[0] + q, q))
            if 2 * k > longest or TIMES * high > longest:
                break
        # Grams of 2k words: two of k words, where both repeat in the document.
        here, there = _next_place(name, at, doc)
        kept = np.zeros(len(words) + 1, bool)
        kept[here] = kept[there] = True
        place = np.full(len(words) + 1, -1)
        place[at] = name
        at = at[kept[at]]
        at = at[at + 2 * k <= end[at]]
        at = at[kept[at + k]]
        name, k = _names(place[at], place[at + k]), 2 * k
    return sorted(found, key=lambda r: (r[0], r[2]))


def edited(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words with a repeating tail, for the ids whose checksum asks for it."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])


def _describe(runs: list[tuple[int, int, int]], words: list[bytes]) -> tuple:
    """The report of one document from its runs and its (edited) words."""
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    dropped = np.cumsum(cover[:-1]) > 0
    kept = [w for w, gone in zip(words, dropped.tolist()) if not gone] if runs else words
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        len(words), len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def report_texts(ids: list[int | None], texts: list[str], edit: bool = True) -> list[tuple]:
    """One report for each text; see ``OUT``."""
    numbers: dict[bytes, int] = {}
    parts = []
    for doc_id, text in zip(ids, texts):
        own = [numbers.setdefault(w, len(numbers)) for w in text.encode().split()]
        part = np.array(own, np.int64)
        parts.append(edited(part, doc_id) if edit else part)
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    runs: list[list] = [[] for _ in parts]
    for start, length, period in find_runs(words, bounds):
        k = int(np.searchsorted(bounds, start, "right")) - 1
        runs[k].append((start - int(bounds[k]), length, period))
    spelled = list(numbers)
    return [
        (doc_id, *_describe(found, [spelled[w] for w in part.tolist()]))
        for doc_id, found, part in zip(ids, runs, parts)
    ]


def _work(edit: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in OUT.split(",")]
        names = [c.split()[0] for c in OUT.split(",")]
        for batch in batches:
            for lo, hi in steps(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                rows = report_texts(part.column(0).to_pylist(), strings(part.column(1)), edit)
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], names
                )
        give_back()

    return work


def report(docs: DataFrame, edit: bool = False) -> DataFrame:
    """One row a document: its runs, the strongest one, and its text with runs collapsed.

    ``edit`` gives every tenth document a repeating tail first (see ``edited``).
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return own.mapInArrow(_work(edit), OUT)
