"""Quality of documents from their lines, by a linear-chain conditional random field.

Every line with visible text is good or bad.  A line's score comes from counts of its bytes,
byte pairs, words and repeats, from the same counts of the line before and the line behind, and
from the states of its neighbours.  Forward and backward messages give each line's probability
of being good; a document's quality is their mean, weighted by the length of the lines, brought
to the scale of the labels by a logistic curve.

Only documents carry labels, so line labels are learnt with the field: lines of good documents
are good; lines of bad ones are bad at first and then those that the field calls bad, but always
the worst of a document.  The field is fitted on a bounded sample (``per_label`` labelled
documents of each kind in the order of a hash of the id, as far as ``sample_bytes`` of text a
kind go); everything else covers all documents and whole texts.

Defined results: a text without visible lines (null, empty, blank) has the share of good
documents among the labels as score.  Null or unknown labels teach nothing; a document with
several labels is bad if one says so; of several texts of a labelled id the smallest teaches.
Without labels of both kinds every score is that share, 1 without any label.  Repeated rows are
scored alike, one by one.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ratefuse.llm.common import (
    SPACES, give_back, held_out, mixed, prefix_hash, span_hash, steps, utf8, word_spans,
)
from ratefuse.operators.stored import stored

#: Lines and bytes that one feature matrix is built from at a time.
BLOCK_LINES = 1 << 13
BLOCK_BYTES = 1 << 20

_PUNCT = [b for b in range(33, 127) if not chr(b).isalnum()]
#: Fine byte classes: lower, upper, digit, space, other byte, not ASCII, then each sign.
_FINE = np.full(256, 4, np.int64)
_FINE[97:123], _FINE[65:91], _FINE[48:58], _FINE[128:] = 0, 1, 2, 5
_FINE[list(SPACES)] = 3
_FINE[_PUNCT] = 6 + np.arange(len(_PUNCT))
N_FINE = 6 + len(_PUNCT)
#: Coarse classes for pairs: the first six as they are, marks that end sentences, other signs.
_COARSE = np.minimum(_FINE, 7)
_COARSE[[ord(c) for c in ".,;:"]] = 6
N_PAIRS = 64
N_WORDS = 10
N_FEATURES = N_FINE + N_PAIRS + N_WORDS
_VISIBLE = np.ones(256, bool)
_VISIBLE[list(SPACES)] = False


@dataclass
class Lines:
    """The visible lines of some texts, and what the field needs of them."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    weight: np.ndarray  # visible bytes


def visible_lines(data: np.ndarray, ends: np.ndarray) -> Lines:
    """Lines end at newlines and at the end of their text."""
    cuts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, ends]))
    seen = np.concatenate(([0], np.cumsum(_VISIBLE[data])))
    start, end = cuts[:-1], cuts[1:]
    weight = seen[end] - seen[start]
    kept = weight > 0
    start, end = start[kept], end[kept]
    doc = np.searchsorted(ends, start, "right") - 1
    return Lines(start, end, doc, weight[kept])


def _counts(data: np.ndarray, lines: Lines, lo: int, hi: int) -> np.ndarray:
    """Shares of byte classes and pairs of byte classes of the lines lo to hi."""
    out = np.zeros((hi - lo, N_FINE + N_PAIRS), np.float32)
    first, last = int(lines.start[lo]), int(lines.end[hi - 1])
    for at in range(first, last, BLOCK_BYTES):  # a long line is counted piece by piece
        stop = min(at + BLOCK_BYTES, last)
        here = np.searchsorted(lines.start, np.arange(at, stop), "right") - 1
        inside = np.arange(at, stop) < lines.end[here]
        base, n = int(here[0]), int(here[-1] - here[0] + 1)
        fine = np.bincount(
            ((here - base) * N_FINE + _FINE[data[at:stop]])[inside], minlength=n * N_FINE
        )
        following = np.minimum(np.arange(at, stop) + 1, len(data) - 1)
        paired = inside & (following < lines.end[here]) & (following > np.arange(at, stop))
        pair = 8 * _COARSE[data[at:stop]] + _COARSE[data[following]]
        pairs = np.bincount(((here - base) * N_PAIRS + pair)[paired], minlength=n * N_PAIRS)
        rows = slice(base - lo, base - lo + n)
        out[rows, :N_FINE] += fine.reshape(n, N_FINE)
        out[rows, N_FINE:] += pairs.reshape(n, N_PAIRS)
    size = (lines.end[lo:hi] - lines.start[lo:hi]).astype(np.float32)
    return np.sqrt(out / size[:, None])


class WordFacts:
    """Words of the lines: how many there are, and how they repeat."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, lines: Lines) -> None:
        start, end, _ = word_spans(data, ends)
        sums = prefix_hash(data)
        self.word = span_hash(sums, start, end)
        self.line = np.searchsorted(lines.start, start, "right") - 1
        signs = np.concatenate(([0], np.cumsum(_FINE[data] >= 6)))
        self.signed = signs[end] - signs[np.maximum(end - 2, start)] == 2
        self.bare = signs[end] - signs[start] == end - start
        self.size = end - start
        same = span_hash(sums, lines.start, lines.end)
        _, group, copies = np.unique(
            mixed(same + lines.doc.astype(np.uint64)), return_inverse=True, return_counts=True
        )
        self.again = copies[group] > 1

    def table(self, lo: int, hi: int) -> np.ndarray:
        a, b = np.searchsorted(self.line, [lo, hi])
        line, word = self.line[a:b] - lo, self.word[a:b]
        n = hi - lo

        def share(found: np.ndarray) -> np.ndarray:
            return np.bincount(line[found], minlength=n) / words

        words = np.maximum(np.bincount(line, minlength=n), 1).astype(np.float32)
        _, once = np.unique(mixed(word + line.astype(np.uint64)), return_index=True)
        mean = np.bincount(line, self.size[a:b], minlength=n) / words
        twice = [
            np.concatenate((np.zeros(min(k, len(word)), bool),
                            (word[k:] == word[:-k]) & (line[k:] == line[:-k])))
            for k in (1, 2)
        ]
        columns = [
            np.log1p(words), np.log1p(mean), share(twice[0]), share(twice[1]), share(once),
            share(self.signed[a:b]), share(self.bare[a:b]), words == 1,
            self.again[lo:hi], np.log1p(words) * (1 - share(once)),
        ]
        return np.stack([np.asarray(c, np.float32) for c in columns], 1)


def feature_blocks(
    data: np.ndarray, ends: np.ndarray, lines: Lines
) -> Iterator[tuple[int, int, np.ndarray]]:
    facts = WordFacts(data, ends, lines)
    for lo in range(0, len(lines.start), BLOCK_LINES):
        hi = min(lo + BLOCK_LINES, len(lines.start))
        yield lo, hi, np.concatenate([_counts(data, lines, lo, hi), facts.table(lo, hi)], 1)


class Chains:
    """Lines of many documents as chains, worked through in step: first lines, second lines…"""

    def __init__(self, doc: np.ndarray) -> None:
        n = len(doc)
        new = np.concatenate(([True], doc[1:] != doc[:-1])) if n else np.zeros(0, bool)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        order = np.argsort(-size, kind="stable")  # longest first: those still going on lead
        self.first, self.size = first[order], size[order]
        self.head = new
        self.tail = np.append(new[1:], True) if n else new

    def places(self, forward: bool) -> Iterator[np.ndarray]:
        """Places of the k-th line (from the front, or from the back) of each chain with one."""
        longest = int(self.size[0]) if len(self.size) else 0
        going = np.searchsorted(-self.size, -np.arange(longest), "left")
        for k, live in enumerate(going.tolist()):
            yield self.first[:live] + (k if forward else self.size[:live] - 1 - k)

    def messages(self, own: np.ndarray, move: np.ndarray, forward: bool) -> np.ndarray:
        """Log-odds for good that reach each line from one side, its own score left out."""
        out = np.zeros(len(own))
        came = move if forward else move.T
        before = None
        for at in self.places(forward):
            if before is not None:
                odds = out[before[: len(at)]] + own[before[: len(at)]]
                out[at] = (
                    np.logaddexp(odds + came[1, 1], came[0, 1])
                    - np.logaddexp(odds + came[1, 0], came[0, 0])
                )
            before = at
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _beside(x: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
    """Values of the line before and of the line behind; 0 where there is none."""
    before, behind = np.zeros_like(x), np.zeros_like(x)
    before[1:] = np.where(chains.head[1:], 0, x[:-1])
    behind[:-1] = np.where(chains.tail[:-1], 0, x[1:])
    return before, behind


@dataclass
class Field:
    """Weights of the own, previous and next line's features, moves between states, scale."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # (features, 3)
    bias: np.ndarray  # always, at the first line, at the last line
    move: np.ndarray  # (from, to); 0 bad, 1 good
    scale: tuple[float, float] = (0.0, 1.0)
    base: float = 1.0

    def own(self, parts: np.ndarray, chains: Chains) -> np.ndarray:
        before, _ = _beside(parts[:, 1], chains)
        _, behind = _beside(parts[:, 2], chains)
        edge = self.bias[1] * chains.head + self.bias[2] * chains.tail
        return parts[:, 0] + before + behind + self.bias[0] + edge

    def line_odds(self, data: np.ndarray, ends: np.ndarray, lines: Lines) -> np.ndarray:
        """Log-odds of each line for being good, given its whole document."""
        parts = np.zeros((len(lines.start), 3))
        for lo, hi, x in feature_blocks(data, ends, lines):
            parts[lo:hi] = ((x - self.mean) / self.spread) @ self.weights
        chains = Chains(lines.doc)
        own = self.own(parts, chains)
        return (
            own + chains.messages(own, self.move, True) + chains.messages(own, self.move, False)
        )

    def score(self, texts: pa.Array) -> np.ndarray:
        data, ends = utf8(texts)
        lines = visible_lines(data, ends)
        if not len(lines.start) or not self.weights.size:
            return np.full(len(texts), self.base)
        good = _weighted(_sigmoid(self.line_odds(data, ends, lines)), lines, len(texts))
        return np.where(np.isnan(good), self.base, _sigmoid(_scaled(good, self.scale)))


def _weighted(good: np.ndarray, lines: Lines, texts: int) -> np.ndarray:
    """Mean over the lines of each text by their visible bytes; NaN without lines."""
    total = np.bincount(lines.doc, lines.weight, minlength=texts)
    share = np.bincount(lines.doc, lines.weight * good, minlength=texts)
    return np.where(total > 0, share / np.maximum(total, 1), np.nan)


def _scaled(good: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    good = np.clip(good, 1e-3, 1 - 1e-3)
    return scale[0] + scale[1] * np.log(good / (1 - good))


class Trainer:
    """Maximum conditional likelihood by gradient steps of adapted size (Adam), with a ridge."""

    def __init__(self, x: np.ndarray, lines: Lines, ridge: float = 2e-4) -> None:
        mean, spread = x.mean(0), x.std(0) + 0.02
        self.x = ((x - mean) / spread).astype(np.float32)
        self.lines, self.chains, self.ridge = lines, Chains(lines.doc), ridge
        self.field = Field(
            mean, spread, np.zeros((x.shape[1], 3), np.float32), np.zeros(3), np.zeros((2, 2))
        )

    def odds(self) -> np.ndarray:
        own = self.field.own(self.x @ self.field.weights, self.chains)
        self._own = own
        self._front = self.chains.messages(own, self.field.move, True)
        self._back = self.chains.messages(own, self.field.move, False)
        return own + self._front + self._back

    def _pairs(self) -> np.ndarray:
        """Probability of each pair of states (bad bad, bad good, …) of a line and the next."""
        at = np.flatnonzero(~self.chains.tail)
        left, right = self._own[at] + self._front[at], self._own[at + 1] + self._back[at + 1]
        m = self.field.move
        logs = np.stack(
            [np.full(len(at), m[0, 0]), m[0, 1] + right, m[1, 0] + left, m[1, 1] + left + right], 1
        )
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p / p.sum(1, keepdims=True)

    def fit(self, y: np.ndarray, rounds: int, rate: float = 0.05) -> None:
        f, n = self.field, max(len(y), 1)
        values = [f.weights, f.bias, f.move]
        slow = [np.zeros_like(v, float) for v in values]
        wide = [np.zeros_like(v, float) for v in values]
        at = np.flatnonzero(~self.chains.tail)
        seen = np.bincount(2 * y[at] + y[at + 1], minlength=4).reshape(2, 2)
        for k in range(1, rounds + 1):
            left = y - _sigmoid(self.odds())
            # The line before gives its features to this one: its row meets this one's residue.
            before, behind = _beside(left, self.chains)
            own = self.x.T @ np.stack([left, behind, before], 1).astype(np.float32)
            edges = [left.sum(), left[self.chains.head].sum(), left[self.chains.tail].sum()]
            moves = seen - self._pairs().sum(0).reshape(2, 2)
            for v, g, s, w in zip(values, (own, np.array(edges), moves), slow, wide):
                g = g / n - self.ridge * v
                s += 0.1 * (g - s)
                w += 0.01 * (g * g - w)
                v += rate * (s / (1 - 0.9**k)) / (np.sqrt(w / (1 - 0.99**k)) + 1e-6)


def fit_field(texts: list[str], labels: list[int], rounds: int = 3, steps_each: int = 80) -> Field:
    """A field from documents with labels (1 good, 0 bad); see the module for the line labels."""
    y = np.array(labels)
    base = float(y.mean()) if len(y) else 1.0
    data, ends = utf8(pa.array(texts, pa.string()))
    lines = visible_lines(data, ends)
    if len(set(labels)) < 2 or len(set(y[np.unique(lines.doc)])) < 2:
        none = np.zeros((0, 3))
        return Field(np.zeros(0), np.ones(0), none, np.zeros(3), np.zeros((2, 2)), base=base)
    trainer = Trainer(np.concatenate([x for *_, x in feature_blocks(data, ends, lines)]), lines)
    of_doc = y[lines.doc]
    line_y = of_doc.copy()
    for _ in range(rounds):
        trainer.fit(line_y, steps_each)
        odds = trainer.odds()
        worst = np.full(len(y), np.inf)
        np.minimum.at(worst, lines.doc, odds)
        line_y = np.where(of_doc == 1, 1, ((odds >= 0) & (odds > worst[lines.doc])).astype(int))
    field = trainer.field
    field.base = base
    good = _weighted(_sigmoid(trainer.odds()), lines, len(texts))
    field.scale = _fitted_scale(good[~np.isnan(good)], y[~np.isnan(good)])
    return field


def _fitted_scale(good: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the log-odds of the mean, by Newton's method."""
    z = _scaled(good, (0.0, 1.0))
    x = np.stack([np.ones_like(z), z], 1)
    coef, ridge = np.array([0.0, 1.0]), np.diag([1e-3, 1e-3])
    for _ in range(40):
        p = _sigmoid(x @ coef)
        hess = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge @ coef)
        coef += np.clip(step, -1, 1)
        coef[1] = max(coef[1], 0.05)
        if np.abs(step).max() < 1e-6:
            break
    return float(coef[0]), float(coef[1])


def labelled(labels: DataFrame) -> DataFrame:
    """One row (doc_id, y) for each document that may be learnt from."""
    usable = labels.filter(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    )
    return usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))


def learn(
    docs: DataFrame, labels: DataFrame, per_label: int = 1500, sample_bytes: int = 4 << 20
) -> Field:
    """A field from a bounded sample of the labelled documents; see the module."""
    ids = labelled(labels)
    totals = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = [ids.filter(F.col("y") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    sample = stored(  # the broadcast side has at most 2 * per_label ids
        texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .groupBy("doc_id", "y").agg(F.min("text").alias("text")),
        "quality-sample",
    )
    # A line costs as much as its counts; ids and sizes of at most 2 * per_label rows.
    cost = F.octet_length("text") + 64 * F.regexp_count("text", F.lit("\n"))
    sizes = sample.select("doc_id", "y", cost.alias("cost")).orderBy(*order).collect()
    left, taken = {0: sample_bytes, 1: sample_bytes}, []
    for r in sizes:
        left[r["y"]] -= r["cost"]
        if left[r["y"]] >= 0:
            taken.append(r["doc_id"])
        else:
            left[r["y"]] += r["cost"]
    rows = sample.filter(F.col("doc_id").isin(taken)).orderBy("doc_id").collect() if taken else []
    field = fit_field([r["text"] for r in rows], [r["y"] for r in rows])
    known = totals.get(0, 0) + totals.get(1, 0)
    field.base = totals.get(1, 0) / known if known else 1.0
    if rows and len(totals) == 2:  # the sample holds more bad documents than the labels do
        bad = sum(r["y"] == 0 for r in rows)
        drawn = np.log(max(len(rows) - bad, 1) / max(bad, 1))
        field.scale = (field.scale[0] + np.log(totals[1] / totals[0]) - drawn, field.scale[1])
    return field


def quality_score(field: Field) -> Column:
    """The score of the column ``text``, between 0 and 1."""

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [field.score(texts.slice(lo, hi - lo)) for lo, hi in steps(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
        give_back()

    return score(F.col("text"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row a document: doc_id, held_out, score (six places), predicted.

    Sums over a batch differ in their last digits with the texts beside a text; the rounded
    score is the same for equal texts and for every run.
    """
    score = F.round(quality_score(learn(docs, labels)), 6)
    scored = docs.select("doc_id", "text", held_out().alias("held_out")).select(
        "doc_id", "held_out", score.alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
