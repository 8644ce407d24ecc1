"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits and signs that stand for letters), the lexicon is
matched with an Aho-Corasick automaton, exception phrases take their matches back, and the
sum of weights is normalised by the length of the text. Lexicon and calibration are learnt
from labelled rows.

Defined results: a null or empty text has the score of a text without matches. Null or
unknown labels teach nothing; a document with several labels is toxic if one says so.
Without labels the seed words alone decide. Repeated rows are scored alike, one by one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ratefuse.llm.common import give_back, held_out, steps, strings
from ratefuse.operators.stored import stored

# Letters of other scripts that look like Latin ones.
LOOKALIKE = str.maketrans(
    "асеоріјѕхукмтвнһԁɡαοειρνκτυ",
    "aceopijsxykmtbhhdgaoeipvktu",
)
# Digits and signs read as letters; i, l and 1 are one letter.
DIGITS = str.maketrans("01345789", "oieastbg")
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
# Words that are known before any label is seen, and harmless phrases.
SEED_WORDS = (
    "idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "scum", "loser",
)
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser clause", "idiot proof")

_FAR = re.compile(r"[^\x00-\u024f]|\u00ad")
_GONE = re.compile(r"[\u00ad\u200b-\u200f\u2060\ufeff]")
_DIGIT = re.compile("[0-9]")
_SIGN = re.compile(r"(?<=\w)[@$!|](?=\w)")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    text = text.lower()
    if _FAR.search(text):
        text = _GONE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(LOOKALIKE)
    text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    if _DIGIT.search(text):
        text = text.translate(DIGITS)
    return text.replace("l", "i")


@dataclass
class Lexicon:
    """Folded terms with weights; ``whole`` terms are words, the others begin words."""

    whole: dict[str, float]
    stems: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    coef: tuple[float, ...] = (-4.0, 2.0, 2.0)
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            found = ahocorasick.Automaton()
            terms: dict[str, list] = {}
            for kind, table in ((1, self.whole), (0, self.stems)):
                for term, weight in table.items():
                    terms.setdefault(term, []).append((kind, weight))
            for phrase in self.exceptions:
                terms.setdefault(fold(phrase), []).append((2, 0.0))
            for term, uses in terms.items():
                found.add_word(term, (len(term), tuple(uses)))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def features(self, text: str) -> tuple[float, float]:
        """Sum of the weights, and that sum by length; one weight a word, the largest."""
        text = fold(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        n = len(text)
        for end, (size, uses) in self.automaton().iter(text):
            start = end - size + 1
            if start and text[start - 1].isalnum():
                continue
            closed = end + 1 == n or not text[end + 1].isalnum()
            for kind, weight in uses:
                if kind == 2 and closed:
                    spared.append((start, end))
                elif (kind == 0 or closed) and weight > best.get(start, 0.0):
                    best[start] = weight
        total = sum(
            w for at, w in best.items() if not any(lo <= at <= hi for lo, hi in spared)
        )
        return np.log1p(total), np.log1p(100.0 * total / (20.0 + n / 6.0))

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 2)
        return _sigmoid(self.coef[0] + x @ np.array(self.coef[1:]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def labelled(labels: DataFrame) -> DataFrame:
    """One row (doc_id, y) for each document that may be learnt from."""
    usable = labels.filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    )
    return usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has words, with a digest of the set of its folded words.

    As a column the digest would be made twice, in the filter and behind it, by two workers a task.
    """
    for batch in batches:
        sets = [sorted(set(_WORD.findall(fold(t)))) for t in strings(batch.column("text"))]
        marks = [hashlib.sha256(" ".join(s).encode()).hexdigest() if s else None for s in sets]
        marked = batch.append_column("mark", pa.array(marks, pa.string()))
        yield marked.filter(marked.column("mark").is_valid())
    give_back()


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of a batch hold each word and each beginning of one."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, y in zip(strings(batch.column("text")), batch.column("y").to_pylist()):
            words = set(_WORD.findall(fold(text)))
            terms = {f"w{w}" for w in words if 3 <= len(w) <= 24}
            terms |= {f"s{w[:k]}" for w in words for k in range(4, 8) if len(w) > k}
            counts[y].update(terms)
        terms = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(terms, pa.string()),
                "pos": pa.array([counts[1][t] for t in terms], pa.int64()),
                "neg": pa.array([counts[0][t] for t in terms], pa.int64()),
            }
        )


def learn(
    docs: DataFrame, labels: DataFrame, per_label: int = 3000, terms: int = 2000
) -> Lexicon:
    """A lexicon from at most ``per_label`` labelled rows of either kind, by a hash of the id.

    Texts of one label with the same set of folded words count once for the terms. At most
    ``terms`` terms are kept, those with the strongest evidence first.
    """
    ids = labelled(labels)
    totals = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = [ids.filter(F.col("y") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    sample = stored(  # the broadcast side has at most 2 * per_label ids
        texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id"), "toxicity-sample"
    )
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    whole = {fold(w): 3.0 for w in SEED_WORDS}
    stems: dict[str, float] = {}
    if not pos or not neg:
        return Lexicon(whole, stems)
    folded = stored(
        sample.select("y", "text").mapInArrow(_marked, "y int, text string, mark string")
        .dropDuplicates(["y", "mark"]).select("text", "y"),
        "toxicity-folded",
    )
    once = {r["y"]: r["count"] for r in folded.groupBy("y").count().collect()}
    pos, neg = once.get(1, 0), once.get(0, 0)
    counts = (
        folded.mapInArrow(_term_counts, "term string, pos long, neg long")
        .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    weight = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    kept = (
        counts.withColumn("weight", weight)
        .filter((F.col("pos") >= max(5, 0.004 * pos)) & (F.col("weight") >= 3.0))
        .orderBy(F.desc(F.col("weight") * F.sqrt("pos")), "term").limit(terms).collect()
    )
    for r in sorted(kept, key=lambda r: (-len(r["term"]), r["term"])):
        (whole if r["term"][0] == "w" else stems)[r["term"][1:]] = float(r["weight"])
    lexicon = Lexicon(whole, stems)
    rows = sample.select("y", _features(lexicon)("text").alias("f")).collect()
    x = np.array([[1.0, *r["f"]] for r in rows])
    y = np.array([r["y"] for r in rows], float)
    share = {k: totals.get(k, n[k]) / n[k] for k in n}
    lexicon.coef = _fitted(x, y, np.where(y == 1, share.get(1, 1), share.get(0, 1)))
    return lexicon


def _features(lexicon: Lexicon):
    @arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        found = [list(lexicon.features(t)) for t in strings(texts)]
        return pa.array(found, pa.list_(pa.float64()))

    return features


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's method; slopes are not negative."""
    coef = np.zeros(x.shape[1])
    weight = weight / weight.mean()
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(40):
        p = _sigmoid(x @ coef)
        grad = x.T @ (weight * (y - p)) - ridge @ coef
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, grad)
        coef += np.clip(step, -2, 2)
        coef[1:] = np.maximum(coef[1:], 0.0)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(c) for c in coef)


def toxicity_score(lexicon: Lexicon) -> Column:
    """The score of the column ``text``, between 0 and 1."""

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [lexicon.score(strings(texts.slice(lo, hi - lo))) for lo, hi in steps(texts)]
            yield pa.array([x for part in parts for x in part], pa.float64())
        give_back()

    return score(F.col("text"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", "text", held_out().alias("held_out")).select(
        "doc_id", "held_out", toxicity_score(learn(docs, labels)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return docs.filter(toxicity_score(learn(docs, labels)) < threshold)
