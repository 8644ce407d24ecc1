"""Secrets in texts: patterns, and a character network over every candidate in its context.

The patterns give the base findings. Candidates are these and every long run of token
characters with a letter. A one-dimensional convolutional network in numpy reads the candidate
with the characters around it, a long one through windows over all of it, of which the largest
score counts. It is trained on a bounded sample of the corpus and on made-up findings of known
formats. Findings of the patterns are secrets; candidates that read like words or names are
not, nor are words of the corpus run together. A candidate that looks random though no pattern
knows it teaches nothing. Scores are calibrated on a part kept apart, and the threshold is the
smallest one there that is seldom wrong, within the recall that has to be kept. Candidates
above it are findings of kind ``model``, unless they touch a base finding.

Defined results: a null text is empty and has no finding. Offsets are code points, the end
exclusive. Repeated rows give the same findings each.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ratefuse.llm.common import Shared, give_back, steps, utf8

KINDS = ("assign", "access", "hex", "model")
# The patterns of the base findings.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without a match of this has no base finding and no candidate.
ANY = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_LETTER = re.compile("[A-Za-z]")
LEAST = 16
RESULT = "struct<base: array<string>, spans: array<string>>"

BEFORE, LENGTH = 24, 72
#: Characters from one window of a long candidate to the next.
STRIDE = 16
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_.=-:\"' \n"
_CODE = {c: k + 2 for k, c in enumerate(ALPHABET)}
SYMBOLS = len(ALPHABET) + 2  # 0: outside the text, 1: any other character
WIDTH, FILTERS = 5, 24
#: Bytes of text that one step looks through for candidates; it takes dozens of times as much memory.
LOOK_BYTES = 128 << 10


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost findings of each kind by start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def more_candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Token runs with a letter that touch no base finding."""
    out, k = [], 0
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while k < len(base) and base[k][1] <= start:
            k += 1
        touched = any(lo < end and start < hi for lo, hi, _ in base[k : k + 4])
        if not touched and _LETTER.search(m[0]):
            out.append((start, end, "model"))
    return out


_RUN = re.compile(r"[A-Za-z0-9]{8,}")
_SWITCH = re.compile(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_WORD = re.compile(r"[A-Za-z]{3,}")


def looks_random(value: str) -> bool:
    """Whether a run of the value goes back and forth between kinds of characters, or has
    hardly any vowels or hardly any consonants, as names and words do not."""
    for m in _RUN.finditer(value):
        run = m[0]
        letters = [c for c in run.lower() if c.isalpha()]
        vowels = sum(c in "aeiouy" for c in letters) / max(len(letters), 1)
        if len(_SWITCH.findall(run)) * 5 >= len(run) or (len(letters) >= 16 and not 0.2 <= vowels <= 0.65):
            return True
    return False


def run_together(text: str) -> list[tuple[str, int, int]]:
    """Some words of a text, joined until they are as long as a candidate, in their context."""
    words = _WORD.findall(text[: 1 << 14])
    out = []
    for at in range(0, min(len(words), 400), 40):
        value = ""
        for word in words[at : at + 8]:
            value += word
            if len(value) >= LEAST + at % 13:
                if at % 120 == 40:  # as headings and shouted lines have them
                    value = value.upper()
                lead = " ".join(words[max(at - 3, 0) : at]) + " "
                tail = " " + " ".join(words[at + 8 : at + 11])
                out.append((lead + value + tail, len(lead), len(lead) + len(value)))
                break
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the candidate's first characters and their context."""
    codes = np.zeros(LENGTH, np.uint8)
    lo = start - BEFORE
    for k, c in enumerate(text[max(lo, 0) : lo + LENGTH], max(-lo, 0)):
        codes[k] = _CODE.get(c, 1)
    return codes


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Windows over the whole candidate; the last one of a long candidate has its context behind."""
    last = max(end - (LENGTH - 2 * BEFORE), start) if end - start > LENGTH - BEFORE else start
    return [window(text, at, end) for at in (*range(start, last, STRIDE), last)]


@dataclass
class Network:
    """Convolution over one-hot characters, rectified, maximum over places, one output."""

    kernel: np.ndarray  # WIDTH * SYMBOLS x FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    scale: float = 1.0
    threshold: float = 2.0  # above every score: nothing is added
    recall: float = 0.0  # on the part kept apart, at the threshold
    precision: float = 0.0

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = LENGTH - WIDTH + 1
        act = np.broadcast_to(self.bias, (len(codes), places, FILTERS)).copy()
        for k in range(WIDTH):
            act += self.kernel[codes[:, k : k + places].astype(int) + k * SYMBOLS]
        at = act.argmax(axis=1)
        return np.maximum(np.take_along_axis(act, at[:, None, :], 1)[:, 0, :], 0.0), at

    def logit(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        parts = [self.pooled(codes[k : k + 256])[0] for k in range(0, len(codes), 256)]
        return np.concatenate(parts) @ self.out[:-1] + self.out[-1]

    def score(self, codes: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * self.logit(codes) + self.shift, -30, 30)))


def train(
    codes: np.ndarray, y: np.ndarray, recall: float = 0.98, wrong: float = 0.002, seed: int = 5
) -> Network:
    """Fit on four fifths of the findings, calibrate and choose the threshold on the rest: the
    smallest that lets at most a share ``wrong`` of the harmless pass, if it keeps ``recall``."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.15, (WIDTH * SYMBOLS, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.3, FILTERS + 1),
    )
    apart = rng.random(len(y)) < 0.2
    x, t = codes[~apart], y[~apart].astype(float)
    if not len(t) or t.min() == t.max() or not apart.any():
        return net
    params = [net.kernel, net.bias, net.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean()))
    step = 0
    for _ in range(12):
        order = rng.permutation(len(t))
        for k in range(0, len(order), 64):
            rows = order[k : k + 64]
            pooled, at = net.pooled(x[rows])
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.out[:-1] + net.out[-1], -30, 30)))
            err = weight[rows] * (p - t[rows]) / len(rows)
            back = err[:, None] * net.out[:-1] * (pooled > 0)
            grad = [np.zeros_like(net.kernel), back.sum(0), np.append(pooled.T @ err, err.sum())]
            for w in range(WIDTH):
                cell = np.take_along_axis(x[rows], at + w, 1).astype(int) + w * SYMBOLS
                np.add.at(grad[0], (cell, np.arange(FILTERS)), back)
            step += 1
            for value, g, (m, v) in zip(params, grad, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                value -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    z, t = net.logit(codes[apart]), y[apart].astype(float)
    if t.min() == t.max():
        return net
    for _ in range(50):  # Platt's calibration
        p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -30, 30)))
        net.scale = max(0.05, net.scale - 0.05 * float(np.mean((p - t) * z)))
        net.shift -= 0.5 * float(np.mean(p - t))
    score = net.score(codes[apart])
    kept, harmless = np.sort(score[t == 1]), np.sort(score[t == 0])
    safe = np.nextafter(harmless[-1 - int(wrong * len(harmless))], 2.0)
    net.threshold = float(min(max(safe, 0.5), kept[int((1 - recall) * len(kept))]))
    passed = score >= net.threshold
    net.recall = float(passed[t == 1].mean())
    net.precision = float(t[passed].mean()) if passed.any() else 0.0
    return net


def made_findings(n: int = 1000, seed: int = 11) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Findings of known formats and harmless look-alikes, each within a few words."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, size: "".join(np.array(list(chars))[rng.integers(0, len(chars), size)])
    low, alnum, hexa = string.ascii_lowercase, string.ascii_letters + string.digits, "0123456789abcdef"
    words = lambda: " ".join(pick(low, rng.integers(2, 9)) for _ in range(4))
    cased = lambda: " ".join((part() + part()).title() for _ in range(3))
    part = lambda: "".join(pick("bcdfghklmnprstvw", 1) + pick("aeiou", 1) for _ in range(3))
    path = lambda: "/".join(part() for _ in range(rng.integers(2, 6)))
    letters = string.ascii_letters
    secret = (
        lambda: "ghp_" + pick(alnum, 36), lambda: "sk-" + pick(alnum, 40), lambda: pick(alnum + "+/", 40),
        lambda: "eyJ" + pick(alnum, 34), lambda: "xoxb-" + pick(string.digits, 12) + "-" + pick(alnum, 24),
        lambda: "AIza" + pick(alnum + "-_", 35), lambda: pick(hexa, 32), lambda: pick(alnum, 32),
        lambda: pick(letters, 40), lambda: pick(letters, 24), lambda: pick(low, 40),
    )
    plain = (
        lambda: part() + "-" + part() + "-" + pick("12", 1), lambda: part() + part() + part() + pick("0123456789", 1),
        lambda: "-".join(part() for _ in range(3)) + "-2024", lambda: "item_" + part() + part() + "_" + pick("0123456789", 3),
        lambda: "/".join(part() for _ in range(3)) + "/v2", lambda: (part() + part() + part()).upper() + "-" + pick("0123456789", 2),
        lambda: "2024-05-" + pick("0123456789", 2) + "T10-20-00Z", lambda: pick("0123456789", 16) + pick("abc", 1),
        lambda: part() + part() + part(), lambda: "".join(part().title() for _ in range(4)),
        lambda: path() + "/" + path(), lambda: "/".join(part() + "-" + part() for _ in range(4)),
        lambda: part() + "=" * 10 + pick("0123456789", 2), lambda: cased().replace(" ", "") + pick("0123456789", 2),
    )
    out, y = [], []
    for k in range(n):
        for label, forms in ((1, secret), (0, plain)):
            value, lead = forms[k % len(forms)](), words() + rng.choice([" ", " = ", ': "', ".\n"])
            if k % 8 == 7:  # as a later window of a long candidate shows it
                lead += path() + rng.choice(["/", "/key=", "_"])
            out.append((lead + value + rng.choice([" ", '" ', "\n"]) + words(), len(lead), len(lead) + len(value)))
            y.append(label)
    return out, y


def interesting(texts: pa.Array) -> np.ndarray:
    """Which texts can hold a base finding or a candidate, by one pass over all bytes."""
    out = pc.match_substring_regex(pc.fill_null(texts, ""), ANY).to_numpy(zero_copy_only=False).copy()
    for lo, hi in steps(texts, LOOK_BYTES):
        data, ends = utf8(texts.slice(lo, hi - lo))
        inside = _TOKEN_BYTE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        start, end = edge[::2], edge[1::2]
        long = end - start >= LEAST
        start, end = start[long], end[long]
        letters = np.concatenate(([0], np.cumsum(_LETTER_BYTE[data])))
        some = letters[end] > letters[start]
        # a run over the end of a text concerns the texts behind it, too
        first = np.searchsorted(ends, start[some], "right") - 1
        last = np.searchsorted(ends, end[some] - 1, "right") - 1
        for a, b in zip(first, last):
            out[lo + a : lo + b + 1] = True
    return out


_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[[ord(c) for c in string.ascii_letters + string.digits + "+/_=-"]] = True
_LETTER_BYTE = np.zeros(256, np.int64)
_LETTER_BYTE[[ord(c) for c in string.ascii_letters]] = 1


def _spread(y: int, seen: np.ndarray) -> tuple[int, bytes, int]:
    codes = seen.tobytes()
    return y, codes, int.from_bytes(hashlib.sha256(codes).digest()[:7], "big")


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0)
        rows: list[tuple[int, bytes, int]] = []
        for i in np.flatnonzero(interesting(texts)):
            text = texts[int(i)].as_py() or ""
            base = base_spans(text)
            found = [(1, window(text, s, e)) for s, e, _ in base]
            found += [
                (0, seen) for s, e, _ in more_candidates(text, base)
                if not looks_random(text[s:e]) for seen in windows(text, s, e)
            ]
            rows += [_spread(y, seen) for y, seen in found]
        for text in texts.to_pylist():
            rows += [_spread(0, window(*made)) for made in run_together(text or "")]
        rows = list(dict.fromkeys(rows))
        yield pa.RecordBatch.from_pydict(
            {
                "y": pa.array([r[0] for r in rows], pa.int32()),
                "codes": pa.array([r[1] for r in rows], pa.binary()),
                "spread": pa.array([r[2] for r in rows], pa.int64()),
            }
        )


def learn(docs: DataFrame, per_label: int = 2500, sample_rows: int = 10_000) -> Network:
    """Train on at most ``per_label`` findings of either label, from about ``sample_rows`` rows.

    Rows are chosen by a hash of the text, so copies do not count twice; the findings are
    distinct windows, chosen by a hash as well.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    spread = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20))
    found = (
        docs.select("text").filter(F.col("text").isNotNull() & spread)
        .mapInArrow(_sampled, "y int, codes binary, spread long")
    )
    rows = [
        r for y in (0, 1)
        for r in found.filter(F.col("y") == y).orderBy("spread").limit(per_label).collect()
    ]
    made, y = made_findings()
    codes = [np.frombuffer(bytes(r["codes"]), np.uint8) for r in rows]
    codes += [window(*m) for m in made]
    return train(np.stack(codes), np.array([r["y"] for r in rows] + y))


def scan(text: str, net: Network) -> tuple[list[str], list[tuple[int, int, str]]]:
    """Base findings as written, and all findings by start, then kind."""
    base = base_spans(text)
    more = more_candidates(text, base)
    if more:
        each = [windows(text, s, e) for s, e, _ in more]
        scores = net.score(np.stack([w for one in each for w in one]))
        begin = np.cumsum([0] + [len(one) for one in each[:-1]])
        good = np.maximum.reduceat(scores, begin) >= net.threshold
        more = [s for s, ok in zip(more, good) if ok]
    every = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))
    return [_written(s) for s in base], every


def _written(span: tuple[int, int, str]) -> str:
    return f"{span[2]}:{span[0]}:{span[1]}"


def find(docs: DataFrame, net: Network) -> DataFrame:
    """All columns and ``found``: base findings and all findings, as kind:start:end."""
    shared = Shared(docs.sparkSession, net)

    @arrow_udf(RESULT)
    def search(texts: pa.Array) -> pa.Array:
        base: list[list[str]] = [[] for _ in range(len(texts))]
        every: list[list[str]] = [[] for _ in range(len(texts))]
        for i in np.flatnonzero(interesting(texts)):
            base[i], spans = scan(texts[int(i)].as_py() or "", shared.value)
            every[i] = [_written(s) for s in spans]
        kind = pa.list_(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(base, kind), pa.array(every, kind)], ["base", "spans"]
        )

    return docs.withColumn("__found", search(F.col("text")))


def report(docs: DataFrame) -> DataFrame:
    """One row a document: counts by kind, digest of the base findings, all findings."""
    found = find(docs.select("doc_id", "text"), learn(docs))
    count = lambda kind: F.size(
        F.filter("__found.base", lambda s: s.startswith(f"{kind}:"))
    ).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.array_join("__found.base", ","), 256).alias("base_sha256"),
        F.array_join("__found.spans", ",").alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every finding replaced by ``mark``; n_chars follows the text."""
    shared = Shared(docs.sparkSession, learn(docs))

    def without(text: str) -> str | None:
        done, parts = 0, []
        for start, end, _ in scan(text, shared.value)[1]:
            if end <= done:
                continue
            if start >= done:
                parts += [text[done:start], mark]
            done = end
        return "".join([*parts, text[done:]]) if parts else None

    @arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = {}
            for i in np.flatnonzero(interesting(texts)):
                text = without(texts[int(i)].as_py() or "")
                if text is not None:
                    out[i] = text
            changed = np.zeros(len(texts), bool)
            changed[list(out)] = True
            yield pc.replace_with_mask(
                texts, pa.array(changed), pa.array(list(out.values()), texts.type)
            )
        give_back()

    kept = docs.columns
    changed = docs.withColumn("text", cleaned(F.col("text")))
    if "n_chars" in kept:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*kept)
