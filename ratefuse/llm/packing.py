"""Packing of tokenised documents into sequences by the sum-of-squares rule.

A document of more tokens than a sequence gives whole sequences first. What remains goes to
the fill level that makes the sum of squared counts of partially filled sequences smallest;
the counts by level are kept in an array. At the end of a partition, sequences that are full
or filled to a power of two stay as they are. Of the others, the emptiest are cut up to fill the
fullest, and what is left is cut at powers of two, so nothing is padded.

Each partition packs by itself, and its number is part of the sequence ids.

Defined results: a null or empty text has the end token only. Repeated rows are packed each.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratefuse.llm.common import give_back

LENGTH = 1024
END = 0


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, turned round.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids as little-endian bytes, by the merges of a byte-level vocabulary file.

    The file's order of ids is its order of merges, so tiktoken, which is several times faster
    here, gives the ids that tokenizers gives. Texts with a special token go to tokenizers.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf8") as file:
            parts = json.load(file)
        self.path, self.tokenizer, letters = path, None, byte_letters()
        self.special = tuple(t["content"] for t in parts["added_tokens"])
        ranks = {
            bytes(letters[c] for c in token): k
            for token, k in parts["model"]["vocab"].items() if token not in self.special
        }
        self.fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                self.tokenizer = Tokenizer.from_file(self.path)
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


class Packer:
    """Open sequences by fill level, and the pieces in them."""

    def __init__(self, length: int = LENGTH) -> None:
        self.length = length
        self.count = np.zeros(length + 1, np.int64)  # of open sequences, by level
        self.open: list[list[list]] = [[] for _ in range(length + 1)]
        self.moved = 0

    def level_for(self, size: int) -> int:
        """Level 0 is a new sequence. The smallest growth wins; of ties the fullest level."""
        top = self.length - size
        grown = 2 * self.count[size : self.length + 1] + 1
        grown[top] = 0  # a full sequence is closed
        left = np.where(self.count[: top + 1] > 0, 1 - 2 * self.count[: top + 1], 1 << 60)
        left[0] = 0
        change = grown + left
        return top - int(change[::-1].argmin())

    def add(self, piece: tuple, size: int) -> list | None:
        """The pieces of the sequence that this one fills, if it does."""
        level = self.level_for(size)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.length:
            return window
        self.open[level + size].append(window)
        self.count[level + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """Sequences filled to a power of two, then the others, full but for the last ones.

        As many of the fullest as their tokens fill stay as they are; the emptiest are cut up to
        fill them, and what is left then is laid out at powers of two. ``moved`` counts tokens
        that lie elsewhere than the rule had placed them.
        """
        loose = []
        for level in range(self.length - 1, 0, -1):
            if level & (level - 1) == 0:
                yield from self.open[level]
            else:
                loose += [(level, window) for window in self.open[level]]
        total = sum(level for level, _ in loose)
        kept = loose[: total // self.length]
        rooms = [(self.length - level, window) for level, window in kept]
        bits = range(self.length.bit_length(), -1, -1)
        rooms += [(1 << k, []) for k in bits if total % self.length >> k & 1]
        pieces = [piece for _, window in loose[len(kept) :] for piece in window]
        self.moved = sum(len(ids) // 4 for _, _, ids, _ in pieces)
        pieces.reverse()
        for room, window in rooms:
            while room:
                doc_id, start, ids, tokens = pieces.pop()
                part = ids[: 4 * room]
                window.append((doc_id, start, part, tokens))
                room -= len(part) // 4
                if len(part) < len(ids):
                    pieces.append((doc_id, start + len(part) // 4, ids[len(part) :], tokens))
            yield window


OUT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long"
)


def _packing(path: str, length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()
        encoder, packer = Encoder(path), Packer(length)
        sequence = TaskContext.get().partitionId() << 36
        end = np.array([END], "<u4").tobytes()
        names = [c.split()[0] for c in OUT.split(", ")]
        rows: list[tuple] = []

        def close(window: list) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, ids, tokens in window:
                size = len(ids) // 4
                rows.append((doc_id, start, size, zlib.crc32(ids), tokens, sequence, offset))
                offset += size
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            out = [pa.array(c, pa.int64()) for c in columns]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, tokens = doc_id.as_py(), encoder.encode(text.as_py() or "") + end
                n, step = len(tokens) // 4, 4 * length
                for at in range(0, len(tokens), step):
                    piece = (doc_id, at // 4, tokens[at : at + step], n)
                    size = len(piece[2]) // 4
                    full = [piece] if size == length else packer.add(piece, size)
                    if full:
                        close(full)
                if len(rows) > 20_000:
                    yield flush()
        for window in packer.rest():
            close(window)
        yield flush()
        del encoder, packer
        give_back()

    return work


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    own = docs.select(F.col("doc_id").cast("long"), "text")
    return own.mapInArrow(_packing(path or tokenizer_path(), length), OUT)
