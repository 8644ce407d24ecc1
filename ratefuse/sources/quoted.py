"""CSV files whose quoted values hold newlines, read by many tasks.

Where a line lies in quotes depends on everything before it in the file.  So every file block
is read twice.  First it tells in which state it ends, for both cases: that it begins outside or
inside quotes.  One such row per block goes to the driver, which follows the state over the
blocks of each file.  Then every block knows how it begins and gives its rows.  Only rows that
reach over the end of a block, one per block at most, are put together by a shuffle.

A quote opens only at the start of a value.  Blank lines outside quotes are no rows, and the
first row of a file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratefuse.operators.keyed import prefix_sums
from ratefuse.operators.stored import stored

Block = tuple[str, int]


def scan(line: str, inside: bool) -> tuple[bool, int]:
    """Whether the end of a line is in quotes, and its separators outside quotes."""
    if '"' not in line:
        return inside, 0 if inside else line.count(",")
    at = found = 0
    while True:
        if inside:
            end = line.find('"', at)
            if end < 0:
                return True, found
            at = end + 2
            if line[end + 1 : at] == '"':  # two quotes are one, inside
                continue
            inside, at = False, end + 1
        elif line[at : at + 1] == '"':
            inside, at = True, at + 1
            continue
        end = line.find(",", at)
        if end < 0:
            return False, found
        at, found = end + 1, found + 1


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[str]]]:
    """Lines in file order, some at a time, with the block (file, start) they lie in."""
    for batch in batches:
        lines, files, starts = (c.to_pylist() for c in batch.columns)
        lo = 0
        for k in range(1, len(lines) + 1):
            if k == len(lines) or (files[k], starts[k]) != (files[lo], starts[lo]):
                yield (files[lo], starts[lo]), lines[lo:k]
                lo = k


_ENDS = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()),
     ("closes", pa.bool_())]
)


def _end_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: its end state if it begins outside, and inside quotes; ``closes``: a row that
    was open before ends in it."""
    states: dict[Block, list[bool]] = {}
    for block, lines in _by_block(batches):
        s = states.setdefault(block, [False, True, False])
        for line in lines:
            s[0], s[1] = scan(line, s[0])[0], scan(line, s[1])[0]
            s[2] = s[2] or not s[1]
    columns = list(zip(*[(*block, *s) for block, s in states.items()])) or [()] * len(_ENDS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ENDS)], schema=_ENDS
    )


def open_rows(ends: list[tuple[str, int, bool, bool, bool]]) -> dict[Block, int | None]:
    """For each block the start of the block that began the row still open where it begins."""
    out, last, home = {}, None, None
    for file, start, outside, inside, closes in sorted(ends):
        home = home if file == last else None
        out[file, start] = home
        if home is None:
            home = start if outside else None
        elif closes:
            home = start if inside else None
        last = file
    return out


_PIECES = pa.schema(
    [("file", pa.string()), ("home", pa.int64()), ("start", pa.int64()), ("place", pa.int64()),
     ("header", pa.bool_()), ("line", pa.string())]
)


def _pieces(opened: Broadcast, width: int | None):
    """Rows of a block, numbered (``place``) from 1 without those longer than ``width``; rows
    that reach beyond the block come in pieces, without a number.  The header is left out, or
    marked if it comes in pieces."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, inside, home, first, place, values = None, False, None, False, 0, 1
        row: list[str] = []
        out: list[tuple] = []

        def close(ended: bool) -> None:
            nonlocal first, home, place, values
            text = "\n".join(row).removesuffix("\r" if ended else "")
            begun = home is None
            if not (begun and ended):
                out.append((here[0], here[1] if begun else home, here[1], None, first and begun, text))
            elif not first and (width is None or values <= width):
                place += 1
                out.append((*here, here[1], place, False, text))
            first, home, values = first and not begun, None, 1
            row.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(_PIECES)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES
            )

        for block, lines in _by_block(batches):
            if block != here:
                if row:
                    close(False)
                here, home, place = block, opened.value[block], 0
                inside, first = home is not None, block[1] == 0
            for line in lines:
                if not inside and not line.strip("\r"):
                    continue
                row.append(line)
                inside, found = scan(line, inside)
                values += found
                if not inside:
                    close(True)
            yield flush()
        if row:
            close(False)
        yield flush()

    return work


def read_quoted(
    spark: SparkSession, path: str | list[str], columns: list[str], strict: bool = False
) -> DataFrame:
    """All-string rows with their number in file order (``row_id``, from 1).

    Short rows are padded with nulls; rows with too many values are left out and get no number,
    or fail the job if ``strict``.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )
    ends = lines.mapInArrow(_end_states, "file string, start long, outside boolean, inside boolean, closes boolean")
    opened = spark.sparkContext.broadcast(open_rows([tuple(r) for r in ends.collect()]))
    width = None if strict else len(columns)
    pieces = stored(
        lines.mapInArrow(
            _pieces(opened, width),
            "file string, home long, start long, place long, header boolean, line string",
        ),
        "csv-rows",
    )
    whole = pieces.filter("place IS NOT NULL").select("file", "home", "place", "line")
    in_order = F.sort_array(F.collect_list(F.struct("start", "line")))
    reaching = (
        pieces.filter("place IS NULL").groupBy("file", "home")
        .agg(F.max("header").alias("header"),
             F.array_join(F.transform(in_order, lambda p: p["line"]), "\n").alias("line"))
        .filter("NOT header")
    )
    if not strict:
        reaching = reaching.filter(value_count(F.col("line")) <= len(columns))
    # A row that reaches beyond its block is the last one that begins in it.
    last = F.lit(2**62).alias("place")
    rows = whole.unionByName(reaching.select("file", "home", last, "line"))
    blocks = rows.groupBy("file", "home").agg(F.count(F.lit(1)).alias("size"))
    offsets = prefix_sums(blocks, "size", ["file", "home"], "offset")
    ddl = ", ".join(f"`{c}` string" for c in columns)
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE", "escape": '"'}
    value = F.from_csv("line", ddl, mode).alias("row")
    placed = rows.join(offsets, ["file", "home"])
    row_id = F.col("offset") + F.least("place", "size")
    return placed.select(row_id.alias("row_id"), value).select("row_id", "row.*")


def value_count(line: Column) -> Column:
    """Number of values in a CSV line; separators in quoted values do not count."""
    quoted = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
    return F.regexp_count(F.regexp_replace(line, quoted, "$1"), F.lit(",")) + 1
