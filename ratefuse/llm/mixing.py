"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Each source gets a target; whole passes over the
source are taken first. For the rest, documents are counted by exact size: each size gives its
share, sizes from the largest down fill most of what is missing, and a bounded-knapsack
dynamic program over the remaining counts hits the budget as exactly as the sizes allow. Which
documents of a size are taken once more is drawn by a seeded hash of id and text.

Defined results: a null text has size 0 and is never taken. The null source is the last one.
Rows of the same id and text share a draw; where only some of them fit the budget, as many of
them as fit are taken once more. A null id is drawn like any other.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratefuse.llm.common import word_count
from ratefuse.operators.stored import stored

#: Words of the budget that are left to the dynamic program.
EXACT_WORDS = 2048
#: Documents of one size that are ranked in one window.
RANKED_ROWS = 1000


def targets(
    sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
    most: float = 2.0,
) -> dict[str | None, float]:
    """Words for each source; what is above ``most`` times a source goes to the others."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, budget = list(order), share * sum(sizes.values())
    while left:
        unit = budget / sum(weight[s] for s in left)
        full = [s for s in left if unit * weight[s] > most * sizes[s]]
        if not full:
            out |= {s: unit * weight[s] for s in left}
            break
        for s in full:
            out[s] = float(most * sizes[s])
            budget -= out[s]
        left = [s for s in left if s not in full]
    return out


def fit(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take, so that the words come nearest the budget.

    Never more words than the budget; sizes are distinct and positive.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    budget = max(0, min(budget, total))
    share = budget / total if total else 0.0
    taken = [min(c, int(c * share)) for c in counts]
    missing = budget - sum(s * k for s, k in zip(sizes, taken))
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if missing <= EXACT_WORDS:
            break
        more = min(counts[i] - taken[i], (missing - EXACT_WORDS) // sizes[i])
        taken[i] += more
        missing -= more * sizes[i]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if missing <= 4 * EXACT_WORDS:
            break
        more = min(counts[i] - taken[i], missing // sizes[i])
        taken[i] += more
        missing -= more * sizes[i]
    reach, mask, items = 1, (1 << (missing + 1)) - 1, []
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        if sizes[i] > missing:
            break
        spare, step = min(counts[i] - taken[i], missing // sizes[i]), 1
        while spare > 0:  # counts as powers of two
            part = min(step, spare)
            items.append((i, part, reach))
            reach |= (reach << part * sizes[i]) & mask
            spare -= part
            step *= 2
        if reach >> missing & 1:
            break
    at = reach.bit_length() - 1
    for i, part, before in reversed(items):
        if not before >> at & 1:
            taken[i] += part
            at -= part * sizes[i]
    return taken


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one source: whole passes, and how many documents of each size are taken once more."""
    rows = rows.sort_values("size").reset_index(drop=True)
    source_size = int((rows["size"] * rows["n"]).sum())
    passes = int(rows["target"][0] // source_size) if source_size else 0
    rest = round(rows["target"][0] - passes * source_size)
    full = rows["size"] > 0
    rows["passes"], rows["extra"] = passes, 0
    rows.loc[full, "extra"] = fit(rows["size"][full].tolist(), rows["n"][full].tolist(), rest)
    return rows[["key", "size", "n", "passes", "extra"]]


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _drawn(seed: int) -> Column:
    own = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit("")), F.lit(seed))
    return F.pmod(own, F.lit(1 << 52)) / float(1 << 52)


def _own_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))


def plan(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Sized documents, and for each source and size the passes and who comes once more."""
    sized = stored(
        docs.select(
            "doc_id", "source", _key(F.col("source")).alias("key"),
            word_count(F.col("text")).alias("size"), _drawn(seed).alias("draw"),
            _own_id().alias("own"),
        ),
        "mix-sizes",
    )
    totals = {r["source"]: r["words"] or 0 for r in  # one row a source
              sized.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    goal = targets(totals)
    # An Arrow table: rows of Python would start a second set of workers, which stay.
    sources = docs.sparkSession.createDataFrame(
        pa.table(
            {
                "key": pa.array(["n" if s is None else f"s{s}" for s in totals], pa.string()),
                "source_size": pa.array([totals[s] for s in totals], pa.int64()),
                "target": pa.array([goal.get(s, 0.0) for s in totals], pa.float64()),
            }
        )
    )
    counts = sized.groupBy("key", "size").agg(F.count("*").alias("n"))
    planned = counts.join(F.broadcast(sources), "key").groupBy("key").applyInPandas(
        _plan, "key string, size long, n long, passes int, extra long"
    )
    planned = stored(planned, "mix-plan")
    # Rows of one draw are counted first, so that a window holds a draw once.
    parts = sized.groupBy("key", "size", "draw", "own").agg(F.count("*").alias("ties")).join(
        planned.filter("extra > 0 AND extra < n"), ["key", "size"]
    ).withColumn("part", F.floor(F.col("draw") * F.ceil(F.col("n") / RANKED_ROWS)))
    parts = stored(
        parts.select("own", "key", "size", "draw", "ties", "part", "extra"), "mix-parts"
    )
    group = ["key", "size", "part"]
    before = parts.groupBy(*group).agg(F.sum("ties").alias("rows")).withColumn(
        "upto", F.sum("rows").over(Window.partitionBy("key", "size").orderBy("part"))
    ).select(*group, (F.col("upto") - F.col("rows")).alias("before"))
    in_order = Window.partitionBy(*group).orderBy("draw", "own")
    ranked = parts.withColumn("rank", F.sum("ties").over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    fits = F.col("extra") - F.col("before") - (F.col("rank") - F.col("ties"))
    last = ranked.join(before, group).withColumn("fits", fits).filter(
        "fits > 0 AND fits <= ties"
    ).select(
        "key", "size", F.col("draw").alias("last_draw"), F.col("own").alias("last_own"), "fits", "ties"
    )
    rules = planned.join(last, ["key", "size"], "left").join(F.broadcast(sources), "key")
    return sized, stored(rules, "mix-rules")


def _with_times(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (key, size, draw, own, …) with the rules of their size and how often they are taken:
    whole passes, and once more up to the last draw that fits."""
    joined = rows.join(rules, ["key", "size"])
    last = (F.col("draw") == F.col("last_draw")) & (F.col("own") == F.col("last_own"))
    split = F.coalesce(last & (F.col("fits") < F.col("ties")), F.lit(False))
    ahead = F.struct("draw", "own") < F.struct("last_draw", "last_own")
    once = F.when(F.col("extra") >= F.col("n"), True).otherwise(
        F.coalesce(F.col("last_draw").isNotNull() & (ahead | last), F.lit(False))
    )

    def taken(more: Column) -> Column:
        times = F.col("passes") + more.cast("int")
        return F.when(F.col("size") == 0, 0).otherwise(times).cast("int").alias("times")

    if rules.filter("fits < ties").isEmpty():
        return joined.select("*", taken(once))
    # Equal rows of which only some fit: numbered, part by part of the stored table.
    some = stored(joined.filter(split).withColumn("_row", F.monotonically_increasing_id()), "mix-ties")
    some = some.withColumn("_part", F.shiftright("_row", 33))
    group = ["key", "size", "_part"]
    before = some.groupBy(*group).agg(F.count("*").alias("_rows")).withColumn(
        "_upto", F.sum("_rows").over(Window.partitionBy("key", "size").orderBy("_part"))
    ).select(*group, (F.col("_upto") - F.col("_rows")).alias("_before"))
    number = F.row_number().over(Window.partitionBy(*group).orderBy("_row")) + F.col("_before")
    numbered = some.join(before, group).withColumn("_number", number)
    chosen = numbered.select(*joined.columns, taken(F.col("_number") <= F.col("fits")))
    return joined.filter(~split).select("*", taken(once)).unionByName(chosen)


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken."""
    sized, rules = plan(docs, seed)
    return _with_times(sized, rules).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("times") * F.col("size")).cast("long").alias("taken"),
    )


def take(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The documents of the mix with all their columns, repeated as often as they are taken."""
    _, rules = plan(docs, seed)
    kept = [F.col(f"d.`{c}`").alias(c) for c in docs.columns]
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
        _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"),
        _drawn(seed).alias("draw"), _own_id().alias("own"),
    )
    repeat = F.explode(F.sequence(F.lit(1), F.col("times")))
    times = _with_times(own, rules).filter("times > 0")
    return times.select("d", repeat.alias("again")).select(*kept)
