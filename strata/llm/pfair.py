"""Interleaving sources to target weights by Pfair scheduling.

Each source's documents are put in a fixed random order and cut into blocks.
In the ideal (fluid) mixture all sources run at once, each at its weight's
share of the sources that have not ended.  A source of weight ``w`` and ``B``
blocks has had ``min(w v, B)`` blocks at the inner time ``v``, so slot time is
``t(v) = sum(min(w v, B))`` over all sources.  Block ``k`` (from 0) is released
at ``floor(t(k/w))`` and due at ``ceil(t((k+1)/w))``; one block runs per slot,
the released block with the earliest deadline first.  As the fluid fills every
slot, no deadline is ever missed, and after any slot each source is less than
one block from the fluid, also across the ends of sources.

Weights are taken as exact ratios, not rounded; times are whole-number
arithmetic.  The schedule is one pass over the blocks in one task, which keeps
one block per source and returns rows as it goes: neither the driver nor that
task holds the schedule, and the number of sources is not bounded.  No row is
dropped or repeated.

Defined results: a null source is a source of its own, named by null; rows
repeated in full keep an arbitrary order among themselves; an empty table
gives an empty schedule.  All columns of the input are returned first; a
column that clashes with an added one is replaced by it.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, islice

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from strata.operators.staging import stage

SCHEDULE = "source string, block long, slot long, release_slot long, deadline_slot long"


def scheduled_blocks(blocks: dict, weights: dict) -> Iterator[tuple]:
    """(source, block, slot, release, deadline) of all blocks, in the order of slots.

    ``blocks`` counts each source's blocks; ``weights`` are positive numbers.
    """
    names = sorted(blocks, key=lambda s: (s is not None, str(s)))
    exact = [Fraction(weights[s]) for s in names]
    scale = math.lcm(*(x.denominator for x in exact))
    w, n = [int(x * scale) for x in exact], [blocks[s] for s in names]
    ending = sorted(range(len(names)), key=lambda i: (Fraction(n[i], w[i]), i))
    ends = [Fraction(n[i], w[i]) for i in ending]
    # before the end of ending[j]: blocks of the sources that have ended, and the weights that are left
    ended = list(accumulate((n[i] for i in ending), initial=0))
    left = list(accumulate((w[i] for i in ending), lambda a, x: a - x, initial=sum(w)))

    def time(i: int, k: int, j: int) -> tuple[int, int, int]:
        """Slot time at which source ``i`` has had ``k`` blocks, rounded down and up; the end before which that is."""
        if n[ending[j]] * w[i] < k * w[ending[j]]:
            j = bisect_left(ends, Fraction(k, w[i]), j)
        whole, rest = divmod(k * left[j], w[i])
        return ended[j] + whole, ended[j] + whole + (rest > 0), j

    def entry(i: int, k: int, release: int, j: int) -> tuple:
        down, up, j = time(i, k + 1, j)
        return release, up, i, k, down, j  # the next block is released at ``down``

    waiting = [entry(i, 0, 0, 0) for i in range(len(names)) if n[i]]
    heapq.heapify(waiting)
    ready: list = []
    for slot in range(sum(n)):
        while waiting and waiting[0][0] <= slot:
            release, due, i, k, after, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, i, k, release, after, j))
        due, i, k, release, after, j = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline was missed")
        yield names[i], k, slot, release, due
        if k + 1 < n[i]:
            heapq.heappush(waiting, entry(i, k + 1, after, j))


def mix_sources(
    docs: DataFrame,
    weights: dict | None = None,
    temperature: float = 0.5,
    block_rows: int = 64,
    period: int = 1000,
    bucket_rows: int = 2_000,
    seed: int = 7,
) -> DataFrame:
    """``docs(doc_id, source)`` with ``block, slot, release_slot, deadline_slot, place``.

    ``weights`` maps every source to its target; without it they follow from
    the counts of all documents and ``temperature``.  ``place`` orders rows:
    by slot, then within the block.  ``period`` slots are scheduled at a time.
    A source's documents are numbered in buckets of about ``bucket_rows``, so
    that no source meets in one task.
    """
    spark = docs.sparkSession
    added = ["block", "slot", "release_slot", "deadline_slot", "place"]
    rows = docs.drop(*added, "mix_hash", "mix_bucket", "mix_number")
    counts = rows.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("n", F.lit(float(temperature))))
    else:
        targets = spark.createDataFrame(
            [(s, float(w)) for s, w in weights.items() if w > 0], "source string, weight double"
        )
        weighed = (
            counts.alias("c")
            .join(F.broadcast(targets.alias("t")), same_key("c", "t", ["source"]), "left")
            .select("c.*", "t.weight")
        )
    sources = stage(
        weighed.withColumn("buckets", F.ceil(F.col("n") / bucket_rows)).withColumn("blocks", F.ceil(F.col("n") / block_rows)),
        "mixture-sources",
    )
    if missing := [r["source"] for r in sources.where("weight is null").limit(5).collect()]:
        raise ValueError(f"no positive weight for {sorted(map(str, missing))}")
    schedule = stage(
        sources.select("source", "weight", "blocks").repartition(1).mapInPandas(_scheduler(period), SCHEDULE),
        "mixture-schedule",
    )

    hashed = rows.withColumn("mix_hash", F.xxhash64(F.lit(seed), F.col("doc_id")))
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    # the hash's range cut into equal parts keeps buckets in hash order
    part = F.floor((F.col("mix_hash") / F.lit(2.0**64) + 0.5) * F.col("s.buckets"))
    bucketed = hashed.alias("d").join(F.broadcast(sources.alias("s")), same).select(
        "d.*", F.least(part, F.col("s.buckets") - 1).alias("mix_bucket")
    )
    sizes = bucketed.groupBy("source", "mix_bucket").count()
    before = Window.partitionBy("source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("source", "mix_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("source", "mix_bucket").orderBy("mix_hash", "doc_id")
    numbered = (
        bucketed.withColumn("mix_number", F.row_number().over(inside) - 1)
        .alias("d")
        .join(firsts.alias("f"), same_key("d", "f", ["source", "mix_bucket"]))
        .select("d.*", (F.col("f.first") + F.col("d.mix_number")).alias("number"))
        .withColumn("block", F.floor(F.col("number") / block_rows))
    )
    placed = numbered.alias("n").join(schedule.alias("p"), same_key("n", "p", ["source", "block"])).select(
        *[F.col(f"n.`{c}`") for c in rows.columns],
        *[F.col(f"p.{c}") for c in ("block", "slot", "release_slot", "deadline_slot")],
        F.pmod(F.col("n.number"), F.lit(block_rows)).alias("in_block"),
    )
    return placed.withColumn("place", F.col("slot") * block_rows + F.col("in_block")).drop("in_block")


def _scheduler(at_once: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: dict = {}
        weights: dict = {}
        for batch in batches:
            for source, weight, n in zip(batch["source"], batch["weight"], batch["blocks"]):
                blocks[source], weights[source] = int(n), float(weight)
        names = [field.split()[0] for field in SCHEDULE.split(", ")]
        found = scheduled_blocks(blocks, weights)
        while part := list(islice(found, at_once)):
            yield pd.DataFrame(part, columns=names)

    return write


def same_key(left: str, right: str, names: list[str]):
    """Null-safe equality of columns of two aliases."""
    match = F.lit(True)
    for name in names:
        match = match & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return match
