"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sanitaria.llm.common import Scratch, free_name

#: Documents of one flight. What a flight leaves open (two at most) goes up to the next level.
BLOCK = 4_096
WORD = r"[^\x20\x09-\x0D]+"
#: Units that the last flight leaves to the landing.
LANDING = 12
_EPS = 1e-9
#: Rows of the plan that are sent to every executor at most; a longer plan is joined.
BROADCAST_ROWS = 1_000_000


def fly(probability: Sequence[float], size: Sequence[float], draw: random.Random) -> list[float]:
    """Flight phase: probabilities move until at most two are fractional.

    Three open units at a time move along the null space of the constraint matrix with
    the rows (1, 1, 1) and (their sizes), so the expected number of documents and of tokens
    stays what it was.  The step ends where one of them reaches 0 or 1, and its sign is
    drawn such that every unit keeps its expectation.
    """
    p = [float(x) for x in probability]
    active: list[int] = []
    for unit in range(len(p)):
        if not _EPS < p[unit] < 1 - _EPS:
            p[unit] = float(round(p[unit]))
            continue
        active.append(unit)
        while len(active) == 3:
            a, b, c = active
            step = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
            if not any(step):
                step = (1.0, -1.0, 0.0)
            up = min((1 - p[k]) / u if u > 0 else p[k] / -u for k, u in zip(active, step, strict=True) if u)
            down = min(p[k] / u if u > 0 else (1 - p[k]) / -u for k, u in zip(active, step, strict=True) if u)
            move = up if draw.random() * (up + down) < down else -down
            left = []
            for k, u in zip(active, step, strict=True):
                p[k] += move * u
                if _EPS < p[k] < 1 - _EPS:
                    left.append(k)
                else:
                    p[k] = float(round(p[k]))
            active = left
    return p


def land(probability: Sequence[float], size: Sequence[float]) -> list[float]:
    """Landing phase: of all roundings of the few open units, the one nearest in tokens, then in documents."""
    p = np.array(probability, dtype=float)
    units = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    if len(units):
        rounded = (np.arange(1 << len(units))[:, None] >> np.arange(len(units)) & 1).astype(float)
        moves = rounded - p[units]
        tokens, documents = np.abs(moves @ np.asarray(size, dtype=float)[units]), np.abs(moves.sum(axis=1))
        p[units] = rounded[np.lexsort((documents, np.round(tokens, 6)))[0]]
    return p.round().tolist()


def fly_and_land(probability: Sequence[float], size: Sequence[float], draw: random.Random) -> list[float]:
    """A last flight: ``LANDING`` units of all sizes stay on the ground and land with what it leaves open."""
    p = np.array(probability, dtype=float)
    fractional = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    ground = fractional[np.unique(np.linspace(0, len(fractional) - 1, min(LANDING, len(fractional))).astype(int))]
    flying = np.setdiff1d(np.arange(len(p)), ground)
    p[flying] = fly(p[flying], np.asarray(size, dtype=float)[flying], draw)
    return land(p, size)


def source_targets(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source, source_size, n_docs, target``: ``share`` of all sizes dealt out by weight.

    Sources in code-point order, null last, take the weights in turn.  No target
    exceeds ``most`` times its source; the excess goes to the others by weight.
    The rows here are sources, not documents: their order and running sums are small windows.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(float(most))
    weighed = sources.withColumn("w", weight).withColumn("all", F.sum("source_size").over(everything))
    # Filling up: in order of cap / weight a source is full as long as its cap is below what is left, by weight.
    fill = Window.orderBy(cap / F.col("w"), F.asc_nulls_last("source"))
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    later = fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("all") * share - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0))) / F.sum("w").over(later)
    filled = weighed.withColumn("level", level).withColumn("full", cap / F.col("w") <= F.col("level"))
    open_level = F.min(F.when(~F.col("full"), F.struct(cap / F.col("w"), "level"))).over(everything)["level"]
    target = F.when(F.col("full"), cap).otherwise(F.least(cap, F.col("w") * F.col("open")))
    return filled.withColumn("open", open_level).select(
        "source", "source_size", "n_docs", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def _flight(level: int, last: bool, seed: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: what stays open at the end is small.
        rows = rows.sort_values(["size", "key"], ascending=[False, True], kind="stable", na_position="last")
        draw = random.Random(zlib.crc32(f"{seed}|{level}|{key}".encode()))
        size = rows["size"].to_numpy(dtype=float)
        return rows.assign(p=np.array((fly_and_land if last else fly)(rows["p"].to_numpy(dtype=float), size, draw)))

    return run


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    scratch: Scratch | None = None,
) -> DataFrame:
    """How often the mix takes each document, with source totals near their targets.

    A source with target ``e`` times its size takes each document ``floor(e)`` times, and
    once more with probability ``e - floor(e)``; the cube method makes that choice
    balanced in documents and tokens.  Blocks of about ``block`` documents of one source fly in
    parallel, so a hot source is many blocks; each leaves two open units at most, which fly
    again one level up, until one block a source is left and lands.

    Returns ``key, source, size, source_size, target, copies, taken``, one row per input
    row; other columns are ignored.  ``size`` is the number of words, 0 for a null or empty text.
    Null sources are a source of their own, the last; a source of size 0 has target 0.
    Repeated rows are taken each on its own.  Choices depend on keys, sizes and the
    seed, not on the order or partitioning of the input, save between rows equal in all of them: those, and rows
    without a key, are numbered, so that however many there are they fly in many blocks.
    """
    scratch = scratch or Scratch()
    written = scratch.written
    sized = written(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    # Keys that many rows of one size share (or lack) would hash into one block: their rows are told apart by number.
    often = sized.groupBy("key", "size").agg(F.count("*").alias("n")).filter(F.col("n") > max(block // 8, 64))
    often = written(often.select(F.col("key").alias("k"), F.col("size").alias("s"), F.lit(True).alias("often")), "mix-often")
    if not often.isEmpty():
        sized = sized.join(often, sized["key"].eqNullSafe(often["k"]) & (sized["size"] == often["s"]), "left")
        sized = sized.select("key", "source", "size", F.when(F.col("often"), F.col("row")).alias("row"))
    else:
        sized = sized.withColumn("row", F.lit(None).cast("long"))
    targets = written(source_targets(sized, weights, share, most), "mix-targets")
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
        .select("key", "row", targets["source"], "size", "source_size", "n_docs", "target", ratio.alias("ratio"))
        .select(
            "key", "row", "source", "size", "source_size", "n_docs", "target",
            F.floor("ratio").cast("int").alias("whole"),
            (F.col("ratio") - F.floor("ratio")).alias("p"),
        )
    )
    settled, level, blocks = [], 0, -(-largest // block)
    while True:
        count = F.ceil(F.col("n_docs") / F.lit(block * (block // 2) ** level)).cast("long")
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "size", "row", F.lit(seed)), count))
        flown = dealt.groupBy("source", "block").applyInPandas(_flight(level, blocks <= 1, seed), dealt.schema)
        done = written(flown.drop("block"), f"mix-level-{level}")
        if blocks <= 1:
            settled.append(done)
            break
        settled.append(done.filter(F.col("p").isin(0.0, 1.0)))
        rows = done.filter(~F.col("p").isin(0.0, 1.0))
        blocks, level = -(-blocks * 2 // block), level + 1
    copies = (F.col("whole") + F.col("p")).cast("int")
    return reduce(DataFrame.unionByName, settled).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as ``mix_sources`` takes them: rows that it takes twice stand there twice, others not at all.

    Null texts have no words and null sources are a source; rows with a null or a repeated ``doc_id`` are rows of their
    own, by their place; all columns come back as they are; an empty table gives an empty one.  The plan (two numbers a
    row) meets the texts by broadcast while it has at most ``BROADCAST_ROWS`` rows, and by a join beyond that.
    """
    scratch, row = Scratch(), free_name(docs, "row_id")
    rows = scratch.written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    times = free_name(rows, "times")
    with Scratch() as inner:
        plan = mix_sources(rows.select(row, "text", "source"), key=row, scratch=inner, **options)
        taken = scratch.written(plan.filter("copies > 0").select(row, F.col("copies").alias(times)), "mix-plan")
    few = taken.count() <= BROADCAST_ROWS
    each = rows.join(F.broadcast(taken) if few else taken, row)
    return each.withColumn(times, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)
