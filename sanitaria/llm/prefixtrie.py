"""Trie of shared conversation beginnings: minimal perfect hashing of prefix digests, arrays summed in depth order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sanitaria.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of one conversation that lie in one shard; longer ones go on in another.
SPAN = 1_024
#: Rows of a shard, about, and how many shards there are at least.
SHARD_ROWS, LEAST_SHARDS = 20_000, 256
#: Ids that are written into one line at most.
ID_RANGE = 1 << 16


# ---- minimal perfect hashing -------------------------------------------------------------------


def _level_hash(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    h = (hi ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93) + lo
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return (h % np.uint64(size)).astype(np.int64)


class SlotTable:
    """Slots 0 to n-1 for n distinct 128-bit digests, without gaps, and the digest that owns each slot.

    Level by level the digests left over are hashed into as many places as there are of them; who has a place alone
    keeps it, and its slot is its rank among all kept places.  A digest that was not put in also gets some place,
    so every look-up is verified against the owner.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.hi, self.lo = np.empty(len(hi), np.uint64), np.empty(len(lo), np.uint64)
        rest, done = np.arange(len(hi)), 0
        while len(rest):
            size = len(rest) + len(rest) // 4 + 1
            place = _level_hash(hi[rest], lo[rest], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + done
            keeps = alone[place]
            slots = rank[place[keeps]]
            self.hi[slots], self.lo[slots] = hi[rest[keeps]], lo[rest[keeps]]
            self.levels.append((np.where(alone, rank, -1), size))
            rest, done = rest[~keeps], done + int(keeps.sum())
            if len(self.levels) > 64:
                raise ValueError("digests repeat")

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Each digest's slot, or -1 where it is none of the table's."""
        found, open_ = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, (rank, size) in enumerate(self.levels):
            if not len(open_):
                break
            slot = rank[_level_hash(hi[open_], lo[open_], level, size)]
            there = slot >= 0
            found[open_[there]] = slot[there]
            open_ = open_[~there]
        known = found >= 0
        known[known] = (self.hi[found[known]] == hi[known]) & (self.lo[found[known]] == lo[known])
        return np.where(known, found, -1)


def _digests(table: pa.Table, hi: str = "hi", lo: str = "lo") -> tuple[np.ndarray, np.ndarray]:
    return table[hi].to_numpy().view(np.uint64), table[lo].to_numpy().view(np.uint64)


def _table_of(hi: np.ndarray, lo: np.ndarray) -> SlotTable:
    both = np.unique(np.stack([hi, lo], axis=1), axis=0)
    return SlotTable(np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1]))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def partial_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of one shard's rows: how many of its conversations pass each, and the smallest."""
    hi, lo = _digests(rows)
    table = _table_of(hi, lo)
    slot, n = table.slots(hi, lo), len(table.hi)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, rows["conv"].to_numpy())
    columns = {"hi": _signed(table.hi), "lo": _signed(table.lo), "n_convs": np.bincount(slot, minlength=n), "conv": least}
    for name in ("pos", "phi", "plo", "words"):  # the same in all rows of a node
        columns[name] = np.zeros(n, np.int64)
        columns[name][slot] = rows[name].to_numpy()
    return pa.table(columns)


def subtree_sums(rows: pa.Table, own: pa.Table) -> pa.Table:
    """What one shard's part of the trie adds to each node's subtree.

    ``own`` has values to be counted in this shard: with a digest those of a node, without one what the
    conversation's later turns, which lie in other shards, hand up to its last row here.
    """
    hi, lo = _digests(rows)
    table = _table_of(hi, lo)
    slot, n = table.slots(hi, lo), len(table.hi)
    pos = rows["pos"].to_numpy()
    parent = np.full(n, -1, np.int64)
    # The first turn of a span has its parent in another shard, whose rows get its sum handed up.
    inner = (pos > 0) & ((pos % SPAN != 1) | (pos == 1))
    parent[slot[inner]] = table.slots(*(d[inner] for d in _digests(rows, "phi", "plo")))
    depth = np.zeros(n, np.int64)
    depth[slot] = pos
    sums = np.zeros((n, 2), np.int64)
    values = np.stack([own["leaves"].to_numpy(), own["saved"].to_numpy()], axis=1)
    handed = own["handed"].to_numpy(zero_copy_only=False).astype(bool)
    at = table.slots(*_digests(own))
    if handed.any():
        order = np.lexsort((pos, rows["conv"].to_numpy(), rows["span"].to_numpy()))
        key = np.stack([rows["conv"].to_numpy()[order], rows["span"].to_numpy()[order]], axis=1)
        last = np.flatnonzero(np.append((key[1:] != key[:-1]).any(axis=1), True))
        ends = {(c, s): slot[order[k]] for (c, s), k in zip(key[last].tolist(), last.tolist(), strict=True)}
        whose = zip(own["conv"].to_numpy()[handed].tolist(), own["span"].to_numpy()[handed].tolist(), strict=True)
        at[handed] = [ends[w] for w in whose]
    if (at < 0).any():
        raise ValueError("a value without a node")
    np.add.at(sums, at, values)
    # Depth order, deepest first: a level's sums are final before its parents' level adds them.
    by_depth = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[by_depth], prepend=-1, append=-1))
    for first, stop in zip(edges[:-1], edges[1:], strict=True):
        level = by_depth[first:stop]
        level = level[parent[level] >= 0]
        np.add.at(sums, parent[level], sums[level])
    kept = sums.any(axis=1)
    return pa.table({
        "hi": _signed(table.hi)[kept], "lo": _signed(table.lo)[kept],
        "n_leaves": np.ascontiguousarray(sums[kept, 0]), "saved_tokens": np.ascontiguousarray(sums[kept, 1]),
    })


# ---- rebuilding and digests in Spark --------------------------------------------------------------


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, at, n, c1, c2, words``: each turn's place from 1 in its conversation of ``n``, its content's digest and words.

    Rows are dealt out in ranges of all that orders them, so a conversation of any length is sorted by many tasks;
    its parts are then counted on.
    """
    empty = F.lit("")
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    order = ["conv", "turn", "role", "text"]
    md5 = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    half = lambda start: F.conv(F.substring(md5, start, 16), 16, -10).cast("long")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", half(1).alias("c1"), half(17).alias("c2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"),
    )
    placed = written(ranged, "trie-turns")
    parts = placed.groupBy("conv", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("conv")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    return placed.join(parts, ["conv", "part"]).select(
        "conv", (F.col("row") - F.col("first") + F.col("before") + 1).alias("at"), "n", "c1", "c2", "words"
    )


def rebuilt_turns(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """``conv, pos, total, c1, c2, words`` of the rebuilt conversations, with a row at ``pos`` 0 for each.

    The first ``h = crc32(id) % most`` turns come from conversation ``id - id % family``, the rest are the
    conversation's own after its first ``h``.
    """
    rows = written(numbered_turns(turns), "trie-numbered")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(most)
    base = F.col("conv") - F.col("conv") % F.lit(family)
    sizes = rows.filter("at = 1").select("conv", "n", h.alias("h"), base.alias("base"))
    heads = rows.filter((F.col("at") < most) & (F.col("conv") == base))
    base_sizes = heads.groupBy(F.col("conv").alias("base")).agg(F.max("at").alias("base_n"))
    convs = sizes.join(base_sizes, "base", "left").withColumn(
        "k", F.least("h", F.coalesce("base_n", F.lit(0)))
    ).withColumn("total", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv", "base", "h", "k", "total"), "trie-convs")
    none = F.lit(0).cast("long")
    roots = convs.select("conv", none.alias("pos"), "total", none.alias("c1"), none.alias("c2"), none.alias("words"))
    taken = heads.select(F.col("conv").alias("base"), "at", "c1", "c2", "words").join(convs, "base").filter("at <= h")
    own = rows.filter(F.col("at") > h).join(convs.select("conv", "h", "k", "total"), "conv")
    return (
        roots.unionByName(taken.select("conv", F.col("at").alias("pos"), "total", "c1", "c2", "words"))
        .unionByName(own.select("conv", (F.col("k") + F.col("at") - F.col("h")).alias("pos"), "total", "c1", "c2", "words"))
    )


_LIMBS = ("g0", "g1", "g2", "g3")


def _digest(limbs: list[Column]) -> tuple[Column, Column]:
    fold = lambda low, high: low.bitwiseXOR(F.shiftleft(high, 32))
    return fold(limbs[0], limbs[1]), fold(limbs[2], limbs[3])


def _span(pos: str = "pos") -> Column:
    return F.floor(F.greatest(F.col(pos) - 1, F.lit(0)) / SPAN).cast("long")


def prefix_rows(rebuilt: DataFrame) -> DataFrame:
    """``rebuilt`` with ``span`` and the digests ``hi, lo`` of each prefix and ``phi, plo`` of the one before it.

    A turn's hash includes its place, and a prefix's digest is the sum of its turns' hashes, kept in four sums of
    32 bits each: so sums of spans can be taken apart from each other, and a long conversation needs no single task.
    """
    one, two = F.xxhash64("c1", "c2", "pos"), F.xxhash64("pos", "c2", "c1", F.lit(1))
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))
    limbs = [low(one), F.shiftrightunsigned(one, 32), low(two), F.shiftrightunsigned(two, 32)]
    limbs = [F.when(F.col("pos") > 0, c).otherwise(F.lit(0)).alias(g) for c, g in zip(limbs, _LIMBS, strict=True)]
    hashed = rebuilt.select("*", _span().alias("span"), *limbs)
    inside = Window.partitionBy("conv", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = written(
        hashed.select("conv", "pos", "total", "words", "span", *_LIMBS, *(F.sum(g).over(inside).alias(f"s{g}") for g in _LIMBS)),
        "trie-running",
    )
    spans = running.groupBy("conv", "span").agg(*(F.sum(g).alias(g) for g in _LIMBS))
    earlier = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select("conv", "span", *(F.sum(g).over(earlier).alias(f"b{g}") for g in _LIMBS)).filter("span > 0")
    with_before = running.join(before, ["conv", "span"], "left")
    now = [F.col(f"s{g}") + F.coalesce(f"b{g}", F.lit(0)) for g in _LIMBS]
    then = [n - F.col(g) for n, g in zip(now, _LIMBS, strict=True)]
    hi, lo = _digest(now)
    phi, plo = _digest(then)
    return with_before.select(
        "conv", "pos", "total", "words", "span", hi.alias("hi"), lo.alias("lo"), phi.alias("phi"), plo.alias("plo")
    )


def _ends(rows: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256``: of the conversations that end at a node, ids in order, written in parts and hashed as a stream."""
    ids = rows.filter("pos = total").groupBy("hi", "lo", F.floor(F.col("conv") / ID_RANGE).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for hi, lo, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if node == (hi, lo):
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (hi, lo), hashlib.sha256(ids.encode())
        if node:
            done.append((*node, digest.hexdigest()))
        for at in range(0, len(done), 10_000):
            columns = zip(*done[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hi", "lo", "ends_sha256"])

    ordered = ids.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "part")
    return ordered.mapInArrow(run, "hi bigint, lo bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """One row of each node of the trie of rebuilt conversations (see ``rebuilt_turns``).

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: a node is a
    distinct sequence of first turns (role and text), named by its smallest member.

    1. Spark sorts and numbers turns, rebuilds, and sums turn hashes to prefix digests of 128 bits.
    2. Rows are dealt into shards by conversation and span of turns.  Each shard enumerates its distinct digests,
       gives them verified slots and counts into arrays; Spark merges the shards' nodes.  A beginning that a
       third of all conversations share is one row of each shard.
    3. What a node adds to its ancestors goes to the shard of its smallest member, is summed there through the
       parent slots in depth order, and Spark adds up the shards.

    Turns go by turn (null first), then role and text.  Null role or text is empty; rows with a null ``conv_id`` belong
    to no conversation and are left out; repeated rows are turns of their own; other columns are ignored; without
    conversations there are no rows, not even a root.
    """
    rows = prefix_rows(rebuilt_turns(turns, family, most))
    rows = written(rows, "trie-rows")
    shards = max(LEAST_SHARDS, -(-rows.count() // SHARD_ROWS))
    shard = lambda conv, span: F.pmod(F.xxhash64(conv, span), F.lit(shards)).alias("shard")
    dealt = rows.select(shard("conv", "span"), "conv", "pos", "span", "words", "hi", "lo", "phi", "plo")
    merged = (
        dealt.groupBy("shard")
        .applyInArrow(partial_nodes, "hi bigint, lo bigint, n_convs bigint, conv bigint, pos bigint, phi bigint, plo bigint, words bigint")
        .groupBy("hi", "lo")
        .agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), *(F.first(c).alias(c) for c in ("pos", "phi", "plo", "words")))
    )
    children = merged.filter("pos > 0").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(
        F.count("*").alias("n_children")
    )
    nodes = merged.join(children, ["hi", "lo"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "trie-nodes")
    leaves, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    own = nodes.select("conv", _span().alias("span"), "hi", "lo", leaves.alias("leaves"), saved.alias("saved"))
    own = own.filter("leaves > 0 OR saved > 0")
    spans = own.groupBy("conv", "span").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # Conversations of several spans: each span gets what the later ones hold.
    long = rows.filter(f"pos = 0 AND total > {SPAN}").select(
        "conv", F.explode(F.sequence(F.lit(0).cast("long"), _span("total"))).alias("span")
    )
    later = Window.partitionBy("conv").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    handed = long.join(spans, ["conv", "span"], "left").select(
        "conv", "span", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(c) for c in ("leaves", "saved"))
    ).filter("leaves > 0 OR saved > 0")
    zero = F.lit(0).cast("long")
    given = own.withColumn("handed", F.lit(False)).unionByName(
        handed.select("conv", "span", zero.alias("hi"), zero.alias("lo"), "leaves", "saved", F.lit(True).alias("handed"))
    )
    given = given.select(shard("conv", "span").alias("of"), "*")
    summed = (
        dealt.groupBy("shard")
        .cogroup(given.groupBy("of"))
        .applyInArrow(subtree_sums, "hi bigint, lo bigint, n_leaves bigint, saved_tokens bigint")
        .groupBy("hi", "lo")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    parents = nodes.filter("n_children > 0").select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv").alias("parent"))
    full = written(nodes.join(summed, ["hi", "lo"], "left").join(_ends(rows), ["hi", "lo"], "left"), "trie-full")
    at_root = F.col("pos") == 0
    return full.join(parents, ["phi", "plo"], "left").select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), F.when(~at_root, F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
