"""Minimax contiguous partition of documents into shards, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sanitaria.llm.common import written

#: Atoms at most. Their sums, one array of 16 bytes an atom, are what the search works on.
SLOTS = 65_536
#: An atom with more than 1/HOT of all rows has its rows numbered in SALTS pieces.
HOT, SALTS = 1_024, 64


def _cuts(shards: int) -> str:
    """SQL for the ends of the shards in ``sizes``, an array of atom sizes.

    For each shard in turn a binary search finds the smallest capacity with which the
    atoms that are left fit into the shards that are left.  The check is greedy: a shard
    takes atoms while they fit.  The first shard of the best packing is cut off, and the
    search goes on with the rest.
    """
    mid = "((b.lo + b.hi) div 2)"
    check = f"""aggregate(st.rest, named_struct('n', 1L, 'run', 0L, 'first', 0),
        (r, s) -> if(r.run + s <= {mid},
            named_struct('n', r.n, 'run', r.run + s, 'first', r.first + if(r.n = 1, 1, 0)),
            named_struct('n', r.n + 1, 'run', s, 'first', r.first)),
        r -> if(r.n <= {shards} - i + 1, named_struct('lo', b.lo, 'hi', {mid}, 'take', r.first),
            named_struct('lo', {mid} + 1, 'hi', b.hi, 'take', b.take)))"""
    total = "aggregate(st.rest, 0L, (x, y) -> x + y)"
    largest = "coalesce(array_max(st.rest), 0L)"
    low = f"greatest({largest}, CAST(ceil({total} / ({shards} - i + 1)) AS BIGINT))"
    search = f"""aggregate(sequence(1, 62),
        named_struct('lo', {low}, 'hi', least({total}, {low} + {largest} + 1), 'take', size(st.rest)),
        (b, j) -> if(b.lo >= b.hi, b, {check}),
        b -> named_struct('rest', slice(st.rest, b.take + 1, size(st.rest)),
            'ends', concat(st.ends, array(b.take + coalesce(element_at(st.ends, -1), 0)))))"""
    # element_at raises on an empty array with index -1, so the ends start with a 0.
    return f"""slice(aggregate(sequence(1, {shards}), named_struct('rest', sizes, 'ends', array(0)),
        (st, i) -> {search}, st -> st.ends), 2, {shards})"""


def shard_minimax(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """Shards of near equal bytes; equal texts stay together.

    Atoms are hash slots of the text, so a group of equal texts is never cut and the
    number of atoms is bounded whatever the input.  They are ordered by falling size:
    an atom above a fair share fills a shard of its own, the smallest ones come last.
    With few texts nearly every atom is one group; with many, an atom is about
    ``1 / slots`` of the bytes, which is the most that two shards without a hot atom differ.

    Returns ``key, size, text_crc32, shard, slot`` and nothing else; other columns are
    ignored.  ``size`` is the UTF-8 bytes of the text plus 1.  A null text counts as an
    empty one.  ``slot`` runs from 0 without gaps within a shard, by atom and then by key
    (nulls first); rows equal in key, size and text may take each other's place.  Repeated
    rows are rows of their own.  An empty table gives an empty result, and fewer
    atoms than shards leave the last shards empty.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.pmod(F.xxhash64(body), F.lit(slots)).cast("int").alias("atom"),
        ),
        "shard-rows",
    )
    atoms = rows.groupBy("atom").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    packed = atoms.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("order"), "atom", "n"))).alias("atoms"),
        F.sum("n").alias("total"),
    )
    # One row, written, so that the search runs once and not once for each atom below.
    cut = written(
        packed.select("total", "atoms", F.expr("transform(atoms, x -> -x.order)").alias("sizes")).select(
            "total", "atoms", F.expr(_cuts(shards)).alias("ends")
        ),
        "shard-cuts",
    )
    planned = cut.select("total", "ends", F.posexplode("atoms").alias("at", "x"))
    placed = written(
        planned.select(
            F.col("x.atom").alias("atom"),
            F.expr("size(filter(ends, e -> e <= at))").alias("shard"),
            F.when(F.col("x.n") * HOT > F.col("total"), SALTS).otherwise(1).alias("salts"),
        ),
        "shard-atoms",
    )
    # At most SLOTS rows of three integers, and at most SLOTS + HOT * SALTS cells: both fit anywhere.
    salted = rows.join(F.broadcast(placed), "atom").withColumn("salt", F.pmod(F.xxhash64("key", "size"), "salts"))
    before = Window.partitionBy("shard").orderBy("atom", "salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        salted.groupBy("shard", "atom", "salt")
        .agg(F.count("*").alias("n"))
        .select("atom", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("atom", "salt").orderBy("key", "crc", "size")
    numbered = salted.withColumn("row", F.row_number().over(within)).join(F.broadcast(cells), ["atom", "salt"])
    return numbered.select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("base") + F.col("row") - 1).cast("long").alias("slot"),
    )
