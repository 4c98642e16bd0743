import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from sanitaria.llm.sharding import _cuts, shard_minimax
from tests.llm.data import documents, texts


def best_capacity(sizes, shards):
    """Smallest capacity with which ``sizes`` in their order fit, by dynamic programming."""
    infinite = float("inf")
    best = [0.0] + [infinite] * len(sizes)
    for _ in range(shards):
        new = [0.0] + [infinite] * len(sizes)
        for end in range(1, len(sizes) + 1):
            run = 0
            for start in range(end - 1, -1, -1):
                run += sizes[start]
                new[end] = min(new[end], max(best[start], run))
        best = [min(a, b) for a, b in zip(best, new, strict=True)]
    return best[-1]


def test_cuts_are_the_best_packing(spark):
    draw = random.Random(3)
    for shards in (1, 3, 8):
        cases = [[draw.randrange(1, 60) for _ in range(draw.randrange(0, 14))] for _ in range(25)] + [[500, 1, 1, 1]]
        rows = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, sizes array<bigint>")
        for k, ends in rows.select("k", F.expr(_cuts(shards)).alias("ends")).collect():
            cuts = [0, *ends]
            assert len(ends) == shards and cuts[-1] == len(cases[k]) and cuts == sorted(cuts)
            parts = [sum(cases[k][a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            assert max(parts) == best_capacity(cases[k], shards), (cases[k], ends)


def test_shards_hold_groups_and_number_rows(spark):
    rows = shard_minimax(documents(spark), shards=4).collect()
    assert len(rows) == len(texts())
    expected = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in texts())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == expected
    of_text, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))


def test_near_equal_bytes_and_hot_group(spark):
    plain = shard_minimax(documents(spark, [(k, "x" * (k % 50)) for k in range(2_000)] ), shards=4)
    assert plain.groupBy("shard").count().count() == 4
    hot = [(k, f"text {k} " * 5) for k in range(1_000)] + [(k, "copy " * 12) for k in range(1_000, 1_500)]
    sums = dict(shard_minimax(documents(spark, hot), shards=8).groupBy("shard").agg(F.sum("size")).collect())
    rest = sorted(sums.values())[:-1]
    assert len(sums) == 8 and max(rest) - min(rest) < 0.02 * max(rest)


def test_empty_table(spark):
    assert shard_minimax(documents(spark, [])).count() == 0
