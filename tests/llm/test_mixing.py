import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sanitaria.llm.mixing import fly, fly_and_land, land, mix_sources, mixed_documents
from tests.llm.data import documents, texts


def test_flight_keeps_totals_and_leaves_two():
    draw = random.Random(1)
    for n in (0, 1, 2, 3, 50, 400):
        size = [draw.randrange(0, 30) for _ in range(n)]
        p = [draw.random() for _ in range(n)]
        flown = fly(p, size, random.Random(n))
        assert sum(1 for x in flown if x not in (0.0, 1.0)) <= 2
        assert sum(flown) == pytest.approx(sum(p))
        assert sum(x * s for x, s in zip(flown, size, strict=True)) == pytest.approx(
            sum(x * s for x, s in zip(p, size, strict=True))
        )


def test_flight_keeps_expectations():
    p, size = [0.2, 0.5, 0.7, 0.4, 0.9], [3, 8, 1, 5, 2]
    taken = [0.0] * 5
    for seed in range(4_000):
        for k, x in enumerate(fly(p, size, random.Random(seed))):
            taken[k] += x
    assert all(abs(t / 4_000 - x) < 0.03 for t, x in zip(taken, p, strict=True))


def test_landing_is_the_nearest_rounding():
    assert land([0.5, 1.0, 0.5], [10, 3, 4]) in ([0.0, 1.0, 1.0], [1.0, 1.0, 0.0])
    assert land([], []) == []
    landed = fly_and_land([0.5] * 40, list(range(40)), random.Random(2))
    assert set(landed) <= {0.0, 1.0} and abs(sum(k * x for k, x in enumerate(landed)) - 390) <= 1


def expected_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, target, open_sources = 1.5 * sum(sizes.values()), {}, set(order)
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_sources}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_sources -= full
    return target


@pytest.mark.parametrize("block", [4, 4_096])
def test_mix(spark, block):
    docs = documents(spark)
    rows = mix_sources(docs, block=block).collect()
    assert len(rows) == len(texts())
    words = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts())
    assert sorted(r["size"] for r in rows) == words
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    targets = expected_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(r["size"] for r in rows if r["source"] == source) / 2
    again = mix_sources(docs.repartition(5), block=block).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_capped_sources(spark):
    rows = [(k, "w " * (10 if k % 3 else 1)) for k in range(90)]
    mixed = mix_sources(documents(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in mixed:
        sizes[r["source"]] += r["size"]
    for source, target in expected_targets(dict(sizes)).items():
        assert all(r["target"] == pytest.approx(target) for r in mixed if r["source"] == source)


def test_mixed_rows_repeat(spark):
    docs = documents(spark)
    mixed = mixed_documents(docs)
    assert mixed.schema == docs.schema
    before, after = Counter(map(repr, docs.collect())), Counter(map(repr, mixed.collect()))
    assert set(after) <= set(before) and all(n <= 2 * before[row] for row, n in after.items())


def test_empty_table(spark):
    assert mix_sources(documents(spark, [])).count() == 0
    assert mixed_documents(documents(spark, [])).count() == 0


def test_one_key_for_all_rows_flies_in_blocks(spark):
    rows = [(None if k % 2 else 5, "one two three") for k in range(3_000)]
    plan = mix_sources(documents(spark, rows).withColumn("source", F.lit("s")), block=256).collect()
    assert len(plan) == 3_000 and sum(r["taken"] for r in plan) == 13_500
