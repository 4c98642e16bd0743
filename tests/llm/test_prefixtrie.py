"""The trie against plain dictionaries, and the slots of prefix digests."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sanitaria.llm import prefixtrie
from sanitaria.llm.prefixtrie import SlotTable, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, shard int, hi string, conv int, pos int, n int"


def plain(turns, family=20, most=4):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        whole = tuple(own.get(base, [])[:h] + said[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], set()).add(c)
        ends.setdefault(whole, []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, who in members.items():
        worth = (len(who) - 1) * len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += node not in children
    return sorted(
        (
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children.get(node, 0), leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def found(spark, turns):
    rows = spark.createDataFrame([(*t, 1, "x", 2, 3, 4) for t in turns], SCHEMA)
    return sorted(map(tuple, prefix_trie(rows.repartition(3)).collect()), key=lambda r: (r[0], r[1], r[3]))


def same(spark, turns):
    assert found(spark, turns) == sorted(plain(turns), key=lambda r: (r[0], r[1], r[3]))


def conversations(seed, n):
    draw = random.Random(seed)
    said = ["", None, "one", "two words", "a  b\tc\nd", "日本 über x", "{\"k\": [1]}"]
    rows = []
    for c in range(n):
        first = draw.choice([0, 0, 1])
        for t in range(draw.randrange(1, 7)):
            rows.append((c, t, draw.choice(["user", "assistant", None]) if t > 1 else "user", said[2 + first + t % 2] if t < 3 else draw.choice(said)))
    return rows


def test_against_dictionaries(spark):
    rows = conversations(1, 90)
    # Ties, null turns, repeated rows, ids without an own base, negative and large ids, rows without an id.
    rows += [(200, None, "user", "late"), (200, None, "user", "early"), (200, 3, None, None), (203, 1, "user", "x"), (203, 1, "user", "x")]
    rows += [(-7, 0, "user", "two words"), (-20, 0, "user", "b"), (2**40 + 1, 0, "user", "two words"), (None, 0, "user", "two words"), (None, 1, None, None)]
    same(spark, rows)


def test_hot_conversation(spark):
    same(spark, [(c, t, "user", f"turn {t} same") for c in range(60) for t in range(5)])


def test_long_conversations_span_shards(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SPAN", 4)
    draw = random.Random(3)
    rows = []
    for c in range(40):
        rows += [(c, t, "user", f"t{t} of" if t < 9 + c % 4 else f"own {c % 7} {t}") for t in range(draw.randrange(1, 30))]
    # Spans are cut in Python workers too: those read the module's own number, so the cut is checked here in the driver.
    prefix = prefixtrie.subtree_sums
    assert prefix.__globals__["SPAN"] == 4
    import pyspark.cloudpickle as cloudpickle

    cloudpickle.register_pickle_by_value(prefixtrie)
    try:
        same(spark, rows)
    finally:
        cloudpickle.unregister_pickle_by_value(prefixtrie)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5_000])
def test_slots_are_minimal_and_perfect(n):
    draw = np.random.default_rng(n)
    hi, lo = (draw.integers(0, 2**63, n, dtype=np.uint64) for _ in range(2))
    lo[: n // 2] = hi[: n // 2]
    table = SlotTable(hi, lo)
    assert sorted(table.slots(hi, lo).tolist()) == list(range(n))
    others = table.slots(hi + np.uint64(1), lo)
    assert (others == -1).all()


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError, match="repeat"):
        SlotTable(np.zeros(2, np.uint64), np.zeros(2, np.uint64))
