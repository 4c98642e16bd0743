import random

import pytest

from sanitaria.llm import common, jaccard
from sanitaria.llm.components import connected_components
from sanitaria.llm.jaccard import jaccard_join, one_of_each
from tests.llm.data import documents, prose, texts


def roots(nodes, links):
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    draw = random.Random(4)
    links = [(k, k + 1) for k in range(200, 260)] + [(500, 500 + k) for k in range(40)]
    links += [(draw.randrange(100), draw.randrange(100)) for _ in range(70)] + [(7, 7), (7, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = roots({n for pair in links for n in pair}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in found} == {n: expected[n] for n in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, words):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(None)
    own = [w for w in own if w]
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + words]) for k in range(len(own) - words + 1)}


def brute(rows, words, percent):
    sets = [(k, shingles(t, words)) for k, t in rows]
    links = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and 100 * len(x & y) >= percent * len(x | y)
    ]
    return roots({k for k, _ in sets}, links), {k: len(s) for k, s in sets}


def families():
    """Near copies of one text with few to many edits, copies of each other's copies, and unrelated texts."""
    draw = random.Random(8)
    base, rows = prose(1, 150).split(), []
    for k in range(70):
        own = list(base)
        for _ in range(k % 9):
            own[draw.randrange(len(own))] = f"edit{draw.randrange(30)}"
        rows.append(" ".join(own))
    drift = prose(2, 120).split()
    for k in range(25):
        drift[draw.randrange(len(drift))] = f"drift{k}"
        rows.append(" ".join(drift))
    rows += [prose(200 + k, 60) for k in range(30)] + [rows[3], rows[3].upper(), rows[40]]
    return [(3 * k + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 100)])
def test_against_all_pairs(spark, words, percent):
    rows = [*families(), *((1_000 + k, t) for k, t in enumerate(dict.fromkeys(t for _, t in texts())))]
    expected, sizes = brute(rows, words, percent)
    got = jaccard_join(documents(spark, rows), words, percent).collect()
    assert {r["id"]: r["component"] for r in got} == expected
    assert {r["id"]: r["n_shingles"] for r in got} == sizes


def all_link_counts(rows, words, percent):
    """For each id how many other distinct sets are similar to its own."""
    sets = {k: frozenset(shingles(t, words)) for k, t in rows}
    distinct = set(sets.values())
    linked = {
        x: sum(y != x and bool(x) and 100 * len(x & y) >= percent * len(x | y) for y in distinct) for x in distinct
    }
    return {k: linked[x] for k, x in sets.items()}


def test_links_are_all_links(spark):
    rows, words, percent = families(), 3, 80
    expected = all_link_counts(rows, words, percent)
    assert max(expected.values()) > 10
    got = jaccard_join(documents(spark, rows), words, percent).collect()
    assert {r["id"]: r["links"] for r in got} == expected
    fewer = jaccard_join(documents(spark, rows), words, percent, all_links=False)
    assert "links" not in fewer.columns
    assert {r["id"]: r["component"] for r in fewer.collect()} == {r["id"]: r["component"] for r in got}


def test_nulls_repeats_and_stage(spark):
    docs = documents(spark)
    got = jaccard_join(docs).collect()
    assert len(got) == len(texts()) and sum(r["id"] is None for r in got) == 2
    kept = one_of_each(docs)
    assert kept.schema == docs.schema
    held = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sum(t == prose(3, 41) for _, t in held) == 1 and (3, prose(3, 41)) in held
    assert held.count((70, prose(70, 80))) == 1 and (30, "") in held and (31, None) in held and (None, None) in held
    assert sum(k is not None and 40 <= k < 45 for k, _ in held) == 1
    assert jaccard_join(documents(spark, [])).count() == 0 and one_of_each(documents(spark, [])).count() == 0


def test_texts_go_to_workers_in_small_batches(spark):
    names, seen = list(common.TEXT_BATCHES), []
    before = [spark.conf.get(n, None) for n in names]

    class Seen(common.Scratch):
        def written(self, df, purpose):
            seen.append([spark.conf.get(n) for n in names])
            return super().written(df, purpose)

    rows = documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y"), (4, None)])
    found = jaccard_join(rows, words=3, percent=90, all_links=False, scratch=Seen())
    assert {(r["id"], r["component"]) for r in found.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}
    assert seen and all(s == list(common.TEXT_BATCHES.values()) for s in seen)
    assert [spark.conf.get(n, None) for n in names] == before
    assert int(common.TEXT_BATCHES[names[1]]) < 8 << 20


def met(listed, percent, all_links):
    """Every meeting of two groups in a list that size, place and parity bits allow: one for each shared shingle."""
    found = []
    for x in listed:
        for y in listed:
            if x["token"] != y["token"] or x["group"] >= y["group"]:
                continue
            needed = -(-percent * (x["n"] + y["n"]) // (100 + percent))
            differ = sum(((x[b] ^ y[b]) & (2**64 - 1)).bit_count() for b in jaccard.BITS)
            one = x["low"] == x["high"] == y["low"] == y["high"]
            sizes = 100 * min(x["n"], y["n"]) >= percent * max(x["n"], y["n"])
            places = min(x["n"] - x["at"], y["n"] - y["at"]) >= needed
            bits = max(x["size"], y["size"]) > 1 or differ <= x["n"] + y["n"] - 2 * needed
            if sizes and places and bits and (all_links or not one):
                found.append((x["group"], y["group"]))
    return found


@pytest.mark.parametrize("repeated", [False, True])
def test_pairs_meet_at_their_first_common_shingles(spark, repeated):
    class Kept(common.Scratch):
        def written(self, df, purpose):
            table = super().written(df, purpose)
            if purpose == "jaccard-placed":
                listed.extend(r.asDict() for r in table.collect())
                counts.extend([[tuple(r) for r in jaccard.across(table, 80, every).collect()] for every in (True, False)])
            return table

    listed, counts = [], []
    rows = families()
    if repeated:  # ids with several texts
        rows += [(rows[k][0], rows[k + 9][1] + " more") for k in range(0, 60, 4)]
    got = jaccard_join(documents(spark, rows), 5, 80, all_links=False, scratch=Kept()).collect()
    every = met(listed, 80, True)
    assert len(every) > 4 * len(set(every)) and set(counts[0]) == set(every)
    assert set(counts[1]) == set(met(listed, 80, False))
    if not repeated:
        assert len(counts[0]) < 2 * len(set(every))
        assert {r["id"]: r["component"] for r in got} == brute(rows, 5, 80)[0]
