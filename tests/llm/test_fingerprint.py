import hashlib
import math
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from sanitaria.llm import fingerprint as fp
from tests.llm.data import documents, prose, texts


def brute_bins(text: bytes):
    out = []
    for i in range(len(text) - fp.WINDOW + 1):
        n = Counter(text[i : i + fp.WINDOW])
        whole = sum(round(v * math.log2(v) * 65536) for v in n.values())
        bits = math.log2(fp.WINDOW) - whole / (fp.WINDOW * 65536.0)
        out.append(int(min(max(bits * (fp.STEPS / math.log2(fp.WINDOW)), 0), fp.STEPS)))
    return out


def brute_features(text: bytes, rank):
    ranks = [rank[b] for b in brute_bins(text)]
    picked = Counter()
    for first in range(-fp.WINDOW + 1, len(ranks)):
        near = [(ranks[k], k) for k in range(max(first, 0), min(first + fp.WINDOW, len(ranks))) if ranks[k] < fp._OUT]
        if near:
            picked[min(near)[1]] += 1
    return sorted(k for k, n in picked.items() if n >= fp.POPULAR)


def test_entropy_and_features_against_brute_force():
    samples = [prose(k, 10 + 15 * k).encode() for k in range(6)] + [b"", b"ab", b"a" * 200, bytes(range(256)) * 2]
    expected = Counter(b for t in samples for b in brute_bins(t))
    counts = fp.entropy_counts(samples)
    assert {k: int(v) for k, v in enumerate(counts) if v} == dict(expected)
    rank = fp.ranks(counts)
    for text, digest in zip(samples, fp.digests(samples, rank), strict=True):
        distinct = len({text[k : k + fp.WINDOW] for k in brute_features(text, rank)}) or int(bool(text))
        assert len(digest) == -(-distinct // fp.PER_FILTER)
        bits = int(np.bitwise_count(digest).sum()) if len(digest) else 0
        assert (bits > 0) == bool(text) and bits <= fp.HASHES * distinct
        assert np.array_equal(digest, fp.digests([text], rank)[0])


def test_likeness():
    rank = fp.ranks(fp.entropy_counts([prose(k, 900).encode() for k in range(5)]))
    a, b, none = *fp.digests([prose(1, 4_000).encode(), prose(2, 4_000).encode()], rank), fp.digests([b""], rank)[0]
    assert fp.likeness(a, a) == 1.0 and fp.likeness(a, b) < 0.3 and len(a) > 1
    assert fp.likeness(none, none) == 1.0 and fp.likeness(a, none) == 0.0


def test_edits_against_plain_code(spark):
    rows = [(k, t) for k, t in texts() if k is not None]
    distinct = list({k: (k, t) for k, t in rows}.values())
    got = {r["doc_id"]: r for r in fp.fingerprint_edits(documents(spark, distinct), block_bytes=2_000).collect()}
    order = sorted((k, t or "") for k, t in distinct)
    assert set(got) == {k for k, _ in order}
    for (k, text), (other, after) in zip(order, [*order[1:], order[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[k]["n_chars"] == len(text)
        assert got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0.0 <= got[k]["near_edited"] <= 1.0 and 0.0 <= got[k]["near_next"] <= 1.0
        if (text == after) or got[k]["fingerprint"] == got[other]["fingerprint"]:
            assert got[k]["near_next"] == 1.0
    prints = {}
    for k, text in order:
        assert prints.setdefault(text, got[k]["fingerprint"]) == got[k]["fingerprint"]
    assert np.mean([r["near_edited"] for r in got.values()]) > np.mean([r["near_next"] for r in got.values()]) + 0.2


def test_rows_with_null_and_repeated_ids_and_empty_table(spark):
    assert fp.fingerprint_edits(documents(spark)).count() == len(texts())
    assert fp.fingerprint_edits(documents(spark, [])).count() == 0
    one = fp.fingerprint_edits(documents(spark, [(5, "alone " * 30)])).first()
    assert one["near_next"] == 1.0


def test_likeness_in_blocks_is_the_same(monkeypatch):
    rank = fp.ranks(fp.entropy_counts([prose(k, 900).encode() for k in range(5)]))
    a, b = fp.digests([prose(1, 9_000).encode(), (prose(1, 3_000) + prose(2, 7_000)).encode()], rank)
    assert len(a) > 5
    whole = fp.likeness(a, b)
    for size in (256, 5 * 256, 40 * 256):
        monkeypatch.setattr(fp, "PAIR_BYTES", size)
        assert fp.likeness(a, b) == whole


def test_one_key_of_many_rows_is_cut_into_blocks(spark):
    rows = [(7, f"{k} " * 40) for k in range(300)] + [(None, f"n{k} " * 40) for k in range(300)] + [(9, "last " * 40)]
    docs = documents(spark, rows)
    keyed = docs.selectExpr("coalesce(doc_id, -9223372036854775808) as key", "text").withColumn("hash", F.xxhash64("text"))
    sizes = [r["count"] for r in fp._blocks(keyed, 2_000, 4_096).where("ahead = 0").groupBy("block").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 60 and sum(sizes) == len(rows)
    assert fp._blocks(keyed, 2_000, 4_096).where("ahead = 1").count() == len(sizes)
    # The next document goes by key, then by the hash of the text, whatever the blocks are.
    order = [r.text for r in keyed.orderBy("key", "hash").collect()]
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    want = {}
    for text in order:
        half = len(text) // 2
        want[hashlib.sha256((text[: len(text) - half] + after[text][:half]).encode()).hexdigest()] = text
    got = fp.fingerprint_edits(docs, block_bytes=2_000).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(want)
