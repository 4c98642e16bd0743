"""Similarity digests of documents from their improbable byte windows."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import chunks, encoded, mixed

#: Bytes of a feature, and features among which one is picked.
WINDOW = 64
#: Of the windows around it, so many have to pick a feature.
POPULAR = 16
#: Bits of a filter, features in one before the next is chained, bits a feature sets.
FILTER_BITS, PER_FILTER, HASHES = 2_048, 160, 5
#: Entropy steps; below LOWEST a window is a run of few bytes and no feature.
STEPS, LOWEST = 1_000, 100
#: Overlap below this part of the possible is taken for chance.
CUTOFF = 0.3
#: Bytes of filter pairs that are compared at once.
PAIR_BYTES = 4 << 20
_OUT = 1 << 20
_N = np.arange(WINDOW + 1)
#: n log2 n in whole numbers, so that sums do not depend on their order.
_NLOG = np.round(_N * np.log2(np.maximum(_N, 1)) * (1 << 16)).astype(np.int64)
_STEP = np.diff(_NLOG, prepend=0)


def _laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with a window's length of zeros before and after each; their first bytes and lengths."""
    gap = bytes(WINDOW)
    data = np.frombuffer(gap + gap.join(texts) + gap * 2, dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    return data, WINDOW + np.concatenate([[0], np.cumsum(lengths + WINDOW)[:-1]]).astype(np.int64), lengths


def _entropy_bins(data: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Entropy step of the window that starts at each byte; -1 where it does not lie within one text.

    Sliding a window by one byte changes two counts. Both follow from how often a byte occurs
    in the window that ends, or starts, with it.
    """
    n = len(data)
    back, ahead = np.ones(n, dtype=np.uint8), np.ones(n, dtype=np.uint8)
    for shift in range(1, WINDOW):
        same = (data[shift:] == data[:-shift]).view(np.uint8)
        back[shift:] += same
        ahead[:-shift] += same
    moves = _STEP[back[WINDOW:]] - _STEP[ahead[:-WINDOW]]
    total = np.concatenate([[0], np.cumsum(moves)]) + _NLOG[np.bincount(data[:WINDOW], minlength=256)].sum()
    bits = np.log2(WINDOW) - total / float(WINDOW << 16)
    bins = np.full(n, -1, dtype=np.int64)
    bins[: len(bits)] = np.clip(bits * (STEPS / np.log2(WINDOW)), 0, STEPS).astype(np.int64)
    edges = np.zeros(n + 1, dtype=np.int64)
    some = lengths >= WINDOW
    np.add.at(edges, first[some], 1)
    np.add.at(edges, first[some] + lengths[some] - WINDOW + 1, -1)
    bins[np.cumsum(edges[:-1]) == 0] = -1
    return bins


def entropy_counts(texts: Sequence[bytes]) -> np.ndarray:
    """How many windows of the texts have each entropy step."""
    counts = np.zeros(STEPS + 1, dtype=np.int64)
    for a, b in chunks(texts):
        bins = _entropy_bins(*_laid_out(texts[a:b]))
        counts += np.bincount(bins[bins >= 0], minlength=STEPS + 1)
    return counts


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy step, the rarest first; low-entropy steps are out."""
    rank = np.empty(STEPS + 1, dtype=np.int64)
    rank[np.lexsort((np.arange(STEPS + 1), counts))] = np.arange(STEPS + 1)
    rank[:LOWEST] = _OUT
    return rank


def digests(texts: Sequence[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Chained Bloom filters of each text, as rows of bytes; none for an empty text."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        out += _digests(texts[a:b], rank)
    return out


def _digests(texts: Sequence[bytes], rank: np.ndarray) -> list[np.ndarray]:
    data, first, lengths = _laid_out(texts)
    bins = _entropy_bins(data, first, lengths)
    key = np.where(bins >= 0, rank[bins], _OUT) << 40 | np.arange(len(data))
    lowest = key
    for shift in (1, 2, 4, 8, 16, 32):
        lowest = np.minimum(lowest[:-shift], lowest[shift:])
    lowest = lowest[lowest >> 40 < _OUT] & ((1 << 40) - 1)
    picked = np.flatnonzero(np.bincount(lowest, minlength=1) >= POPULAR)
    views = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
    owner = np.searchsorted(first, picked, side="right") - 1
    value = np.zeros(len(picked), dtype=np.uint64)
    for eight in np.ascontiguousarray(views[picked]).view(np.uint64).T:
        value = mixed((value ^ eight) * np.uint64(0x9E3779B97F4A7C15))
    # A text without a feature is one as a whole.
    bare = np.setdiff1d(np.flatnonzero(lengths > 0), owner)
    whole = [int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little") for i in bare]
    owner = np.concatenate([owner, bare]).astype(np.int64)
    value = np.concatenate([value, np.array(whole, dtype=np.uint64)])
    _, kept = np.unique(np.stack([owner.astype(np.uint64), value]), axis=1, return_index=True)
    kept = np.sort(kept)
    kept = kept[np.argsort(owner[kept], kind="stable")]
    owner, value = owner[kept], value[kept]
    count = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(count)])
    filters = -(-count // PER_FILTER)
    base = np.concatenate([[0], np.cumsum(filters)])
    row = base[owner] + (np.arange(len(owner)) - begin[owner]) // PER_FILTER
    bits = np.zeros((int(base[-1]), FILTER_BITS), dtype=bool)
    for k in range(HASHES):
        bits[row, ((value >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[base[i] : base[i + 1]] for i in range(len(texts))]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of two digests, 0 to 1: for each filter of the shorter its best overlap with one of the other.

    Overlap is what two filters share beyond chance, of what they could; filters weigh by
    their bits.  Two empty digests are alike, an empty and another one are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    bits_a, bits_b = (np.bitwise_count(x).sum(axis=1).astype(float) for x in (a, b))
    best = np.zeros(len(a))
    side = max(1, math.isqrt(PAIR_BYTES // (FILTER_BITS // 8)))
    for i in range(0, len(a), side):
        for j in range(0, len(b), side):
            own, other = bits_a[i : i + side], bits_b[j : j + side]
            shared = np.bitwise_count(a[i : i + side, None, :] & b[None, j : j + side, :]).sum(axis=2).astype(float)
            chance = np.outer(own, other) / FILTER_BITS
            most = np.minimum(own[:, None], other[None, :])
            score = np.where(most > chance, (shared - chance) / np.maximum(most - chance, 1e-9), shared == most)
            best[i : i + side] = np.maximum(best[i : i + side], score.max(axis=1))
    best[best < CUTOFF] = 0.0
    return float(np.clip((best * bits_a).sum() / bits_a.sum(), 0.0, 1.0))


def to_text(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


def corpus_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks from the windows of all texts; tasks send one row of counts for each entropy step."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(STEPS + 1, dtype=np.int64)
        for batch in batches:
            counts += entropy_counts([encoded(t) for t in batch["text"]])
        yield pd.DataFrame({"step": np.arange(STEPS + 1), "n": counts})

    rows = docs.select(F.col(text).alias("text")).mapInPandas(count, "step int, n bigint")
    counts = np.zeros(STEPS + 1, dtype=np.int64)
    for step, n in rows.groupBy("step").agg(F.sum("n")).collect():
        counts[step] = n
    return ranks(counts)


def _cuts(docs: DataFrame, block_bytes: int, most_blocks: int) -> list[tuple[int, int]]:
    """``key, hash`` of the first document of each block; a key of many rows gives several blocks, cut by hash."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, min(most_blocks, -(-size // block_bytes)))
    points = F.array(*(F.lit(i / n) for i in range(n)))
    found = Counter(docs.agg(F.percentile_approx("key", points, F.lit(100 * n)).alias("cuts")).first()[0] or [0])
    cut = [(key, -(2**63) + (i << 64) // parts) for key, parts in sorted(found.items()) for i in range(parts)]
    rough = F.size(F.filter(_places(cut), lambda c: c <= _place())) - 1
    first = docs.groupBy(rough.alias("block")).agg(F.min(_place()).alias("first")).collect()  # at most one row a block
    return sorted((r["first"]["key"], r["first"]["hash"]) for r in first) or [(0, 0)]


def _place() -> Column:
    return F.struct("key", "hash")


def _places(cuts: list[tuple[int, int]]) -> Column:
    keys, hashes = (F.array(*(F.lit(c[i]).cast("long") for c in cuts)) for i in (0, 1))
    pair = F.arrays_zip(keys.alias("key"), hashes.alias("hash"))
    return pair.cast("array<struct<key:bigint,hash:bigint>>")


def _blocks(docs: DataFrame, block_bytes: int, most_blocks: int) -> DataFrame:
    """``key, hash, text, block, ahead``: ranges of keys, and of each range's first document a copy for the range before."""
    starts = _cuts(docs, block_bytes, most_blocks)
    cuts = _places(starts)
    block = F.size(F.filter(cuts, lambda c: c <= _place())) - 1
    first = F.array_contains(cuts, _place())
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("ahead"))
    before = F.struct(F.pmod(F.col("block") - 1, F.lit(len(starts))).alias("block"), F.lit(1).alias("ahead"))
    places = F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))).alias("place")
    return docs.withColumn("block", block).select("key", "hash", "text", places).select("key", "hash", "text", "place.*")


def fingerprint_edits(
    docs: DataFrame, rank: np.ndarray | None = None, block_bytes: int = 4 << 20, most_blocks: int = 4_096
) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses.

    The edited text has its last half (rounded down, in code points) replaced by as much
    of the start of the next document by ``doc_id``; the last one's next is the first.
    Documents are dealt out in ranges of keys, and of text hashes within a key of many rows, of about
    ``block_bytes`` and read as sorted streams; of each range the first document is also sent to the range before, so texts
    are shuffled once.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``; other columns are ignored.  A null text is empty: its
    fingerprint is the empty string.  A null ``doc_id`` comes first; rows with one
    ``doc_id`` follow each other by the hash of their text.  A single document is its own
    next.  An empty table gives no rows.
    """
    rank = corpus_ranks(docs) if rank is None else rank
    empty = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), empty.alias("text"))
    keyed = keyed.withColumn("hash", F.xxhash64("text"))
    placed = _blocks(keyed, block_bytes, most_blocks)
    ordered = (
        placed.repartition("block")
        .sortWithinPartitions("block", "ahead", "key", "hash")
        .select("block", "ahead", "key", "text")
    )

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, str, str]]:
        held = None
        for batch in batches:
            for block, ahead, key, text in batch.itertuples(index=False, name=None):
                if held is not None and held[0] == block:
                    yield held[1], held[2], text
                held = None if ahead else (block, key, text)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list[tuple[int, str, str]] = []
        held = 0
        for pair in pairs(batches):
            group.append(pair)
            held += len(pair[1])
            if held >= 1 << 19:
                yield _scored(group, rank)
                group, held = [], 0
        if group:
            yield _scored(group, rank)

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return ordered.mapInPandas(digest, schema)


def _scored(group: list[tuple[int, str, str]], rank: np.ndarray) -> pd.DataFrame:
    edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for _, t, after in group]
    place: dict[str, int] = {}
    for text in (*(x for _, t, after in group for x in (t, after)), *edited):
        place.setdefault(text, len(place))
    found = digests([encoded(t) for t in place], rank)
    rows = []
    for (key, text, after), changed in zip(group, edited, strict=True):
        own, new, other = found[place[text]], found[place[changed]], found[place[after]]
        rows.append((
            None if key == -(2**63) else key, len(text), hashlib.sha256(encoded(changed)).hexdigest(),
            to_text(own), to_text(new), likeness(own, new), likeness(own, other),
        ))
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
