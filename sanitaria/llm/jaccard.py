"""Similarity join of documents by the Jaccard index of their word shingles, with grouped prefixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import ByteWords, encoded, mixed, slices
from sanitaria.llm.common import TEXT_BATCHES, Scratch, free_name, head_words, lower_words_of, settings, word_counts
from sanitaria.llm.components import connected_components

#: Words whose counts order the shingles; all rarer words count as equally rare.
HEAD = 131_072
#: Ids that are sent to every executor at most, to pick out texts; more are joined.
BROADCAST_IDS = 1_000_000
NULL_ID = -(2**63)
#: Shingles of texts that a verifying task keeps for the next pairs, about.
CACHED = 200_000


def shingle_sets(texts: Sequence[bytes], words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct shingles' hashes, and for each of these one hash for each of its words."""
    found = ByteWords([t.lower() for t in texts])
    h = found.hash
    out = []
    for i in range(len(texts)):
        own = h[found.word[i] : found.word[i + 1]]
        if not len(own):
            out.append((np.zeros(0, np.uint64), np.zeros((0, words), np.uint64)))
            continue
        size = min(words, len(own))
        rows = np.lib.stride_tricks.sliding_window_view(own, size)
        value = np.full(len(rows), size, dtype=np.uint64)
        for k in range(size):
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        value, first = np.unique(value, return_index=True)
        out.append((value, rows[first]))
    return out


def _signatures(value: np.ndarray) -> int:
    """64 more bits of a set's identity, beside its size and its smallest shingles."""
    with np.errstate(over="ignore"):
        return int(mixed(value * np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64).astype(np.int64))


#: 64-bit numbers of a set's parity bits; a power of two of them.
BITS = tuple(f"b{k}" for k in range(8))
#: Listed shingles before one of a group, by which a pair is known that met there already.
EARLIER = 4


def _parities(value: np.ndarray) -> list[int]:
    """For each of 512 classes of hashes whether the set has an odd number of them, as eight numbers."""
    classes = 64 * len(BITS)
    odd = np.bincount((value >> np.uint64(65 - classes.bit_length())).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def prefixes(docs: DataFrame, head: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """``id, n, sig, sig2, prefix`` and ``BITS``: of each document's shingles the rarest, enough to share one with any similar set.

    Shingles are ordered by the count of their rarest word, then by hash. A document of n
    shingles shares at least ``percent`` of them with a similar one, so one of its first
    ``n - ceil(percent * n) + 1`` is among the first ones of the other.
    """
    hashes, counts = head

    fields = {"n": pa.int32(), "sig": pa.int64(), "sig2": pa.int64(), "prefix": pa.list_(pa.int64())}
    fields |= {b: pa.int64() for b in BITS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in slices(batch, 1):
                rows = []
                for value, parts in shingle_sets([encoded(t) for t in own.column(1).to_pylist()], words):
                    n = len(value)
                    if not n:
                        rows.append((0, 0, 0, np.zeros(0, np.int64), *[0] * len(BITS)))
                        continue
                    if len(hashes):
                        at = np.minimum(np.searchsorted(hashes, parts), len(hashes) - 1)
                        rarity = np.where(hashes[at] == parts, counts[at], 0).min(axis=1)
                    else:
                        rarity = np.zeros(n, dtype=np.int64)
                    kept = n + (-n * percent // 100) + 1
                    order = np.lexsort((value, rarity))[:kept]
                    sig = int(mixed(value.copy()).sum(dtype=np.uint64).astype(np.int64))
                    rows.append((n, sig, _signatures(value), value[order].astype(np.int64), *_parities(value)))
                found = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), fields.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([own.column(0), *found], names=["id", *fields])

    bits = ", ".join(f"{b} bigint" for b in BITS)
    schema = f"id bigint, n int, sig bigint, sig2 bigint, prefix array<bigint>, {bits}"
    return docs.select("id", "text").mapInArrow(run, schema)


def _shingles(text: str, words: int) -> frozenset[tuple[bytes, ...]]:
    own = lower_words_of(text)
    if len(own) < words:
        return frozenset([tuple(own)] if own else [])
    return frozenset(zip(*(own[k:] for k in range(words)), strict=False))


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs ``a, b`` whose texts are similar, by their shingles themselves and not by hashes."""
    joined = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, frozenset] = {}
        held = 0
        for own in (part for batch in batches for part in slices(batch, 2)):
            keep = []
            for left, right in zip(own.column(2).to_pylist(), own.column(3).to_pylist(), strict=True):
                both = []
                for text in (left, right):
                    found = sets.get(text)
                    if found is None:
                        if held >= CACHED:
                            sets.clear()
                            held = 0
                        found = sets[text] = _shingles(text, words)
                        held += len(found)
                    both.append(found)
                x, y = both
                shared = len(x & y)
                keep.append(bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared))
            yield own.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a bigint, b bigint")


def _needed(n_a: Column, n_b: Column, percent: int) -> Column:
    """Shingles that two sets must share: the whole part of percent / (100 + percent) of both sizes, rounded up."""
    return F.ceil(F.lit(percent) * (n_a + n_b) / F.lit(100.0 + percent) - F.lit(1e-9))


def _may_link(percent: int) -> Column:
    """For ``n_a, at_a, n_b, at_b`` of a shared prefix shingle: sizes allow a link, and so do the places, were it the first."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    needed = _needed(n_a, n_b, percent)
    sizes = (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
    return sizes & (n_a - F.col("at_a") >= needed) & (n_b - F.col("at_b") >= needed)


def _bits_allow(percent: int) -> Column:
    """Two sets differ in at least as many shingles as they have parity bits that differ: not too many for a link."""
    differ = sum((F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b"))) for b in BITS), F.lit(0))
    return differ <= F.col("n_a") + F.col("n_b") - 2 * _needed(F.col("n_a"), F.col("n_b"), percent)


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of classes whose sizes and parity bits allow a link."""
    for side in ("a", "b"):
        facts = classes.select(F.col("rep").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", *BITS)))
        pairs = pairs.join(facts, side)
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.filter(sizes & _bits_allow(percent)).select("a", "b").distinct()


def _side(tokens: DataFrame, name: str) -> DataFrame:
    return tokens.select("token", *(F.col(c).alias(f"{c}_{name}") for c in tokens.columns if c != "token"))


def _with_earlier(listed: DataFrame) -> DataFrame:
    """``listed`` with ``earlier``: the ``EARLIER`` listed shingles that stand before ``token`` in its group.

    Groups are told apart by all that ``across`` asks of them, as groups of a repeated id bear one name.
    """
    before = Window.partitionBy("group", "n", "size", *BITS).orderBy("at").rowsBetween(-EARLIER, -1)
    return listed.withColumn("earlier", F.collect_list("token").over(before))


def across(listed: DataFrame, percent: int, all_links: bool) -> DataFrame:
    """``group_a, group_b`` of groups that share a listed shingle and may link, in different components unless ``all_links``.

    A pair that shares many shingles would be met at each of them.  It is left out where both have a common one among
    the ``EARLIER`` before: that one allows no less, as it stands further in front, so the pair is met there or before.
    """
    apart = ~((F.col("low_a") == F.col("high_a")) & (F.col("low_a") == F.col("low_b")) & (F.col("low_b") == F.col("high_b")))
    left, right = _side(listed, "a"), _side(listed, "b")
    # The bits of a group are its only member's; those of members of larger groups are looked at later.
    bits = (F.col("size_a") > 1) | (F.col("size_b") > 1) | _bits_allow(percent)
    ordered = F.col("group_a") < F.col("group_b")
    open_lists = F.lit(True) if all_links else apart
    met = F.arrays_overlap("earlier_a", "earlier_b")
    tried = ordered & open_lists & _may_link(percent) & bits & ~met
    return left.join(right, (left["token"] == right["token"]) & tried).select("group_a", "group_b")


def jaccard_join(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", all_links: bool = True,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``id, n_shingles, rep, links, component`` of every document, linked at ``percent`` or more.

    1. Documents with equal sets become one class; ``rep`` is its smallest id.
    2. Classes with the same size and the same prefix become one group, and only groups are indexed by
       their prefix shingles.
    3. In each list of the index every group is compared with one other, the one where the shingle
       stands first; within a group every member with the first one.  This takes pairs in
       proportion to the lists and finds most components, however many copies there are.
    4. What is left to compare are the other pairs of groups that share a shingle, and of members of one
       group: these are filtered by size, place and parity bits, met at their first common shingles only, expanded to
       members, and verified.  Nothing is capped: every pair that could be a link is tried.

    ``links`` therefore counts all other classes that a document's class is similar to, which takes work and rows in
    proportion to these links: with the square of a family of near copies.  Without ``all_links``
    step 4 leaves out pairs that already lie in one component; components are the same then, and ``links`` is
    not returned.  ``scratch`` holds the tables that the result still reads; all others are deleted on the way.

    Shingles are ``words`` words after A-Z became a-z; a shorter text is one shingle, and a text without
    words, empty or null has none and is linked with nothing.  The id is ``key``; rows with
    one id are one document with several texts.  A null id is kept as one.  Other columns are ignored, an
    empty table gives no rows.
    """
    with settings(docs.sparkSession, TEXT_BATCHES):
        return _join(docs, words, percent, key, text, all_links, scratch or Scratch())


def _join(
    docs: DataFrame, words: int, percent: int, key: str, text: str, all_links: bool, scratch: Scratch
) -> DataFrame:
    """``jaccard_join``; every job that sends texts to Python workers is written here."""
    written = scratch.written
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    counted = written(word_counts(rows), "jaccard-words")
    head = head_words(counted, HEAD)
    scratch.drop(counted)
    hashes = ByteWords([bytes(w) for w in head["word"]]).hash if len(head) else np.zeros(0, np.uint64)
    order = np.argsort(hashes)
    ranked = hashes[order], head["n"].to_numpy(dtype=np.int64)[order]
    sets = written(prefixes(rows, ranked, words, percent), "jaccard-sets")
    same = ["n", "sig", "sig2"]
    classes = sets.filter("n > 0").groupBy(*same).agg(
        F.min("id").alias("rep"), F.first("prefix").alias("prefix"), *(F.first(b).alias(b) for b in BITS)
    )
    full = written(classes, "jaccard-classes")
    # Prefixes are the bulk of these tables: what is read later on is kept without them.
    wide, sets = sets, written(sets.select("id", *same), "jaccard-ids")
    scratch.drop(wide)
    groups = full.groupBy("n", "prefix").agg(
        F.min("rep").alias("group"), F.count("*").alias("size"), *(F.first(b).alias(b) for b in BITS)
    )
    indexed = written(groups, "jaccard-groups")
    multi = indexed.filter("size > 1").select("n", "prefix", "group")
    members = full.select("n", "prefix", "rep")
    inside = written(members.join(multi, ["n", "prefix"]).select("group", "rep"), "jaccard-members")
    classes = written(full.drop("prefix"), "jaccard-class-facts")
    scratch.drop(full)
    tokens = indexed.select("n", "group", F.posexplode("prefix").alias("at", "token"))
    first = F.min(F.struct("at", "n", "group")).alias("pivot")
    lists = tokens.groupBy("token").agg(F.count("*").alias("shared"), first).filter("shared > 1").drop("shared")
    listed = written(tokens.join(lists, "token"), "jaccard-lists")

    grouped = written(indexed.drop("prefix"), "jaccard-group-facts")
    scratch.drop(indexed)
    star = (
        listed.select(
            F.col("pivot.group").alias("a"), F.col("group").alias("b"), F.col("pivot.n").alias("n_a"),
            F.col("pivot.at").alias("at_a"), F.col("n").alias("n_b"), F.col("at").alias("at_b"),
        )
        .filter((F.col("a") != F.col("b")) & _may_link(percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    within = inside.filter("rep <> group").select(F.col("group").alias("a"), F.col("rep").alias("b"))
    tried = written(_near(star.distinct().unionByName(within), classes, percent), "jaccard-tried")
    asked = listed.select(F.col("group").alias("id")).unionByName(inside.select(F.col("rep").alias("id"))).distinct()
    asked = written(asked, "jaccard-asked")
    few = asked.count() <= BROADCAST_IDS
    texts = written(rows.join(F.broadcast(asked) if few else asked, "id", "left_semi"), "jaccard-texts")
    links = written(verified(tried, texts, words, percent), "jaccard-links")
    labels = connected_components(links, scratch=scratch)

    # Without all links, only lists and groups that still hold several components have pairs to try.
    named = labels.select(F.col("node").alias("rep"), "component")
    of_members = inside.join(named, "rep", "left").select(
        "group", "rep", F.coalesce("component", "rep").alias("component")
    )
    spans = of_members.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    single = labels.select(F.col("node").alias("group"), F.col("component").alias("own"))
    own = F.coalesce("own", "group")
    placed = (
        listed.drop("pivot")
        .join(single, "group", "left")
        .join(spans, "group", "left")
        .join(grouped.select("group", "size", *BITS), "group")
        .select(
            "token", "n", "at", "group", "size", *BITS,
            F.coalesce("low", own).alias("low"), F.coalesce("high", own).alias("high"),
        )
    )
    placed = written(_with_earlier(placed), "jaccard-placed")
    scratch.drop(listed, asked)
    mixed_lists = placed.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l <> h")
    rest = placed if all_links else placed.join(mixed_lists.select("token"), "token", "left_semi")
    open_groups = spans if all_links else spans.filter("low <> high")
    pairs = across(rest, percent, all_links).unionByName(
        open_groups.select(F.col("group").alias("group_a"), F.col("group").alias("group_b"))
    ).distinct()
    alone = single.select("group", F.col("group").alias("rep"), F.col("own").alias("component"))
    pairs = written(pairs, "jaccard-pairs")
    expanded = _expanded(pairs, of_members, alone, across=not all_links)
    open_pairs = _near(expanded.join(tried, ["a", "b"], "left_anti"), classes, percent)
    more = written(verified(open_pairs, texts, words, percent), "jaccard-more")
    scratch.drop(tried, texts, placed, pairs, inside, grouped)
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = connected_components(links, scratch=scratch)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    ids = sets.select("id", "n", "sig", "sig2")
    reps = classes.select(*same, "rep")
    per_class = (
        reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select(*same, "rep", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    degrees = [F.coalesce("links", F.lit(0)).cast("long").alias("links")] if all_links else []
    return ids.join(per_class, same, "left").select(
        _id("id"), F.col("n").cast("long").alias("n_shingles"), _id(F.coalesce("rep", "id"), "rep"),
        *degrees, _id(F.coalesce("component", "id"), "component"),
    )


def _id(value: Column | str, name: str = "id") -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column != NULL_ID, column).alias(name)


def _expanded(pairs: DataFrame, members: DataFrame, singles: DataFrame, across: bool) -> DataFrame:
    """Pairs of groups to pairs of their members, ``across`` components only; a group without others is its own member."""
    named = members.select("group", "rep", F.col("component"))
    for side in ("a", "b"):
        own = named.select(F.col("group").alias(f"group_{side}"), F.col("rep").alias(f"r_{side}"), F.col("component").alias(f"c_{side}"))
        lone = singles.select(F.col("group").alias(f"group_{side}"), F.col("component").alias(f"s_{side}"))
        pairs = pairs.join(own, f"group_{side}", "left").join(lone, f"group_{side}", "left")
    for side in ("a", "b"):
        group = F.col(f"group_{side}")
        pairs = pairs.withColumn(f"c_{side}", F.coalesce(f"c_{side}", f"s_{side}", group)).withColumn(f"r_{side}", F.coalesce(f"r_{side}", group))
    kept = pairs.filter((F.col("c_a") != F.col("c_b")) if across else (F.col("r_a") != F.col("r_b")))
    return kept.select(F.least("r_a", "r_b").alias("a"), F.greatest("r_a", "r_b").alias("b")).distinct()


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component of ``jaccard_join``: the one with the smallest ``key``, nulls last.

    Rows are told apart by where they stand, so rows with a null or a repeated key are rows of their own, and
    of repeated rows one stays.  Texts without words are linked with nothing and all stay.
    """
    scratch, row = Scratch(), free_name(docs, "row_id")
    rows = scratch.written(docs.withColumn(row, F.monotonically_increasing_id()), "jaccard-rows")
    with Scratch(sweep=True) as inner:
        found = jaccard_join(rows.select(row, "text"), words, percent, key=row, all_links=False, scratch=inner)
        found = found.select(F.col("id").alias(row), "component")
        keyed = inner.written(rows.select(row, F.col(key).alias("key")).join(found, row), "jaccard-keyed")
        best = keyed.groupBy("component").agg(
            F.min(F.struct(F.col("key").isNull().alias("none"), "key", row)).alias("best"), F.count("*").alias("n")
        )
        many = best.filter("n > 1").select("component", F.col(f"best.{row}").alias("stays"))
        gone = keyed.join(many, "component").filter(F.col(row) != F.col("stays")).select(row)
        gone = scratch.written(gone, "jaccard-gone")
    few = gone.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*docs.columns)
