"""Alignment of two tokenizers over the same bytes: Arrow kernels inside tasks, counts merged by Spark."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import chunks, encoded
from sanitaria.llm.common import written

#: Bytes of text whose id pairs are counted together; one longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Bytes of text that are tokenized and joined at once.
SLICE_BYTES = 1 << 19


def _byte_letters() -> dict[str, int]:
    """Byte-level letters: printable bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(other)}


@dataclass(frozen=True)
class Coders:
    """The two tokenizers' files: A byte-level BPE (JSON), B pieces with byte fallback."""

    a: bytes
    b: bytes

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Coders:
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())


class _Loaded:
    """Encoders, the bytes of every id as Arrow binary, and ids as text behind each separator."""

    def __init__(self, coders: Coders):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(coders.a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=coders.b)
        letters, a_bytes = _byte_letters(), [b""] * self.a.get_vocab_size()
        for token, at in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            a_bytes[at] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.ids = max(len(a_bytes), len(b_bytes))
        self.printed = pa.array([f"{sign}{i}" for sign in ",;|" for i in range(self.ids)])


@lru_cache(maxsize=2)
def _loaded(coders: Coders) -> _Loaded:
    return _Loaded(coders)


@dataclass
class Aligned:
    """Of some texts: tokens of each, links of each, the ids of all links in order, and each text's groups, as a hash and as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    sha: list[str]
    groups: list[str | None]


def _int32(lists: Sequence[Sequence[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, lists), np.int32, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(flat))


def _sums(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


class _Side:
    """One tokenizer's tokens of all texts: ids, the text each stands in, and the byte where it ends in that text."""

    def __init__(self, lists: Sequence[Sequence[int]], meaning: pa.Array, wanted: Sequence[bytes]):
        tokens = _int32(lists)
        ids, parent = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
        means = meaning.take(ids)
        ends = pc.cumulative_sum(pc.binary_length(means).cast(pa.int64()))
        first = _sums(np.diff(tokens.offsets.to_numpy()))
        reach = np.concatenate([[0], ends.to_numpy()])
        joined = means.buffers()[2].to_pybytes()[: reach[-1]] if len(means) else b""
        #: Texts whose tokens' bytes are the text's bytes.
        self.same = np.array([joined[reach[x] : reach[y]] == w for x, y, w in zip(first[:-1], first[1:], wanted, strict=True)])
        self.ids, self.parent = ids, parent
        # Segmented: what was summed up before a text began is taken off.
        self.end = pc.subtract(ends, pc.take(pa.array(reach[first[:-1]]), parent))

    def keep(self, good: np.ndarray, name: str) -> pa.Table:
        table = pa.table({"doc": self.parent, "end": self.end, name: self.ids})
        table = table.filter(pc.take(pa.array(good), self.parent)) if not good.all() else table
        return table.append_column(f"at_{name}", pa.array(np.arange(table.num_rows)))


def _places(tokens: pa.Table) -> np.ndarray:
    """Text and end of each token as one number."""
    return (tokens["doc"].to_numpy().astype(np.int64) << 32) | tokens["end"].to_numpy()


def align_texts(texts: Sequence[bytes], coders: Coders, print_groups: bool = False) -> Aligned:
    """Tokens of both tokenizers cut into groups at the bytes where both end, for texts that both give back byte for byte."""
    own = _loaded(coders)
    n = len(texts)
    said = [t.decode("utf-8", "replace") for t in texts]
    some = [i for i in range(n) if said[i]]
    a_lists: list[Sequence[int]] = [()] * n
    b_lists: list[Sequence[int]] = [()] * n
    for i, e in zip(some, own.a.encode_batch_fast([" " + said[i] for i in some], add_special_tokens=False), strict=True):
        a_lists[i] = e.ids
    for i, ids in zip(some, own.b.encode([said[i] for i in some], num_threads=1), strict=True):
        b_lists[i] = ids
    wanted = [b" " + t if t else b"" for t in texts]
    sides = _Side(a_lists, own.a_bytes, wanted), _Side(b_lists, own.b_bytes, wanted)
    good = sides[0].same & sides[1].same
    a, b = (side.keep(good, name) for side, name in zip(sides, "ab", strict=True))
    # Joined on (text, end) as one number; a token without bytes may end where another does, so then pairs are listed.
    doc_a, key_a, key_b = a["doc"].to_numpy(), *(_places(x) for x in (a, b))
    if (np.diff(key_a) > 0).all() and (np.diff(key_b) > 0).all():
        met = pc.index_in(pa.array(key_a), value_set=pa.array(key_b))
        at_a = np.flatnonzero(met.is_valid().to_numpy(zero_copy_only=False))
        at_b = met.drop_null().to_numpy().astype(np.int64)
    else:
        joined = a.join(b, ["doc", "end"], join_type="inner", use_threads=False).sort_by("at_a")
        at_a, at_b = joined["at_a"].to_numpy(), joined["at_b"].to_numpy()
    doc, link_a, link_b = doc_a[at_a], a["a"].to_numpy()[at_a], b["b"].to_numpy()[at_b]
    # Groups: up to each link; every text ends with one, so groups never reach over two texts.
    size_a, size_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    of_a, of_b = np.repeat(np.arange(len(doc)), size_a), np.repeat(np.arange(len(doc)), size_b)
    sign_a, sign_b = np.zeros(a.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
    sign_a[at_a - size_a + 1], sign_b[at_b - size_b + 1] = 1, 2
    order = np.empty(a.num_rows + b.num_rows, np.int64)
    order[np.arange(a.num_rows) + (at_b - size_b + 1)[of_a]] = sign_a * own.ids + a["a"].to_numpy()
    order[np.arange(b.num_rows) + (at_a + 1)[of_b]] = sign_b * own.ids + b["b"].to_numpy()
    printed = own.printed.take(pa.array(order))
    line = printed.buffers()[2].to_pybytes() if len(printed) else b""
    n_a, n_b = np.bincount(a["doc"].to_numpy(), minlength=n), np.bincount(b["doc"].to_numpy(), minlength=n)
    edge = np.frombuffer(printed.buffers()[1], np.int32)[_sums(n_a + n_b)] if len(printed) else np.zeros(n + 1, np.int64)
    groups = [line[x + 1 : y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    sha = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
    said = [g.decode() if print_groups else None for g in groups]
    return Aligned(n_a, n_b, np.bincount(doc, minlength=n), link_a, link_b, sha, said)


@dataclass(frozen=True)
class Alignment:
    """``documents``: one row of each input row.  ``pairs``: ``a, b, n, best`` of every pair of ids linked anywhere."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, coders: Coders, key: str = "doc_id", text: str = "text", groups: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> Alignment:
    """How the tokens of A and B fall together in every text, and how often each pair of ids does in all of them.

    A reads a space and the text, B the text (and puts the space before it itself).  Where both end a token at one
    byte, the two tokens are linked and a group of tokens ends.  ``documents`` has ``key, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256`` and with ``groups`` also that text: ``n_best`` counts links whose
    pair is the most frequent one of its B id (ties count), ``count_sum`` sums the pairs' counts over the links.

    1. Each task tokenizes and joins a megabyte at a time; of about ``chunk_bytes`` of text it counts the id
       pairs, and writes its documents with numbers into that list of pairs, and the list.
    2. Spark merges the lists' counts, joins the sums back to the lists, and each chunk's documents look theirs up.
       What is shuffled are distinct pairs of chunks and one number a link; a pair that stands in every text is one
       row of a chunk, so no key grows with its occurrences.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and
    an empty ``groups_sha256``.  Repeated rows are rows of their own and count each; a null key stays null; other
    columns are ignored; an empty table gives no rows.  Memory is bounded by the chunk, or by one longer text.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    out = pa.schema([
        ("chunk", pa.int64()), ("key", pa.null()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("sha", pa.string()),
        ("groups", pa.string()), ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            links = np.concatenate([(x.link_a.astype(np.int64) << 32) | x.link_b for _, x in held])
            found = pa.table({"pair": links}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            pairs = found["pair"].combine_chunks()
            number = pc.index_in(pa.array(links), value_set=pairs).cast(pa.int32())
            edges = _sums(np.concatenate([x.n_links for _, x in held])).astype(np.int32)
            sha = [s for _, x in held for s in x.sha]
            n = len(sha)
            keys = pa.concat_arrays([k for k, _ in held])
            columns = [
                pa.array(np.full(n, chunk)), keys, pa.array(np.concatenate([x.n_a for _, x in held])),
                pa.array(np.concatenate([x.n_b for _, x in held])),
                pa.array(sha, pa.string()), pa.array([g for _, x in held for g in x.groups], pa.string()),
                pa.ListArray.from_arrays(edges, number), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())),
            ]
            schema = out.set(1, pa.field("key", keys.type))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            listed = [pairs, found["count_all"].combine_chunks()]
            one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in listed]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), *(pa.nulls(1, f.type) for f in list(schema)[1:-2]), *one], schema=schema
            )

        for batch in batches:
            texts = [encoded(t) for t in batch.column(1).to_pylist()]
            for x, y in chunks(texts, SLICE_BYTES):
                held.append((batch.column(0).slice(x, y - x), align_texts(texts[x:y], coders, groups)))
                size += sum(map(len, texts[x:y]))
                if size >= chunk_bytes:
                    yield from flush()
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield from flush()

    schema = (
        f"chunk bigint, key {kind}, n_a bigint, n_b bigint, sha string, groups string, links array<int>, "
        "pairs array<bigint>, counts array<bigint>"
    )
    cut = written(rows.mapInArrow(run, schema), "align-chunks")
    lists = cut.filter("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "x"))
    lists = lists.select("chunk", "at", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    b_of = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    sums = written(lists.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    # One row of each B id, so no more than its vocabulary holds.
    best = sums.groupBy(b_of.alias("b")).agg(F.max("n").alias("most"))
    known = sums.join(F.broadcast(best), b_of == F.col("b")).select(
        "pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best")
    )
    found = lists.join(known, "pair").select(F.col("chunk").alias("of"), "at", "total", "best")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["at"].to_numpy()
        total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy()
        links = left["links"].combine_chunks()
        flat, sizes = pc.list_flatten(links).to_numpy(), pc.list_value_length(links).to_numpy()
        edge = _sums(sizes)
        each = lambda v: pa.array(np.diff(_sums(v[flat])[edge]))
        n = pa.array(sizes.astype(np.int64))
        columns = [left["key"], left["n_a"], left["n_b"], n, n, each(best), each(total), left["sha"], left["groups"]]
        return pa.table(columns, names=names)

    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    kinds = [kind, *["bigint"] * 6, "string", "string"]
    texts = cut.filter("pairs IS NULL").drop("pairs", "counts")
    scored = texts.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(
        score, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    )
    kept = names if groups else names[:-1]
    documents = scored.select(*kept).withColumnRenamed("key", key)
    return Alignment(documents, known.select(
        F.shiftright("pair", 32).cast("int").alias("a"), b_of.cast("int").alias("b"), F.col("total").alias("n"), "best"
    ))
