"""SentencePiece encoding and decoding: a lattice of joined substrings for each distinct word, folded by Viterbi."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import compress, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import Spans, chunks, encoded, slices, span_hashes
from sanitaria.llm.common import FLUSH_WORDS, TEXT_BATCHES, at_least, count_floor, settings, written

SPACE = "▁"
#: A code point that no text and no piece has; it takes the place of a literal SPACE in a text.
_NOT_SPACE = "￿"
#: Encoded words that every task knows, at most: about 10 MB.
HEAD = 1 << 19
#: Bytes of a word that the table of frequent words may hold; a longer one is folded whole where it is met.
LONGEST = 256
#: Letters of a long word whose edges are held at once.
BLOCK = 1 << 16
#: Bytes of rare words whose edges are held at once, about.
RARE = 1 << 17
#: Bits of a hash by which a substring that is no piece is told before the search.
MARKS = 22
#: What an unknown character costs beyond the worst piece.
UNKNOWN_COST = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` and ``scores`` by id; ``normal`` ids can stand in a text, ``bytes_from`` is the id of byte 0."""

    pieces: list[str]
    scores: list[float]
    normal: list[int]
    bytes_from: int | None
    unknown: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The vocabulary of a model file; the path is read by the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        other = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        normal = [i for i in ids if not other[i]]
        at = [i for i in ids if model.is_byte(i)]
        if at and (len(at) != 256 or at != list(range(at[0], at[0] + 256))):
            raise ValueError("byte pieces are not in a row")
        return cls(pieces, [model.get_score(i) for i in ids], normal, at[0] if at else None, model.unk_id())

    def __post_init__(self) -> None:
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in self.normal):
            raise ValueError("a piece goes on after a word's end")

    @property
    def longest(self) -> int:
        return max(len(self.pieces[i]) for i in self.normal)

    def breaks(self) -> np.ndarray:
        """ASCII characters that no longer piece contains: a piece always ends before and after them."""
        joined = {c for i in self.normal if len(self.pieces[i]) > 1 for c in self.pieces[i]}
        return np.array([code < 128 and code != 32 and chr(code) not in joined for code in range(256)])

    def table(self, spark: SparkSession) -> DataFrame:
        """The pieces that can stand in a text; an Arrow table, as rows would start Python workers of their own kind."""
        columns = {
            "piece": pa.array([self.pieces[i] for i in self.normal], pa.string()),
            "id": pa.array(self.normal, pa.int32()),
            "score": pa.array([self.scores[i] for i in self.normal], pa.float64()),
        }
        return spark.createDataFrame(pa.table(columns))

    def as_bytes(self) -> list[bytes]:
        """What each id stands for in a text."""
        found = [b""] * len(self.pieces)
        for i in self.normal:
            found[i] = self.pieces[i].replace(SPACE, " ").encode()
        if self.bytes_from is not None:
            for byte in range(256):
                found[self.bytes_from + byte] = bytes([byte])
        return found


class Units:
    """Words of some texts, each with the spaces before it; a text gets a space in front.

    The best path over a whole text is the best paths of its words one after the other, because
    no piece goes on after a word's end or across a break.  A word of more than ``LONGEST`` bytes is several
    units, which are ``long`` and only together have a best path; ``whole`` gives the end of such a word by its start.
    """

    def __init__(self, texts: Sequence[bytes], breaks: np.ndarray):
        spaced = [b" " + t if t else b"" for t in texts]
        self.raw = b"".join(spaced)
        self.data = data = np.frombuffer(self.raw, dtype=np.uint8)
        first = np.concatenate([[0], np.cumsum([len(t) for t in spaced])]).astype(np.int64)
        space, cut = data == 32, breaks[data]
        begins = cut.copy()
        begins[1:] |= cut[:-1] | (space[1:] & ~space[:-1])
        begins[first[:-1][first[:-1] < len(data)]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data)) if len(start) else start
        big = end - start > LONGEST
        self.whole = dict(zip(start[big].tolist(), end[big].tolist(), strict=True))
        if self.whole:
            before, after = start[big], end[big]
            start, end = self._parted(start, end)
            at = np.maximum(np.searchsorted(before, start, "right") - 1, 0)
            self.long = (start >= before[at]) & (start < after[at])
        else:
            self.long = np.zeros(len(start), dtype=bool)
        self.start, self.end = start, end
        self.unit = np.searchsorted(start, first)

    def _parted(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more = []
        for a, b in zip(start[end - start > LONGEST].tolist(), end[end - start > LONGEST].tolist(), strict=True):
            while b - a > LONGEST:
                a += LONGEST
                while self.data[a] & 0xC0 == 0x80:
                    a -= 1
                more.append(a)
        start = np.sort(np.concatenate([start, np.array(more, dtype=start.dtype)]))
        return start, np.append(start[1:], len(self.data))

    @property
    def hash(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def slices(self) -> list[bytes]:
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)]


def unit_counts(texts: DataFrame, breaks: np.ndarray) -> DataFrame:
    """``unit`` (string) and ``n`` of all texts but for long words, counted by tasks before they are shuffled."""

    def sent(counts: Counter[bytes]) -> pa.RecordBatch:
        columns = [pa.array(counts, pa.binary(), size=len(counts)), pa.array(counts.values(), pa.int64(), size=len(counts))]
        return pa.RecordBatch.from_arrays(columns, names=["unit", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for own in (part for batch in batches for part in slices(batch, 0)):
            units = Units([encoded(t) for t in own.column(0).to_pylist()], breaks)
            counts.update(compress(units.slices(), (~units.long).tolist()))
            if len(counts) >= FLUSH_WORDS:
                yield sent(counts)
                counts.clear()
        yield sent(counts)

    parts = texts.select("text").mapInArrow(run, "unit binary, n bigint")
    return parts.groupBy(F.col("unit").cast("string").alias("unit")).agg(F.sum("n").alias("n"))


def _path(unknown: str) -> str:
    """SQL of the best path: a fold over the edges by end, then one back along the pieces that were taken."""
    start = "CAST(shiftright(e.at, 32) & 4095 AS INT)"
    reached = f"element_at(best, {start} + 1).score + e.score"
    step = f"named_struct('score', {reached}, 'start', {start}, 'id', CAST(e.at & 4294967295 AS INT) - 1)"
    taken = "element_at(best, back.at + 1)"
    return f"""aggregate(
        array_sort(edges), array(named_struct('score', 0D, 'start', 0, 'id', 0)),
        (best, e) -> CASE WHEN size(best) = shiftright(e.at, 44) THEN concat(best, array({step}))
            WHEN {reached} > element_at(best, -1).score THEN concat(slice(best, 1, size(best) - 1), array({step}))
            ELSE best END,
        best -> aggregate(sequence(1, size(best) - 1), named_struct('at', size(best) - 1, 'ids', CAST(array() AS array<int>)),
            (back, k) -> if(back.at = 0, back, named_struct('at', {taken}.start, 'ids', concat(
                if({taken}.id >= 0, array({taken}.id), {unknown.format(at=f"{taken}.start")}), back.ids))),
            back -> back.ids))"""


def encoded_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``units`` with ``ids``, the pieces of the best path through each unit.

    Every substring up to the longest piece is a row, and the piece table, whose size is that of the vocabulary,
    is joined to it; a character without a piece of its own is an unknown edge.  Edges of a unit are
    grouped where the unit already is, and folded.  The best path has the highest sum
    of scores; of equal ones the one whose last piece begins first.
    """
    pieces = F.broadcast(vocabulary.table(units.sparkSession))
    worst = min(vocabulary.scores[i] for i in vocabulary.normal) - UNKNOWN_COST
    starts = units.select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), F.length("unit") - F.col("start")))
    spans = starts.select("unit", "start", F.explode(lengths).alias("length"))
    text = F.substring("unit", F.col("start") + 1, F.col("length"))
    keyed = spans.withColumn("piece", F.translate(text, " " + SPACE, SPACE + _NOT_SPACE))
    joined = keyed.join(pieces, "piece", "left").filter("id IS NOT NULL OR length = 1")
    # End, start and piece (0: unknown) in one number, which also is the order of the fold.
    place = F.shiftleft((F.col("start") + F.col("length")).cast("long"), 44) + F.shiftleft(F.col("start").cast("long"), 32)
    edge = F.struct((place + F.coalesce("id", F.lit(-1)) + 1).alias("at"), F.coalesce("score", F.lit(worst)).alias("score"))
    edges = joined.groupBy("unit").agg(F.collect_list(edge).alias("edges"))
    letter = "CAST(substring(unit, {at} + 1, 1) AS BINARY)"
    unknown = f"array({vocabulary.unknown})"
    if vocabulary.bytes_from is not None:
        unknown = (
            f"transform(sequence(1, octet_length({letter})), b -> {vocabulary.bytes_from} + "
            f"CAST(conv(hex(substring({letter}, b, 1)), 16, 10) AS INT))"
        )
    return edges.select("unit", F.expr(_path(unknown)).alias("ids"))


@dataclass(frozen=True)
class Head:
    """Frequent units: sorted hashes, where the pieces of each begin, and all pieces."""

    hashes: np.ndarray
    begin: np.ndarray
    ids: np.ndarray

    @classmethod
    def collect(cls, units: DataFrame) -> Head:
        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                raw = [u.encode("utf-8", "surrogatepass") for u in batch["unit"]]
                ends = np.cumsum([len(u) for u in raw])
                data = np.frombuffer(b"".join(raw), dtype=np.uint8)
                sizes = np.array([len(i) for i in batch["ids"]], dtype=np.int32)
                ids = np.concatenate([np.asarray(i, dtype=np.int32) for i in batch["ids"]]) if len(raw) else sizes
                hashes = span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
                yield pd.DataFrame({"h": [hashes.tobytes()], "s": [sizes.tobytes()], "i": [ids.tobytes()]})

        parts = units.select("unit", "ids").mapInPandas(pack, "h binary, s binary, i binary").collect()
        hashes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["h"], np.uint64) for r in parts)])
        sizes = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(r["s"], np.int32) for r in parts)])
        ids = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(r["i"], np.int32) for r in parts)])
        begin = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        order = np.argsort(hashes)
        sizes = sizes[order]
        at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        moved = np.repeat(begin[:-1][order] - at[:-1], sizes) + np.arange(at[-1])
        return cls(hashes[order], at, ids[moved])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 for those that are not here."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def pieces(self, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all units in a row, -1 for a unit that is not here; how many each has; which are not here."""
        at = np.where(units.long, -1, self.find(units.hash))
        sizes = np.where(at >= 0, self.begin[at + 1] - self.begin[np.maximum(at, 0)], 1) if len(self.hashes) else np.ones(len(at), int)
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        place = np.repeat(np.where(at >= 0, self.begin[np.maximum(at, 0)], -1), sizes)
        flat = np.full(len(place), -1, dtype=np.int32)
        flat[place >= 0] = self.ids[(place + within)[place >= 0]]
        return flat, sizes, np.flatnonzero(at < 0)


class Lattice:
    """The same lattice for a batch of rare words, in numpy: substrings, an equi-join by hash, edges, a fold by end."""

    def __init__(self, vocabulary: Vocabulary):
        texts = [vocabulary.pieces[i].replace(SPACE, " ").encode() for i in vocabulary.normal]
        ends = np.cumsum([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        hashes = span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(vocabulary.normal, dtype=np.int32)[order]
        self.scores = np.array([vocabulary.scores[i] for i in vocabulary.normal])[order]
        self.worst = self.scores.min() - UNKNOWN_COST
        #: Which first ``MARKS`` bits the hashes of pieces have: most substrings are no piece and need no search.
        self.marked = np.zeros(1 << MARKS, dtype=bool)
        self.marked[self.hashes >> np.uint64(64 - MARKS)] = True
        self.longest, self.bytes_from, self.unknown = vocabulary.longest, vocabulary.bytes_from, vocabulary.unknown

    def _find(self, hashes: np.ndarray, all_of: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which substrings are edges, and their ids and scores; ``all_of``: letters, which are edges without a piece too."""
        keep = np.flatnonzero(self.marked[hashes >> np.uint64(64 - MARKS)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[keep]), len(self.hashes) - 1)
        known = self.hashes[place] == hashes[keep]
        keep, place = keep[known], place[known]
        if not all_of:
            return keep, self.ids[place], self.scores[place]
        ids, scores = np.full(len(hashes), -1, dtype=np.int32), np.full(len(hashes), self.worst)
        ids[keep], scores[keep] = self.ids[place], self.scores[place]
        return np.arange(len(hashes)), ids, scores

    def encode(self, units: Sequence[bytes], block: int = RARE) -> list[list[int]]:
        """Best paths of the units; the edges of about ``block`` bytes of them are held at once."""
        return [path for a, b in chunks(units, block) for path in self._paths(units[a:b])]

    def _paths(self, units: Sequence[bytes]) -> list[list[int]]:
        data = np.frombuffer(b"".join(units), dtype=np.uint8)
        first = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
        letter = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        begin = np.searchsorted(letter, first)
        length = np.diff(begin)
        owner = np.repeat(np.arange(len(units), dtype=np.int32), length)
        at = (np.arange(len(owner)) - begin[owner]).astype(np.int32)
        found, spans, left = [], Spans(data), length[owner] - at
        for size in range(1, self.longest + 1):
            start = np.flatnonzero(left >= size)
            if not len(start):
                break
            keep, ids, scores = self._find(spans.hashes(letter[start], letter[start + size]), size == 1)
            start = start[keep]
            found.append((owner[start], at[start] + np.int32(size), at[start], ids, scores))
        unit, end, start, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        order = np.lexsort((start, unit, end))
        unit, end, start, ids, scores = (x[order] for x in (unit, end, start, ids, scores))
        widest = int(length.max()) + 1
        # The places of all units in a row, each with one more than it has letters.
        base = begin[:-1] + np.arange(len(units))
        best = np.zeros(len(owner) + len(units))
        back, piece = np.zeros(len(best), dtype=np.int32), np.zeros(len(best), dtype=np.int32)
        cuts = np.searchsorted(end, np.arange(1, widest + 1))
        for position in range(1, widest):
            a, b = cuts[position - 1], cuts[position]
            own = unit[a:b]
            total = best[base[own] + start[a:b]] + scores[a:b]
            group = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            top = np.maximum.reduceat(total, group)
            # Of equal paths the first one in the group, whose last piece begins first.
            hit = np.flatnonzero(total == np.repeat(top, np.diff(np.append(group, b - a))))
            hit = hit[np.unique(own[hit], return_index=True)[1]]
            place = base[own[hit]] + position
            best[place], back[place], piece[place] = total[hit], start[a:b][hit], ids[a:b][hit]
        out, taken, chosen = [], back.tolist(), piece.tolist()
        for k, (text, low) in enumerate(zip(units, base.tolist(), strict=True)):
            position, path = int(length[k]), []
            while position:
                before, found_id = taken[low + position], chosen[low + position]
                if found_id >= 0:
                    path.append(found_id)
                elif self.bytes_from is None:
                    path.append(self.unknown)
                else:
                    raw = text[letter[begin[k] + before] - first[k] : letter[begin[k] + position] - first[k]]
                    path += [self.bytes_from + byte for byte in reversed(raw)]
                position = before
            out.append(path[::-1])
        return out

    def encode_long(self, unit: bytes, block: int = BLOCK) -> list[int]:
        """The same path through one word of any length; the fold goes on from block to block of its letters."""
        data = np.frombuffer(unit, dtype=np.uint8)
        letter = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        count = len(letter) - 1
        size_of, piece = np.zeros(count + 1, dtype=np.int32), np.zeros(count + 1, dtype=np.int32)
        best = [0.0]  # scores of the places from ``low`` to ``done``
        for done in range(0, count, block):
            low, stop = max(0, done + 1 - self.longest), min(done + block, count)
            best = best[len(best) - 1 - (done - low) :]
            near, bound = data[letter[low] : letter[stop]], letter[low : stop + 1] - letter[low]
            found, spans = [], Spans(near)
            for size in range(1, min(self.longest, stop) + 1):
                start = np.arange(max(0, done + 1 - size), stop + 1 - size) - low
                keep, ids, scores = self._find(spans.hashes(bound[start], bound[start + size]), size == 1)
                start = start[keep]
                found.append((start + size, start, ids, scores))
            end, start, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((start, end))
            at, taken, chosen = -1, [], []
            for e, s, i, score in zip(*(x[order].tolist() for x in (end, start, ids, scores)), strict=True):
                total = best[s] + score
                if e != at:
                    at = e
                    best.append(total)
                    taken.append(e - s)
                    chosen.append(i)
                elif total > best[-1]:
                    best[-1], taken[-1], chosen[-1] = total, e - s, i
            size_of[done + 1 : stop + 1], piece[done + 1 : stop + 1] = taken, chosen
        position, path = count, []
        while position:
            before, found_id = position - int(size_of[position]), int(piece[position])
            if found_id >= 0:
                path.append(found_id)
            elif self.bytes_from is None:
                path.append(self.unknown)
            else:
                path += [self.bytes_from + byte for byte in reversed(unit[letter[before] : letter[position]])]
            position = before
        return path[::-1]


#: Distinct words that one task of the relational lattice takes, about.
TASK_UNITS = 16_384


def frequent_pieces(rows: DataFrame, vocabulary: Vocabulary, head: int = HEAD) -> Head:
    """Pieces of the at most ``head`` most frequent words of ``text``, by the relational lattice."""
    with settings(rows.sparkSession, TEXT_BATCHES):
        units = written(unit_counts(rows, vocabulary.breaks()), "piece-units")
    frequent = at_least(units, count_floor(units, head)).select("unit")
    tasks = max(1, -(-frequent.count() // TASK_UNITS))
    spark, setting = rows.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(setting)
    # A task holds few enough words to collect their edges by hash; beyond this number Spark would sort them.
    spark.conf.set(setting, 16 * TASK_UNITS)
    try:
        table = written(encoded_units(frequent.repartition(tasks, "unit"), vocabulary), "piece-table")
    finally:
        spark.conf.set(setting, before)
    return Head.collect(table)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", head: int = HEAD
) -> DataFrame:
    """``key, ids, n_pieces, decoded_crc32, round_trip`` of every document; other columns are ignored.

    Words are encoded once for the whole corpus by the relational lattice of ``encoded_units``, as far as
    they are among the ``head`` most frequent; that table goes to every task, its size is bounded.
    Rarer words, most of which stand in one document only, would have to be shuffled with
    all ids of their documents; their lattices are folded where they are met, to the same result.
    ``round_trip`` says that decoding the ids gives the text again, by its crc32.

    A null text counts as empty and has no pieces.  Words of more than 256 bytes are not counted among the
    frequent ones, but folded whole like the rare ones.  Repeated rows are encoded each; a null key stays null; an
    empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = frequent_pieces(rows, vocabulary, head)
    breaks, means, lattice = vocabulary.breaks(), vocabulary.as_bytes(), Lattice(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (part for batch in batches for part in slices(batch, 1)):
            texts = [encoded(t) for t in own.column(1).to_pylist()]
            flat, ends = _ids(Units(texts, breaks), known, lattice)
            crcs = [zlib.crc32(b"".join([means[i] for i in flat[a:b].tolist()])[1:]) for a, b in pairwise(ends.tolist())]
            columns = {
                "key": own.column(0),
                "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                "n_pieces": pa.array(np.diff(ends), pa.int64()),
                "decoded_crc32": pa.array(crcs, pa.int64()),
                "round_trip": pa.array([zlib.crc32(t) == c for t, c in zip(texts, crcs, strict=True)], pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, ids array<int>, n_pieces bigint, decoded_crc32 bigint, round_trip boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _ids(units: Units, known: Head, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts in a row, and where those of each begin and end: known words by the table, others by the lattice."""
    flat, sizes, missing = known.pieces(units)
    if len(missing):
        long, whole = units.long[missing].tolist(), units.whole
        starts, ends = units.start[missing].tolist(), units.end[missing].tolist()
        # The first part of a long word takes the path of the whole, the others are left empty.
        rare = [
            units.raw[a : whole.get(a, a) if is_long else b] for a, b, is_long in zip(starts, ends, long, strict=True)
        ]
        distinct = list(dict.fromkeys(u for u, is_long in zip(rare, long, strict=True) if not is_long))
        paths = dict(zip(distinct, lattice.encode(distinct), strict=True)) if distinct else {}
        for unit in dict.fromkeys(u for u, is_long in zip(rare, long, strict=True) if is_long):
            paths[unit] = lattice.encode_long(unit) if unit else []
        gaps = np.cumsum(sizes)[missing] - 1
        grown = np.ones(len(flat), dtype=np.int64)
        grown[gaps] = [len(paths[u]) for u in rare]
        place = np.cumsum(grown) - grown
        filled = np.empty(int(grown.sum()), dtype=np.int32)
        old = np.ones(len(flat), dtype=bool)
        old[gaps] = False
        filled[place[old]] = flat[old]
        for unit, at in zip(rare, place[gaps].tolist(), strict=True):
            filled[at : at + len(paths[unit])] = paths[unit]
        sizes = sizes.copy()
        sizes[missing] = grown[gaps]
        flat = filled
    return flat, np.concatenate([[0], np.cumsum(sizes)])[units.unit]


def decode(encodings: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``encodings`` with ``decoded``, the text of ``ids``; null ids give null, and a column of that name is replaced."""
    means = vocabulary.as_bytes()

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return column.map(
            lambda own: None if own is None else b"".join([means[i] for i in own])[1:].decode("utf-8", "replace")
        )

    return encodings.withColumn("decoded", text_of(F.col(ids)))
