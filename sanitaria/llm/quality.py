"""Quality rules: a hashed n-gram logistic regression, calibrated, beside fixed counting rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.llm.bytewords import ByteWords, encoded, slices
from sanitaria.llm.common import TEXT_BATCHES, settings

#: Hash slots of word features (single words and pairs) and of character features (three bytes).
WORD_SLOTS = CHAR_SLOTS = 1 << 13
SLOTS = WORD_SLOTS + CHAR_SLOTS
#: Labelled rows of each class that the model is fitted on, at most: those with the lowest hash of their id.
SAMPLE = 1_024
#: Every FOLD-th of them is held out from the fit and used to calibrate.
FOLD = 5
#: The verdict: documents with at least this probability of good quality stay.
THRESHOLD = 0.5
#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOLS = frozenset(b"#*$%&|<>")
_SYMBOL_TABLE = np.isin(np.arange(256), list(_SYMBOLS))
_SCALE = np.float64(30.0)


def _slots(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of feature: its slots, and where each text's begin and end."""
    words = ByteWords(texts)
    h = words.hash
    yield (h & np.uint64(WORD_SLOTS - 1)).astype(np.int32), words.word[:-1], words.word[1:]
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> np.uint64(51)
    begin = np.minimum(words.word[:-1], len(pair))
    yield pair.astype(np.int32), begin, np.maximum(words.word[1:] - 1, begin)
    x = words.data.astype(np.uint32)
    chars = ((x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(19)
    begin = np.minimum(words.first[:-1], len(chars))
    yield chars.astype(np.int32) + WORD_SLOTS, begin, np.maximum(words.first[1:] - 3, begin)


def vectors(texts: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text: the share of each slot among the features of its kind."""
    kinds = list(_slots(texts))
    out = []
    for i in range(len(texts)):
        total = np.zeros(SLOTS)
        for slot, begin, end in kinds:
            if end[i] > begin[i]:
                total += np.bincount(slot[begin[i] : end[i]], minlength=SLOTS) / (end[i] - begin[i])
        at = np.flatnonzero(total)
        out.append((at.astype(np.int32), total[at].astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    """Weights by slot, bias, and the slope and offset that turn scores into probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for slot, begin, end in _slots(texts):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[slot])])
            total += _SCALE * (sums[end] - sums[begin]) / np.maximum(end - begin, 1)
        return total

    def probabilities(self, texts: Sequence[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.scores(texts) + self.offset, -40, 40)))


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray]], good: Sequence[int], steps: int = 150, decay: float = 1e-4) -> Model:
    """Logistic regression by full-batch Adam on all but the held-out rows, then Platt scaling on those."""
    y = np.asarray(good, dtype=float)
    if len(set(good)) < 2:
        return Model(np.zeros(SLOTS), 0.0, 0.0, 40.0 if not len(y) or y[0] else -40.0)
    held = np.arange(len(y)) % FOLD == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), dtype=bool)

    def packed(mask: np.ndarray):
        kept = [r for r, m in zip(rows, mask, strict=True) if m]
        slot = np.concatenate([s for s, _ in kept])
        value = np.concatenate([v for _, v in kept]) * _SCALE
        return slot, value, np.repeat(np.arange(len(kept)), [len(s) for s, _ in kept]), len(kept)

    def linear(pack, w, b):
        slot, value, row, n = pack
        return np.bincount(row, value * w[slot], minlength=n) + b

    pack, target = packed(~held), y[~held]
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean())) / len(target)
    w, b = np.zeros(SLOTS), 0.0
    m, v = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, steps + 1):
        slope = (1 / (1 + np.exp(-np.clip(linear(pack, w, b), -40, 40))) - target) * weight
        grad = np.append(np.bincount(pack[0], pack[1] * slope[pack[2]], minlength=SLOTS) + decay * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    check = held if held.any() else ~held
    score, label = linear(packed(check), w, b), y[check]
    # Platt: targets drawn in a little, so that separable rows do not ask for an infinite slope.
    wanted = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    share = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    # A weak pull to slope 1 and offset 0 keeps the steps bounded; classes weigh alike, as in the fit.
    slope, offset, pull = 1.0, 0.0, 0.01 * len(score)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * score + offset, -40, 40)))
        d, q = share * (p - wanted), share * p * (1 - p)
        g = np.array([(d * score).sum() + pull * (slope - 1), d.sum() + pull * offset])
        hessian = np.array([[(q * score * score).sum(), (q * score).sum()], [(q * score).sum(), q.sum()]])
        change = np.clip(np.linalg.solve(hessian + pull * np.eye(2), g), -1.0, 1.0)
        slope, offset = slope - change[0], offset - change[1]
        if np.abs(change).max() < 1e-8:
            break
    return Model(w.astype(np.float64), float(b), float(slope), float(offset))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` labelled documents of each class.

    Texts stay on the executors; the driver gets at most ``2 * sample`` hashed vectors of
    ``SLOTS`` entries at most: of several rows with one id the smallest vector, chosen where the rows are.  Rows
    with a null label or id are no labels; no labels at all give a model that rejects nothing.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    chosen = [
        usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)
    ]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")

    def vectorise(batches):
        import pyarrow as pa

        for own in (part for batch in batches for part in slices(batch, 2)):
            found = vectors([encoded(t) for t in own.column(2).to_pylist()])
            packed = [pa.array([x.tobytes() for x in column], pa.binary()) for column in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*own.columns[:2], *packed], names=["doc_id", "quality", "slots", "shares"])

    schema = "doc_id bigint, quality int, slots binary, shares binary"
    found = rows.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text").mapInArrow(vectorise, schema)
    one = F.min(F.struct("slots", "shares")).alias("vector")
    found = found.groupBy("doc_id", "quality").agg(one).select("doc_id", "quality", "vector.*")
    with settings(docs.sparkSession, TEXT_BATCHES):
        found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "slots").collect()
    pairs = [(np.frombuffer(r["slots"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in found]
    return fit(pairs, [r["quality"] for r in found])


def counts(text: bytes) -> tuple[int, int, int, int]:
    """Code points in words, symbols, repeated lines with a word, words in repeated 3-word windows."""
    words = text.split()
    letters = len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = int(_SYMBOL_TABLE[np.frombuffer(text, np.uint8)].sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        reach = 0
        for at, window in enumerate(windows):
            if often[window] > 1:
                repeated += at + 3 - max(at, reach)
                reach = at + 3
    return letters, symbols, len(lines) - len(set(lines)), repeated


def quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base rules, probability and verdict of each document.

    Returns the columns of ``docs`` and ``quality_words, quality_word_chars,
    quality_symbols, quality_dup_lines, quality_repeat_words, quality_base_failed,
    quality_probability, quality_kept``; input columns of these names are replaced.
    A null text counts as empty and fails.  Texts are read whole, in Arrow batches;
    every row is judged by itself, so repeated rows, ties and any order change nothing.
    """
    names = "words word_chars symbols dup_lines repeat_words base_failed probability kept".split()
    names = [f"quality_{n}" for n in names]
    plain = docs.drop(*names)
    kinds = ["long"] * 5 + ["boolean", "double", "boolean"]
    schema = T.StructType(list(plain.schema.fields))
    for name, kind in zip(names, kinds, strict=True):
        schema = schema.add(name, kind)
    at = plain.columns.index("text")

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            for own in slices(batch, at):
                part = [encoded(t) for t in own.column(at).to_pylist()]
                probability = model.probabilities(part)
                rows = np.array([(len(t.split()), *counts(t)) for t in part], dtype=np.int64)
                failed = (rows[:, 0] < MIN_WORDS) | (100 * rows[:, 4] > MAX_REPEAT_PERCENT * rows[:, 0])
                kept = ~failed & (probability >= threshold)
                more = [pa.array(rows[:, k]) for k in range(5)] + [pa.array(failed), pa.array(probability), pa.array(kept)]
                yield pa.RecordBatch.from_arrays([*own.columns, *more], names=[*own.schema.names, *names])

    return plain.mapInArrow(judge, schema)


def good_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their columns as they are.

    A null or empty text has no words and goes; repeated rows are judged each; an empty table stays empty.
    """
    at = docs.columns.index("text")

    def judge(batches):
        import pyarrow as pa

        for own in (part for batch in batches for part in slices(batch, at)):
            kept: list[bool] = []
            texts = [encoded(t) for t in own.column(at).to_pylist()]
            for text, probability in zip(texts, model.probabilities(texts), strict=True):
                n = len(text.split())
                passed = n >= MIN_WORDS and probability >= threshold
                kept.append(bool(passed and 100 * counts(text)[3] <= MAX_REPEAT_PERCENT * n))
            yield own.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
