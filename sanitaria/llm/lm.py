"""Log-bilinear language model over word classes: counted in Spark, trained with noise contrast, scored in batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import chunks
from sanitaria.llm.common import head_words, lower_words_of, word_counts, written

#: Words that every task knows with their counts; other words are looked up by a join.
HEAD = 131_072
#: Classes: the end of a text, SINGLES frequent words each by itself, and other words by their last two bytes.
SINGLES, SUFFIXES = 111, 48
CLASSES = 1 + SINGLES + SUFFIXES
BEGIN = CLASSES
#: Coarse classes of the word before the last: the end and the most frequent words, the others together.
COARSE = 9
CONTEXTS = COARSE * (CLASSES + 1)
#: Length of the word vectors, and noise samples for each word of the text.
DIMENSION, NOISE = 24, 8
#: Characters of text that a task works on at once.
PART = 1 << 20
ALPHA = 0.1


def suffix_class(word: bytes) -> int:
    return 1 + SINGLES + zlib.crc32(word[-2:]) % SUFFIXES


def _coarse(classes: np.ndarray) -> np.ndarray:
    """0..6 for the most frequent words, 7 for all others, 8 for the beginning of a text."""
    return np.where(classes == BEGIN, COARSE - 1, np.where((classes >= 1) & (classes < COARSE - 1), classes - 1, COARSE - 2))


@dataclass(frozen=True)
class Classes:
    """Classes of the head words and how to find those of others."""

    of: dict[bytes, int]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.of.get
        return np.array([get(w) or suffix_class(w) for w in words], dtype=np.int64)


def contexts(classes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The context of each token: the two classes before it, in texts that begin at ``begin``."""
    one = np.concatenate([[BEGIN], classes[:-1]])
    one[begin] = BEGIN
    two = np.concatenate([[BEGIN], one[:-1]])
    two[begin] = BEGIN
    return _coarse(two) * (CLASSES + 1) + one


def _tokens(texts, find) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words of some texts, classes of all tokens, where each text begins, and which tokens are words."""
    split = [lower_words_of(t) for t in texts]
    lengths = np.array([len(w) for w in split], dtype=np.int64)
    words = [w for own in split for w in own]
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64) if len(split) else np.zeros(0, int)
    classes = np.zeros(len(words) + len(split), dtype=np.int64)
    is_word = np.ones(len(classes), dtype=bool)
    is_word[begin + lengths] = False
    classes[is_word] = find(words)
    return words, classes, begin, is_word


@dataclass(frozen=True)
class LogBilinear:
    """Vectors of the context classes by position, vectors and biases of the classes to predict."""

    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def log10(self) -> np.ndarray:
        """Normalised log10 probabilities of each class in each context, by one product of matrices."""
        predicted = (self.far[:, None, :] + self.near[None, :, :]).reshape(CONTEXTS, DIMENSION)
        score = predicted @ self.target.T + self.bias
        score -= score.max(axis=1, keepdims=True)
        return (score - np.log(np.exp(score).sum(axis=1, keepdims=True))) / np.log(10)


def fit(seen: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-6, seed: int = 5) -> LogBilinear:
    """Noise-contrastive estimation from ``seen[context, class]``, the counts of the whole corpus.

    The task is to tell the corpus from ``NOISE`` times as much noise drawn from the class
    frequencies.  Counts hold all that the objective needs of the corpus, and its expectation over
    the noise is taken over all classes instead of samples, so a step is two products of matrices and
    the result is the same each time.
    """
    draw = np.random.default_rng(seed)
    total = max(float(seen.sum()), 1.0)
    frequency = (seen.sum(axis=0) + ALPHA) / (seen.sum() + ALPHA * CLASSES)
    data, noise = seen / total, (seen.sum(axis=1, keepdims=True) / total) * (NOISE * frequency)[None, :]
    shapes = {"near": (CLASSES + 1, DIMENSION), "far": (COARSE, DIMENSION), "target": (CLASSES, DIMENSION)}
    value = {name: 0.1 * draw.standard_normal(shape) for name, shape in shapes.items()} | {"bias": np.log(frequency)}
    first = {name: np.zeros_like(v) for name, v in value.items()}
    second = {name: np.zeros_like(v) for name, v in value.items()}
    offset = np.log(NOISE * frequency)
    for step in range(1, steps + 1):
        predicted = (value["far"][:, None, :] + value["near"][None, :, :]).reshape(CONTEXTS, DIMENSION)
        odds = predicted @ value["target"].T + value["bias"] - offset
        real = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        slope = noise * real - data * (1 - real)
        back = (slope @ value["target"]).reshape(COARSE, CLASSES + 1, DIMENSION)
        grads = {
            "near": back.sum(axis=0), "far": back.sum(axis=1),
            "target": slope.T @ predicted, "bias": slope.sum(axis=0),
        }
        pace = rate * min(1.0, 4 * (1 - step / (steps + 1)))
        for name, grad in grads.items():
            grad = grad + decay * value[name] if name != "bias" else grad
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.01 * (grad * grad - second[name])
            value[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-12)
    return LogBilinear(**value)


@dataclass(frozen=True)
class Corpus:
    """What is gathered from the training texts: word counts (a table) and their totals."""

    counts: DataFrame
    head: dict[bytes, int]
    texts: int
    tokens: int
    distinct: int


def gather(texts: DataFrame, limit: int = HEAD) -> Corpus:
    """Counts of all words of ``text``; the ``limit`` most frequent ones also as a dictionary."""
    counts = written(word_counts(texts), "lm-counts")
    n_texts = texts.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    head = head_words(counts, limit)
    known = {bytes(w): int(n) for w, n in zip(head["word"], head["n"], strict=True)}
    return Corpus(counts, known, n_texts, int(sums["n"] or 0) + n_texts, int(sums["v"]) + bool(n_texts))


def class_table(corpus: Corpus) -> tuple[Classes, np.ndarray, np.ndarray]:
    """Classes of the head words; tokens and distinct words of each class."""
    singles = list(corpus.head)[:SINGLES]
    of = {word: suffix_class(word) for word in corpus.head} | {word: 1 + k for k, word in enumerate(singles)}
    by_suffix = (F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(SUFFIXES)) + 1 + SINGLES).cast("int")
    sums = corpus.counts.groupBy(by_suffix.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n, v = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
    for row in sums:
        n[row["class"]], v[row["class"]] = row["n"], row["v"]
    for word in singles:
        n[suffix_class(word)] -= corpus.head[word]
        v[suffix_class(word)] -= 1
    return Classes(of), n, v


def count_classes(texts: DataFrame, classes: Classes) -> np.ndarray:
    """How often each class follows each context in all texts; tasks send the cells they have seen."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(CONTEXTS * CLASSES, dtype=np.int64)
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks(texts, PART):
                _, found, begin, _ = _tokens(texts[a:b], classes.numbers)
                seen += np.bincount(contexts(found, begin) * CLASSES + found, minlength=len(seen))
        cells = np.flatnonzero(seen)
        yield pd.DataFrame({"cell": cells.astype(np.int32), "n": seen[cells]})

    rows = texts.select("text").mapInPandas(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # at most CONTEXTS * CLASSES rows of 12 bytes
    seen = np.zeros(CONTEXTS * CLASSES)
    seen[found["cell"].to_numpy(dtype=np.int64)] = found["n"]
    return seen.reshape(CONTEXTS, CLASSES)


def train_and_score(
    docs: DataFrame, folds: int = 10, key: str = "doc_id", text: str = "text", limit: int = HEAD
) -> DataFrame:
    """Log10 probabilities of all texts under a model of those that are not held out.

    A word's probability is that of its class after the two words before it, times its share of the
    class.  The first comes from the log-bilinear model; a frequent word is a class of its own. The
    second is ``(c + 0.1) / (N + 0.1 (V + 1))`` in the counts of its class, so that the words of a
    class and one that was never seen sum to 1.  The base score does the same without classes.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per
    input row; other columns are ignored.  Held out are ids whose crc32 as text is 0 modulo
    ``folds``; a null id counts as the empty text.  A null text is empty: one token, the end.  Repeated
    rows count and are scored each.  With no training texts all words are unknown.

    Words beyond the ``limit`` most frequent ones are sent to the table of counts by a join, so
    no task holds a vocabulary that grows with the corpus.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), held.alias("held_out"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    training = rows.filter("NOT held_out").select("text")
    corpus = gather(training, limit)
    classes, n, v = class_table(corpus)
    table = fit(count_classes(training, classes)).log10()
    inside = np.log10(n + ALPHA * (v + 1))
    everything = np.log10(corpus.tokens + ALPHA * (corpus.distinct + 1))
    share = {
        word: (classes.of[word], np.log10(c + ALPHA) - everything, 0.0 if classes.of[word] <= SINGLES else np.log10(c + ALPHA) - inside[classes.of[word]])
        for word, c in corpus.head.items()
    }
    place = {word: at for at, word in enumerate(share)}
    # A last row stands for words that are not in the head.
    packed = np.array([*share.values(), (0, 0.0, 0.0)], dtype=float)
    of, base_of, share_of = packed[:, 0].astype(np.int64), packed[:, 1], packed[:, 2]
    end = np.log10(corpus.texts + ALPHA) - everything
    known_end = int(corpus.texts > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = place.get
        for batch in (whole.iloc[a:b] for whole in batches for a, b in chunks(whole["text"].tolist(), PART)):
            at = None

            def find(words: list[bytes]) -> np.ndarray:
                nonlocal at
                at = np.array([get(w, -1) for w in words], dtype=np.int64)
                found = of[at]
                for k in np.flatnonzero(at < 0):
                    found[k] = suffix_class(words[k])
                return found

            words, found, begin, is_word = _tokens(batch["text"], find)
            base, score = np.full(len(found), end), np.zeros(len(found))
            base[is_word], score[is_word] = base_of[at], share_of[at]
            score += table[contexts(found, begin), found]
            owner = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(found))))
            tail = np.flatnonzero(at < 0)
            tails: list[list[bytes]] = [[] for _ in begin]
            for k, text in zip(tail, owner[is_word][tail], strict=True):
                tails[text].append(words[k])
            known = np.bincount(owner[is_word], at >= 0, minlength=len(begin)).astype(np.int64) + known_end
            yield pd.DataFrame({
                "uid": batch["uid"].to_numpy(), "doc_id": batch["doc_id"].astype("Int64").array,
                "held_out": batch["held_out"].to_numpy(),
                "n_tokens": np.bincount(owner, minlength=len(begin)), "n_known": known,
                "base_score": np.bincount(owner, base, minlength=len(begin)),
                "score": np.bincount(owner, score, minlength=len(begin)), "tail": tails,
            })

    schema = (
        "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
        "score double, tail array<binary>"
    )
    scored = written(rows.withColumn("uid", F.monotonically_increasing_id()).mapInPandas(run, schema), "lm-scored")
    rare = scored.select("uid", F.explode("tail").alias("word")).join(corpus.counts, "word", "left")
    suffix = (F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(SUFFIXES)) + 1).cast("int")
    of_class = F.element_at(F.array(*(F.lit(float(x)) for x in inside[1 + SINGLES :])), suffix)
    count = F.log10(F.coalesce("n", F.lit(0)) + F.lit(ALPHA))
    tails = rare.groupBy("uid").agg(
        F.sum(count - F.lit(float(everything))).alias("b"), F.sum(count - of_class).alias("s"), F.count("n").alias("k")
    )
    zero = F.lit(0)
    return scored.join(tails, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero)).alias("score"),
    )
