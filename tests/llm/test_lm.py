import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sanitaria.llm import lm
from sanitaria.llm.common import lower_words_of
from tests.llm.data import documents, prose, texts


def test_fit_finds_the_frequencies_of_contexts():
    draw = np.random.default_rng(1)
    seen = np.zeros((lm.CONTEXTS, lm.CLASSES))
    for context in range(6):
        p = draw.dirichlet(np.full(lm.CLASSES, 0.05))
        seen[context] = draw.multinomial(40_000, p)
    table = lm.fit(seen).log10()
    assert np.allclose((10**table).sum(axis=1), 1.0)
    unigram = np.log10((seen.sum(axis=0) + 0.1) / (seen.sum() + 0.1 * lm.CLASSES))
    model, base = (seen * table).sum(), (seen * unigram).sum()
    best = sum((row[row > 0] * np.log10(row[row > 0] / row.sum())).sum() for row in seen if row.sum())
    assert base < model <= best and (best - model) < 0.2 * (best - base)


@pytest.mark.parametrize("limit", [5, 400, 131_072])
def test_scores_against_plain_code(spark, limit):
    rows = [(k, t) for k, t in texts() if k is not None]
    got = lm.train_and_score(documents(spark, rows), limit=limit).collect()
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows}
    counts, n = Counter(), 0
    for k, t in rows:
        if not held[k]:
            counts.update(lower_words_of(t))
            n += 1
    tokens, distinct = sum(counts.values()) + n, len(counts) + 1
    below = math.log10(tokens + 0.1 * (distinct + 1))
    expected = []
    for k, t in rows:
        words = lower_words_of(t)
        base = sum(math.log10(counts[w] + 0.1) - below for w in words) + math.log10(n + 0.1) - below
        expected.append((k, held[k], len(words) + 1, sum(w in counts for w in words) + 1, tokens, round(base, 6)))
    found = [(*(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")), round(r["base_score"], 6)) for r in got]
    assert sorted(found) == sorted(expected)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [(k, "alpha beta gamma. " * 10 + prose(k, 30) + " alpha beta gamma." * 10) for k in range(300)]
    got = [r for r in lm.train_and_score(documents(spark, rows)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) / 1.4


def test_probabilities_of_all_words_sum_to_one(spark):
    docs = documents(spark).select("text").fillna("")
    corpus = lm.gather(docs, 300)
    classes, n, v = lm.class_table(corpus)
    inside = np.zeros(lm.CLASSES)
    for word, c in ((bytes(r["word"]), r["n"]) for r in corpus.counts.collect()):
        k = classes.of.get(word) or lm.suffix_class(word)
        inside[k] += 1.0 if k <= lm.SINGLES else (c + lm.ALPHA) / (n[k] + lm.ALPHA * (v[k] + 1))
    for k in range(1, lm.CLASSES):
        unseen = 0.0 if k <= lm.SINGLES else lm.ALPHA / (n[k] + lm.ALPHA * (v[k] + 1))
        assert inside[k] + unseen == pytest.approx(1.0) or (k <= lm.SINGLES and inside[k] == 0.0 and len(corpus.head) < k)
    seen = lm.count_classes(docs, classes)
    assert seen.sum() == corpus.tokens and seen[:, 0].sum() == corpus.texts


def test_nulls_and_empty_tables(spark):
    assert lm.train_and_score(documents(spark)).count() == len(texts())
    assert lm.train_and_score(documents(spark, [])).count() == 0
    alone = lm.train_and_score(documents(spark, [(None, "held out only")])).first()
    assert alone["held_out"] and alone["n_known"] == 0 and alone["train_tokens"] == 0 and math.isfinite(alone["score"])
