import re
from collections import Counter

import numpy as np
import pytest

from sanitaria.llm import quality as q
from tests.llm.data import documents, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_against_plain_code():
    samples = [t or "" for _, t in texts()] + [
        "a b c a b c a", "x y x y x y x", "l 1\nl 1\n\n \nl 1 \n", "### <|> %$&*", "a b c d a b c e b c d", "\x0b\x1c\x85 é",
    ]
    for text in samples:
        assert q.counts(text.encode()) == plain_counts(text), text


def junk(seed):
    return " ".join(w + "###" for w in prose(seed, 80).split())


def test_model_is_calibrated_and_tells_junk(spark):
    rows = [(k, prose(k, 80) if k % 2 else junk(k)) for k in range(300)]
    vectors = q.vectors([t.encode() for _, t in rows])
    model = q.fit(vectors[:200], [k % 2 for k, _ in rows[:200]])
    p = model.probabilities([t.encode() for _, t in rows[200:]])
    good = np.array([k % 2 for k, _ in rows[200:]])
    assert ((p >= 0.5) == good).all() and p[good == 1].min() > 0.6 and p[good == 0].max() < 0.4
    # Scores of texts alone and together are the same, and the dot product with the text's vector.
    alone = [model.scores([t.encode()])[0] for _, t in rows[:20]]
    dots = [model.bias + q._SCALE * (model.weights[s] * v).sum() for s, v in vectors[:20]]
    assert alone == pytest.approx(model.scores([t.encode() for _, t in rows[:20]])) and alone == pytest.approx(dots, rel=1e-4)


def test_quality_and_stage(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(20)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, quality int, text string")
    model = q.train(docs, labels)
    rows = q.quality(docs, model).collect()
    assert len(rows) == len(texts())
    for r in rows:
        text = r["text"] or ""
        n = len(WORD.findall(text))
        assert r["quality_words"] == n
        expected = plain_counts(text)
        found = r["quality_word_chars"], r["quality_symbols"], r["quality_dup_lines"], r["quality_repeat_words"]
        assert found == expected
        failed = n < 50 or 100 * expected[3] > 50 * n
        assert r["quality_base_failed"] == failed and r["quality_kept"] == (not failed and r["quality_probability"] >= 0.5)
    kept = q.good_documents(docs, model)
    assert kept.schema == docs.schema
    assert sorted(repr(r["text"]) for r in kept.collect()) == sorted(repr(r["text"]) for r in rows if r["quality_kept"])


def test_no_labels_reject_nothing(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.train(docs, none)
    assert all(r["quality_kept"] != r["quality_base_failed"] for r in q.quality(docs, model).collect())
    assert q.quality(documents(spark, []), model).count() == 0


def test_a_labelled_id_of_many_rows_counts_once(spark):
    rows = [(k, prose(k, 60) if k % 2 else junk(k)) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, quality int")
    once = q.train(documents(spark, rows), labels)
    again = q.train(documents(spark, rows + [rows[3]] * 500), labels)
    assert np.allclose(once.weights, again.weights) and once.slope == again.slope


def test_slices_cover_a_batch():
    import pyarrow as pa

    from sanitaria.llm.bytewords import slices

    texts = ["é" * 40, None, "", "x" * 300, "y", "z" * 99, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["k", "text"])
    for size in (1, 50, 100, 10_000):
        parts = list(slices(batch, 1, size))
        assert [t for p in parts for t in p.column(1).to_pylist()] == texts and all(p.num_rows for p in parts)
        assert all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[1:]) < size for p in parts)
    assert list(slices(batch.slice(0, 0), 1)) == [] and len(list(slices(batch.slice(1, 2), 1))) == 1


def test_kept_rows_leave_in_slices(spark, monkeypatch):
    """A batch of long texts is judged and passed on in parts, not copied as a whole."""
    import pyarrow as pa

    docs, sent = documents(spark, []), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: sent.append(run))
    model = q.Model(np.zeros(q.SLOTS), 0.0, 0.0, 40.0)
    q.good_documents(docs.select("doc_id", "text"), model)
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(20_000 if k % 3 else 10))) for k in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["doc_id", "text"])
    parts = list(sent[0](iter([batch])))
    assert [r for p in parts for r in p.column(0).to_pylist()] == [k for k in range(30) if k % 3]
    assert len(parts) > 3 and max(p.get_total_buffer_size() for p in parts) < batch.get_total_buffer_size() / 3
