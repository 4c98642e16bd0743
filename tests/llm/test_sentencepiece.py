import os
import random
import tracemalloc
from functools import cache

import pytest

from sanitaria.llm import sentencepiece as S
from sanitaria.llm.bytewords import encoded
from sanitaria.llm.common import TEXT_BATCHES, settings, text_batches
from sanitaria.llm.queries import MODEL
from sanitaria.llm.sentencepiece import SPACE, Lattice, Units, Vocabulary, decode, encode, encoded_units
from tests.llm.data import documents, prose, texts

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(MODEL)


def brute(text, vocabulary):
    """Best segmentation of a whole text by recursion, ties to the piece that begins first."""
    if not text:
        return []
    known = {vocabulary.pieces[i]: i for i in vocabulary.normal}
    worst = min(vocabulary.scores[i] for i in vocabulary.normal) - 10
    body = "".join(SPACE if c == " " else ("￿" if c == SPACE else c) for c in " " + text)

    @cache
    def best(end):
        if end == 0:
            return 0.0, ()
        found = None
        for start in range(max(0, end - vocabulary.longest), end):
            piece = body[start:end]
            if piece in known:
                step = (vocabulary.scores[known[piece]], (known[piece],))
            elif end - start == 1:
                raw = (SPACE if piece == "￿" else piece).encode()
                step = (worst, tuple(vocabulary.bytes_from + b for b in raw))
            else:
                continue
            total = best(start)[0] + step[0]
            if found is None or total > found[0]:
                found = total, best(start)[1] + step[1]
        return found

    for end in range(len(body)):
        best(end)
    return list(best(len(body))[1])


ODD = ["", " ", "  a", "a▁b  c\n\n d\t5 ", "日本語 \U0001f600 ok\r\n", "The same the same", "x=1;\r\n  y", "é" * 300]


@pytest.mark.parametrize("head", [0, 40, 1 << 21])
def test_against_brute_force(spark, vocabulary, head):
    rows = [(k, t) for k, t in enumerate([*ODD, *(prose(k, 25) for k in range(12))])]
    got = {r["doc_id"]: r for r in encode(documents(spark, rows), vocabulary, head=head).collect()}
    for k, text in rows:
        assert list(got[k]["ids"]) == (brute(text, vocabulary) if len(text) < 256 else list(got[k]["ids"])), text
        assert got[k]["round_trip"] and got[k]["n_pieces"] == len(got[k]["ids"])


def long_words():
    """Texts with words of more than 256 bytes: URLs, base64, texts without spaces, unknown letters."""
    draw = random.Random(3)
    url = "https://example.org/" + "/".join(prose(k, 4).replace(" ", "-").lower() for k in range(12)) + "?q=" + "ab12" * 60
    base64 = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_500))
    joined = [prose(k, 200).replace(" ", "").replace("\n", "") for k in range(20)]
    return [url, f"see {url} and {url}\nend", base64, "é" * 300, "日本語の文章" * 60, "\U0001f600" * 70, "▁" * 100, *joined]


@pytest.mark.parametrize("head", [0, 1 << 21])
def test_long_words_take_the_best_path_of_the_whole(spark, vocabulary, head):
    rows = [*enumerate(long_words()), (900, "a short one")]
    got = {r["doc_id"]: r for r in encode(documents(spark, rows), vocabulary, head=head).collect()}
    for k, text in rows:
        assert list(got[k]["ids"]) == brute(text, vocabulary), text[:40]
        assert got[k]["round_trip"] and got[k]["n_pieces"] == len(got[k]["ids"])


def test_blocks_of_a_long_word_join_exactly(vocabulary):
    lattice = Lattice(vocabulary)
    for text in long_words():
        word = text.replace(" ", "").replace("\n", "").encode()
        assert all(lattice.encode_long(word, block) == lattice.encode([word])[0] for block in (1, 7, 16, 100, 1 << 16))


def test_the_lattice_of_rare_words_takes_the_same_paths(spark, vocabulary):
    words = sorted({w for k in range(30) for w in Units([encoded(prose(k, 60) + "\n é▁\x00")], vocabulary.breaks()).slices()})
    units = spark.createDataFrame([(w.decode(),) for w in words], "unit string")
    relational = {r["unit"]: list(r["ids"]) for r in encoded_units(units, vocabulary).collect()}
    assert relational == {w.decode(): path for w, path in zip(words, Lattice(vocabulary).encode(words), strict=True)}


def test_units_cover_the_text(vocabulary):
    breaks = vocabulary.breaks()
    raw = [encoded(t) for _, t in texts()] + [("é" * 700).encode(), b"  a  b", ("x" * 1_000).encode()]
    units = Units(raw, breaks)
    pieces = units.slices()
    for k, text in enumerate(raw):
        own = pieces[units.unit[k] : units.unit[k + 1]]
        assert b"".join(own) == (b" " + text if text else b"") and all(len(u) <= 256 and u.decode() for u in own)
    assert len(set(zip(units.hash.tolist(), pieces, strict=True))) == len(set(pieces)) == len(set(units.hash.tolist()))


def test_round_trip_nulls_and_empty_table(spark, vocabulary):
    got = encode(documents(spark), vocabulary, head=100)
    rows = decode(got, vocabulary).collect()
    assert len(rows) == len(texts()) and all(r["round_trip"] for r in rows)
    assert sorted(r["decoded"] for r in rows) == sorted(t or "" for _, t in texts())
    assert encode(documents(spark, []), vocabulary).count() == 0


def test_only_substrings_that_may_be_pieces_are_searched(monkeypatch):
    vocabulary = Vocabulary.load(MODEL)
    lattice, searched = S.Lattice(vocabulary), []
    sums, search = [], S.np.searchsorted
    monkeypatch.setattr(S, "Spans", lambda data, make=S.Spans: sums.append(1) or make(data))
    monkeypatch.setattr(S.np, "searchsorted", lambda a, v, *k: (searched.append(len(v)) if a is lattice.hashes else 0, search(a, v, *k))[1])
    units = [b" qxzvkjwpdlorem", "éé日本😀".encode(), b"x" * 40]
    paths = lattice.encode(units)
    spans = sum(min(lattice.longest, len(u.decode()) - at) for u in units for at in range(len(u.decode())))
    assert len(sums) == 1 and 0 < sum(searched) < spans / 2
    assert paths == [lattice.encode_long(u) for u in units]


def test_one_long_word_does_not_widen_the_places_of_all_others(vocabulary):
    lattice = Lattice(vocabulary)
    units = [*(f" q{k}zx".encode() for k in range(20_000)), b" " + b"qz" * 120]
    lattice.encode(units[:3])
    tracemalloc.start()
    paths = lattice.encode(units)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert all(paths[k] == lattice.encode_long(units[k]) for k in (0, 1, 777, 19_999, 20_000))
    assert paths[:500] == lattice.encode(units[:500], block=50)


def test_the_piece_table_starts_no_python_workers(spark, vocabulary):
    table = vocabulary.table(spark)
    assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    assert table.schema.simpleString() == "struct<piece:string,id:int,score:double>"
    assert sorted(map(tuple, table.collect())) == sorted((vocabulary.pieces[i], i, vocabulary.scores[i]) for i in vocabulary.normal)


def test_text_batches_keep_what_a_session_has_set(spark):
    rows, size = TEXT_BATCHES
    with settings(spark, {rows: "77"}):
        text_batches(spark)
        assert spark.conf.get(rows) == "77" and spark.conf.get(size) == TEXT_BATCHES[size]
    spark.conf.unset(size)
    text_batches(spark)
    assert {name: spark.conf.get(name) for name in TEXT_BATCHES} == TEXT_BATCHES
    for name in TEXT_BATCHES:
        spark.conf.unset(name)
