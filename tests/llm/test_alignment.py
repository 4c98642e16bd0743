"""Token alignment against plain Python over whole corpora."""

import hashlib
import os
from collections import Counter

import pytest

from sanitaria.llm.alignment import Coders, align
from tests.llm.data import documents, texts

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not (os.path.exists(A) and os.path.exists(B)), reason="no vocabulary files")

ODD = [
    "<|endoftext|> and </s> <s> <unk>", "▁ is no space", "x\x00y\x01", "  two  spaces \n\n lines\t", "日本語 über 😀👍🏽 ça",
    "�﻿", "a" * 3_000, " ", "\n", "é é",
]


def plain(said):
    """Rows as ``align`` gives them, from loops over tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    # Byte-level letters by the tokenizer's own decoder of one token; only whole texts are valid UTF-8, so bytes by letters.
    from sanitaria.llm.alignment import _byte_letters

    letters, of_id = _byte_letters(), {i: t for t, i in a.get_vocab().items()}
    rows, counts = [], Counter()
    for text in said:
        text = text or ""
        one = [(i, bytes(letters[c] for c in of_id[i])) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        two = [
            (i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text)
        ] if text else []
        if b"".join(x for _, x in one) != (" " + text).encode() or b"".join(x for _, x in two) != (" " + text).encode():
            one = two = []
        groups, links, x, y, end_x, end_y = [], [], 0, 0, 0, 0
        while x < len(one):
            left, right = [], []
            while True:
                if not left or end_x < end_y:
                    left.append(one[x][0])
                    end_x, x = end_x + len(one[x][1]), x + 1
                elif not right or end_y < end_x:
                    right.append(two[y][0])
                    end_y, y = end_y + len(two[y][1]), y + 1
                if left and right and end_x == end_y:
                    break
            groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            links.append((left[-1], right[-1]))
        counts.update(links)
        rows.append((len(one), len(two), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for n_a, n_b, n, links, line in rows:
        good = sum(counts[p] == best[p[1]] for p in links)
        total = sum(counts[p] for p in links)
        out.append((n_a, n_b, n, n, good, total, hashlib.sha256(line.encode()).hexdigest() if line else "", line))
    return out, counts, best


def test_against_loops(spark):
    rows = [*texts(), *((200 + k, t) for k, t in enumerate(ODD)), (None, ODD[0]), (200, ODD[0])]
    found = align(documents(spark, rows).repartition(3), Coders.load(A, B), groups=True, chunk_bytes=4_000)
    wanted, counts, best = plain([t for _, t in rows])
    assert found.documents.columns[0] == "doc_id"
    got = Counter(tuple(r) for r in found.documents.collect())
    assert got == Counter((k, *w) for (k, _), w in zip(rows, wanted, strict=True))
    pairs = {(r["a"], r["b"]): (r["n"], r["best"]) for r in found.pairs.collect()}
    assert pairs == {p: (n, best[p[1]] == n) for p, n in counts.items()}
    assert any(w[0] for w in wanted) and wanted[len(texts()) + 1] == (0, 0, 0, 0, 0, 0, "", "")


def test_chunks_do_not_matter(spark):
    docs = documents(spark)
    one = align(docs.coalesce(1), Coders.load(A, B)).documents.collect()
    many = align(docs.repartition(7), Coders.load(A, B), chunk_bytes=1).documents.collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, many))


def test_empty_table(spark):
    found = align(documents(spark, []), Coders.load(A, B))
    assert found.documents.count() == 0 and found.pairs.count() == 0


def test_only_empty_texts(spark):
    found = align(documents(spark, [(1, None), (2, "")]), Coders.load(A, B)).documents.collect()
    assert sorted(map(tuple, found)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_ends_meet_without_a_join_of_tables(monkeypatch):
    from sanitaria.llm import alignment

    met, look = [], alignment.pc.index_in
    monkeypatch.setattr(alignment.pc, "index_in", lambda *a, **k: met.append(1) or look(*a, **k))
    said = [*ODD, "plain words of a text", ""]
    found = alignment.align_texts([t.encode() for t in said], Coders.load(A, B), print_groups=True)
    wanted, _, _ = plain(said)
    assert met and found.groups == [w[-1] for w in wanted] and found.n_links.tolist() == [w[2] for w in wanted]
    assert len(found.link_a) == len(found.link_b) == sum(w[2] for w in wanted)
