import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from sanitaria.llm.chat import digests, escape, format_conversations, im_template, locate, read_back, unescape

TEXT = st.text(alphabet=st.sampled_from(list("<|\\>im_endstart a\nü")), max_size=25)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=6))
@settings(max_examples=200, deadline=None)
def test_read_back(turns):
    assert list(read_back(im_template(turns))) == turns


def test_locate_finds_texts_in_any_window():
    turns = [("user" if k % 2 else "assistant", f"said {k} <|im_end|>") for k in range(11)]
    for window in (1, 2, 50):
        found = list(locate(iter(turns), im_template, window))
        assert "".join(added for _, added, *_ in found) == im_template(turns)
        assert [unescape(added[a:b]) for _, added, a, b, _ in found] == [t for _, t in turns]
        assert not any(changed for *_, changed in found)


def test_a_template_that_rewrites_history_is_seen():
    def forgetful(turns):
        kept = [t if k == len(turns) - 1 or t[0] != "assistant" else (t[0], "...") for k, t in enumerate(turns)]
        return im_template(kept)

    turns = [("user", "a"), ("assistant", "thought and answer"), ("user", "b"), ("assistant", "end")]
    assert [changed for *_, changed in locate(iter(turns), forgetful)] == [False, False, True, False]


def test_whole_prefixes_beyond_any_window():
    def numbered(turns):
        return "".join(f"{turns[0][1]} {k} {role}: {text}\n" for k, (role, text) in enumerate(turns))

    def last_five(turns):
        return im_template([t if k >= len(turns) - 5 else (t[0], "...") for k, t in enumerate(turns)])

    turns = [("assistant" if k % 2 else "user", f"said {k}") for k in range(100)]
    found = list(locate(iter(turns), numbered))
    assert "".join(added for _, added, *_ in found) == numbered(turns) and not any(changed for *_, changed in found)
    assert [added[a:b] for _, added, a, b, _ in found[1:]] == [t for _, t in turns[1:]]
    assert [changed for *_, changed in locate(iter(turns), last_five)] == [k >= 5 for k in range(100)]


def test_a_window_keeps_that_many_turns():
    def after_three(turns):
        return "".join(f"{'|'.join(t for _, t in turns[max(0, k - 3) : k + 1])}\n" for k in range(len(turns)))

    turns = [("user", f"said {k}") for k in range(40)]
    added = [a for _, a, *_ in locate(iter(turns), after_three, 3)]
    assert "".join(added) == after_three(turns)


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 1, "assistant", "hello"), (2, None, None, None),
    (2, 3, "assistant", ""), (None, 0, "assistant", "lost"), (None, 1, "user", "x"), (3, 0, "sys\ntem", "\\n<|im_end|>\n"),
    *((4, k, "assistant" if k % 2 else "user", f"{k} " * 50) for k in range(700)),
]
SCHEMA = "conv_id long, turn long, role string, text string, part string, loss int, formatted string"


def test_digests_against_plain_code(spark):
    rows = spark.createDataFrame([(*r, "p", 1, "f") for r in ROWS], SCHEMA).repartition(7)
    got = {r["conv_id"]: r for r in digests(format_conversations(rows)).collect()}
    held = defaultdict(list)
    for conv, turn, role, text in ROWS:
        held[conv].append((turn if turn is not None else -1, role or "", text or ""))
    assert set(got) == set(held)
    for conv, turns in held.items():
        turns.sort()
        said = "".join(t for _, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(said)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["formatted_chars"] == len(im_template([(role, t) for _, role, t in turns]))


def test_parts_are_bounded(spark):
    rows = spark.createDataFrame([(*r, "p", 1, "f") for r in ROWS], SCHEMA)
    parts = format_conversations(rows, part_turns=100).filter("conv_id = 4").orderBy("part").collect()
    assert [p["n_turns"] for p in parts] == [100] * 7 and [p["part"] for p in parts] == list(range(7))


def test_empty_table(spark):
    assert digests(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
