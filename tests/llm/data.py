"""Small documents that hold what operators stumble over."""

from __future__ import annotations

import random

#: Extra columns with names that operators use for their own.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, id long, n int, size long, "
    "uid long, row_id long, ids string, token string, block int, quality_kept string, times int, component long"
)
_WORDS = "the of and token river Stone über façade 12 x-ray lane. Mill, 日本 end! a b c".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(_WORDS) + draw.choice(["", "", str(draw.randrange(40))]) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: null and empty ones, white space, copies, near copies, one long text, repeated ids."""
    long = prose(99, 9_000)
    near = prose(7, 300).split()
    rows: list[tuple[int | None, str | None]] = [(k, prose(k, 20 + 7 * k)) for k in range(25)]
    rows += [(30, ""), (31, None), (32, "   \n\t "), (33, "one"), (34, "one two"), (35, long), (None, prose(50, 60))]
    rows += [(40 + k, " ".join([*near[: 20 * k], f"changed{k}", *near[20 * k + 1 :]])) for k in range(5)]
    rows += [(60 + k, prose(3, 41)) for k in range(4)] + [(70, prose(70, 80)), (70, prose(70, 80)), (None, None)]
    return rows


def documents(spark, rows=None):
    found = []
    for at, (key, text) in enumerate(texts() if rows is None else rows):
        source = None if at % 9 == 8 else f"s{at % 3}"
        found.append((key, text, None, source, len(text or ""), "k", 1, 2, 3, 4, 5, "i", "t", 6, "q", 7, 8))
    return spark.createDataFrame(found, SCHEMA)
