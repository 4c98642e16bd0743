"""Chat formatting by incremental rendering of a template that is used as a black box."""

from __future__ import annotations

import hashlib
import os.path
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"
#: Turns that stay as the base of the built-in template, which renders each turn by itself.
WINDOW = 32
#: Stands for a text when the place of the text in a turn is looked for; a private-use character.
MARK = ""


def escape(text: str) -> str:
    """Control strings lose their form: ``<|`` becomes ``<\\|``, and one backslash more where there are some."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_in(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_out(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def im_template(turns: list[Turn]) -> str:
    """The built-in template: marked turns, texts escaped."""
    return "".join(f"{START}{_role_in(role)}\n{escape(text)}{END}\n" for role, text in turns)


def read_back(formatted: str) -> Iterator[Turn]:
    """The turns of an output of ``im_template``."""
    for turn in formatted.split(f"{END}\n")[:-1]:
        role, _, text = turn.removeprefix(START).partition("\n")
        yield _role_out(role), unescape(text)


def locate(
    turns: Iterator[Turn], template: Template, window: int | None = None
) -> Iterator[tuple[str, str, int, int, bool]]:
    """For each turn: its role, what it adds to the output, where its text lies in that, and whether history changed.

    Successive prefixes are rendered and consecutive outputs compared.  What the longer one
    has beyond their common start is the turn's span; if the common start is shorter than
    the earlier output, the template has rewritten history.  A second rendering with a mark for
    the text shows which part of the span the text is.  Prefixes are whole, so the time
    grows with the square of a conversation's length.  ``window`` says that what the template makes of a turn
    depends on no more than so many turns before it, as is known of ``im_template``: prefixes then begin at least that
    many turns back, and the time is in proportion to the length.
    """
    if window is None and template is im_template:
        window = WINDOW
    held: list[Turn] = []
    before = template([])
    for role, text in turns:
        if window is not None and len(held) >= 2 * window:
            held = held[-window:]
            before = template(held)
        now = template([*held, (role, text)])
        kept = len(before) if now.startswith(before) else len(os.path.commonprefix([before, now]))
        marked = template([*held, (role, MARK)])
        at = marked.find(MARK, kept)
        tail = len(marked) - at - len(MARK)
        inside = (at - kept, len(now) - tail - kept) if at >= 0 and kept == len(before) else (0, 0)
        yield role, now[kept:], *inside, kept < len(before)
        held.append((role, text))
        before = now


def format_conversations(
    turns: DataFrame,
    template: Template = im_template,
    loss_roles: tuple[str, ...] = ("assistant",),
    window: int | None = None,
    part_turns: int = 256,
) -> DataFrame:
    """Formatted conversations in parts of at most ``part_turns`` turns, with the spans under the loss mask.

    Input: ``conv_id, turn, role, text``; other columns are ignored.  Output: ``conv_id,
    part, n_turns, formatted, loss`` (array of start and end code points in ``formatted``, end
    exclusive) and ``rewrites``: the template changed what it had rendered before, in which
    case that turn is left out of the mask.  Parts of one conversation lie in one partition, in
    order, and joined they are its whole output.

    Turns are taken by turn (null first), then role and text; repeated rows are turns of their own.
    A null role or text counts as empty.  Null ``conv_id`` is a conversation.  An empty
    table gives no rows.  A task reads its conversations as a stream and holds one
    part, and the turns that ``template`` is given: with ``window`` (see ``locate``) or the built-in template
    bounded memory for a conversation of any length, otherwise all turns of one conversation.
    """

    def flush(conv, part, n, texts, spans, rewrites) -> pd.DataFrame:
        row = {"conv_id": [conv], "part": [part], "n_turns": [n], "formatted": ["".join(texts)], "loss": [spans]}
        return pd.DataFrame(row | {"rewrites": [rewrites]}).astype({"conv_id": "Int64"})

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        row = next(rows, None)
        while row is not None:
            conv = row[0]
            state = {"next": row}

            def same() -> Iterator[Turn]:
                while state["next"] is not None and (state["next"][0] == conv):
                    _, role, text = state["next"]
                    state["next"] = next(rows, None)
                    yield role, text

            part, n, length, texts, spans, rewrites = 0, 0, 0, [], [], False
            for role, added, start, end, changed in locate(same(), template, window):
                if n == part_turns:
                    yield flush(conv if conv != NULL_ID else None, part, n, texts, spans, rewrites)
                    part, n, length, texts, spans, rewrites = part + 1, 0, 0, [], [], False
                if role in loss_roles and not changed:
                    spans.append([length + start, length + end])
                texts.append(added)
                length, n, rewrites = length + len(added), n + 1, rewrites or changed
            yield flush(conv if conv != NULL_ID else None, part, n, texts, spans, rewrites)
            row = state["next"]

    empty = F.lit("")
    ordered = (
        turns.select(
            F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv_id"),
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), empty).alias("role"),
            F.coalesce(F.col("text").cast("string"), empty).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    schema = "conv_id bigint, part int, n_turns int, formatted string, loss array<array<int>>, rewrites boolean"
    return ordered.mapInPandas(render, schema)


#: Stands for a null conversation while rows are grouped.
NULL_ID = -(2**63)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what ``read_back`` and the loss spans give, hashed turn by turn."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None

        def close() -> pd.DataFrame:
            conv, n, turns, loss_n, loss, chars = state
            row = {"conv_id": [conv], "n_turns": [n], "turns_sha256": [turns.hexdigest()], "loss_chars": [loss_n]}
            row |= {"loss_sha256": [loss.hexdigest()], "formatted_chars": [chars]}
            return pd.DataFrame(row).astype({"conv_id": "Int64"})

        for batch in batches:
            for conv, part, text, spans in batch.itertuples(index=False, name=None):
                conv = None if pd.isna(conv) else int(conv)
                if part == 0:
                    if state:
                        yield close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for start, end in spans:
                    said = unescape(text[start:end])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
        if state:
            yield close()

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return formatted.select("conv_id", "part", "formatted", "loss").mapInPandas(fold, schema)
