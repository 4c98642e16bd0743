"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text that are worked on together; one longer text is a chunk of its own.
CHUNK = 1 << 19
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def chunks(texts: Sequence[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    start = held = 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices(batch, at: int, size: int = CHUNK) -> Iterator:
    """A record batch in parts of about ``size`` bytes of its text column ``at``, so that few texts become objects at once."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths) // size
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(a, b - a)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over 64, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


class Spans:
    """64-bit hashes of any spans of the same bytes, from one running sum over all of them."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _powers(_BASE, n)
        np.cumsum(terms, out=self._sums[1:])
        self._back = _powers(_INVERSE, n + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._back[start]
        return mixed(h + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each span."""
    return Spans(data).hashes(start, end)


class ByteWords:
    """``data``: the texts, each followed by a space; ``first[i]`` where text i begins.

    ``start``, ``end`` are the words' bytes, ``word[i]:word[i + 1]`` those of text i, and
    ``hash`` a 64-bit hash of each word's bytes.
    """

    def __init__(self, texts: Sequence[bytes]):
        self.data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        self.first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[self.data]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.word = np.searchsorted(self.start, self.first)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word)

    @property
    def hash(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def each(self, values: np.ndarray) -> np.ndarray:
        """Sum of per-word values for each text."""
        sums = np.concatenate([np.zeros(1, dtype=np.float64), np.cumsum(values, dtype=np.float64)])
        return sums[self.word[1:]] - sums[self.word[:-1]]
