"""Words of many texts as numpy arrays: spans, 64-bit hashes and rolling window hashes.

The texts of a chunk are joined with a separator byte, so that every step is one
vector operation over the chunk instead of a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so that both have an inverse modulo 2^64
_BLOCK = 1 << 21

#: The bytes of a word, by byte: all but ASCII white space; digits, a-z and all of non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse up to ``n``."""
    out = []
    for b in (_BASE | 1, pow(_BASE | 1, -1, 1 << 64)):
        p = np.full(n + 1, b, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``buf[starts[i]:ends[i]]`` for each i; the same bytes have the same hash anywhere.

    Spans are in order of their starts. Blocks of spans bound the memory.
    """
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
        lo, hi = int(starts[at]), int(ends[at:upto].max())
        power, inverse = _powers(power_of_two_length(hi - lo))
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[buf[lo:hi]] * power[: hi - lo], out=total[1:])
        s, e = starts[at:upto] - lo, ends[at:upto] - lo
        out[at:upto] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U64) * U64(_STEP))
        at = upto
    return out


def power_of_two_length(n: int) -> int:
    return max(1 << 20, 1 << (n - 1).bit_length() if n > 1 else 1)


class Words:
    """The words of a list of texts, in order.

    ``start``/``end``: byte spans in ``buf``; ``first[d]:first[d + 1]``: the words of text d;
    ``doc``: the text of each word.
    """

    def __init__(self, texts: list[bytes], letters: np.ndarray = NOT_SPACE, lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        inside = np.zeros(len(self.buf) + 1, np.int8)
        inside[1:] = letters[self.buf]
        turn = np.diff(inside)
        self.start, self.end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        self.text_start = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.text_start[1:])
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def window_starts(self, k: int) -> np.ndarray:
        """True where ``k`` words of one text start."""
        ok = np.zeros(len(self), bool)
        if len(self) >= k:
            ok[: len(self) - k + 1] = self.doc[: len(self) - k + 1] == self.doc[k - 1 :]
        return ok


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` values from each place on (shorter by k - 1), by doubling."""
    if len(h) < k:
        return np.empty(0, U64)
    done, have, part, size = None, 0, h, 1
    while True:
        if k & size:
            n = len(h) - have - size + 1
            done = part[:n] if done is None else done[:n] * U64(pow(_STEP, size, 1 << 64)) + part[have : have + n]
            have += size
        if have == k:
            return mix(done)
        part = part[: len(part) - size] * U64(pow(_STEP, size, 1 << 64)) + part[size:]
        size *= 2


def in_chunks(batch, limit: int) -> Iterator:
    """Slices of an Arrow batch whose texts (column ``text``) have about ``limit`` bytes; one row at least."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    at, total = 0, np.concatenate(([0], np.cumsum(size + 1)))
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def as_bytes(column) -> list[bytes]:
    """The values of a text column as UTF-8; null: empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def runs(places: Iterable[int]) -> tuple[np.ndarray, np.ndarray]:
    """First and one past last of the runs of consecutive values in sorted distinct ``places``."""
    p = np.asarray(places)
    if not len(p):
        return p, p
    cut = np.flatnonzero(np.diff(p) > 1)
    return p[np.concatenate(([0], cut + 1))], p[np.concatenate((cut, [len(p) - 1]))] + 1
