"""Packing of documents into sequences of bounded length by multiway differencing.

A document's tokens are those of its text and one end token. Each whole ``capacity`` of
them is a sequence of its own; the rest is cut into pieces of at most ``capacity // 4``
tokens. The pieces of ``BLOCK`` documents at a time are dealt into windows by Karmarkar
and Karp's differencing: every piece begins as a partition with one filled window; the two
partitions with the greatest imbalance merge, the fullest windows of one with the emptiest
of the other, until one is left. If a window then holds more than ``capacity``, the number
of windows rises by one and the block is dealt again.

Tasks pack what they read, so nothing is shuffled and the padding is that of one block's
rounding. The vocabulary is a file of ranks; the ids are those of the ``tokenizers`` file
of the same vocabulary (texts that hold one of its special tokens, and those that the ranks'
regex cannot read, such as a run of a million spaces, are read with that file).

Defined results: a null or empty text is the end token alone. Every row is a document of
its own, whatever its id; ids may be null. Other columns are ignored. An empty table gives
an empty table.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512
_PIECES = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@lru_cache(2)
def _encoder(path: str | None):
    """A function from a text to its ids. ``path``: the vocabulary for ``tokenizers``, beside it the same as ranks."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not any(s in text for s in special):
            try:
                return plain.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u4")
            except ValueError:  # the regex's stack is full
                pass
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")

    return encode


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """The numbers of the pieces in each of at most ``k`` windows, with nearly equal sums."""
    pair: list[tuple[int, int]] = []  # nodes above the pieces
    n = len(sizes)
    # A partition: its windows as (sum, node), the fullest first; windows not listed are empty.
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, i, b = heapq.heappop(heap)
        free = k - len(a)
        merged = b[:free]  # the fullest of b where a is empty
        emptiest = a[::-1]
        for (x, p), (y, q) in zip(emptiest, b[free:]):
            merged.append((x + y, n + len(pair)))
            pair.append((p, q))
        merged += emptiest[max(0, len(b) - free):]
        merged.sort(reverse=True)
        if len(merged) == k:
            least = merged[-1][0]
            merged = [(v - least, p) for v, p in merged]
        heapq.heappush(heap, (-merged[0][0], i, merged))
    out = []
    for _, top in heap[0][2] if heap else []:
        below, pieces = [top], []
        while below:
            x = below.pop()
            if x < n:
                pieces.append(x)
            else:
                below += pair[x - n]
        out.append(sorted(pieces))
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest windows, from the least possible number up, that differencing fills within ``capacity``."""
    k = -(-sum(sizes) // capacity)
    while True:
        found = differencing(sizes, max(1, k))
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        k += 1


def _pack(path: str | None, capacity: int, end: int):
    largest = max(1, capacity // 4)

    def run(batches):
        encode, task = _encoder(path), TaskContext.get().partitionId()
        sequence = task << 33
        rows, rest, docs = [], [], 0  # rest: the pieces not dealt yet

        def row(piece, at):
            doc, start, ids, total = piece
            rows.append((doc, start, len(ids), ids.tobytes(), total, sequence, at))

        def deal():
            nonlocal sequence, rest, docs
            for window in windows_of([len(p[2]) for p in rest], capacity) if rest else []:
                at = 0
                for i in window:
                    row(rest[i], at)
                    at += len(rest[i][2])
                sequence += 1
            rest, docs = [], 0

        def flushed():
            nonlocal rows
            columns, rows = list(zip(*rows)), []
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.array([end], "<u4"))
                whole = len(ids) - len(ids) % capacity
                for at in range(0, whole, capacity):
                    row((doc, at, ids[at:at + capacity], len(ids)), 0)
                    sequence += 1
                    if len(rows) >= 4096:
                        yield flushed()
                rest += [(doc, at, ids[at:at + largest], len(ids)) for at in range(whole, len(ids), largest)]
                docs += 1
                if docs == BLOCK:
                    deal()
                if len(rows) >= 4096:
                    yield flushed()
        deal()
        if rows:
            yield flushed()
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end: int = 0, vocabulary: str | None = None) -> DataFrame:
    """The pieces: the id column, ``start`` (the document's tokens before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence. ``vocabulary``: the file for
    ``tokenizers``, with its ranks beside it; by default the public byte-level one of 50k."""
    out = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(_pack(vocabulary, capacity, end), _PIECES)
    return out.withColumnRenamed("id", id_col)
