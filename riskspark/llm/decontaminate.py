"""Benchmark decontamination with a positional inverted index.

The index is distributed by document: each chunk of texts has the postings (word places)
of the terms that the benchmark uses. A window is ``window`` consecutive words of an item
(a shorter item is one window). For each window, the list of its rarest term in the chunk is
taken first, each place less the term's offset, and intersected with the offset-adjusted
lists of its other terms, from rare to frequent, until none or the phrase is left. A
proximity match is a place of the text to which every term, at its own offset, is within
``slop`` words.

The benchmark is cut into shards of bounded size; each is sent to the executors in its own
pass, so neither the driver nor a task ever holds more than a shard of it.

Words are runs of ``[0-9a-z]`` and non-ASCII characters, after A-Z are lower-cased.

Defined results: a null or empty text has no words, hits or items, and is not contaminated.
An item without words, without a text or without an id has no windows. Equal rows get equal
results; items of one id count as one. Other columns of the documents are returned unchanged;
the new columns replace any of the same name. Empty tables are allowed on both sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import carried, staged
from riskspark.llm.words import ALNUM, Words, as_bytes, in_chunks, runs

CHUNK_BYTES = 1 << 20
SHARD_BYTES = 4 << 20  # of benchmark text that one pass broadcasts
PIECE_WORDS = 4096
PASSES = 4  # in one job; a staged table follows

_FOUND = {"n_words": "long", "hits": "array<struct<lo: int, hi: int>>", "items": "array<string>", "near": "array<string>"}


def _pieces(window: int):
    """Items as pieces of bounded length that overlap by a window less a word."""
    def run(batches):
        for batch in batches:
            items, pieces = [], []
            for item, text in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text"))):
                w = Words([text], ALNUM, lower=True)
                words = [w.buf[s:e].tobytes() for s, e in zip(w.start, w.end)]
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    if words:
                        items.append(item)
                        pieces.append(b" ".join(words[at : at + PIECE_WORDS + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.binary()).cast(pa.string())], names=["item", "piece"])
    return run


class Shard:
    """The windows of some items: ``terms`` (sorted hashes), each window's terms by place (-1 beyond its end), and whose it is."""

    def __init__(self, items: list[str], pieces: list[bytes], window: int):
        w = Words(pieces, ALNUM, lower=True)
        self.terms, term = np.unique(w.hashes(), return_inverse=True)
        n = np.diff(w.first)
        length = np.minimum(n, window)
        owner = np.repeat(np.arange(len(pieces)), n - length + 1)
        start = np.concatenate([np.arange(a, a + k) for a, k in zip(w.first, n - length + 1)]) if len(pieces) else np.empty(0, np.int64)
        place = start[:, None] + np.arange(window)
        table = np.where(np.arange(window) < length[owner][:, None], term[np.minimum(place, max(len(term) - 1, 0))] if len(term) else 0, -1)
        self.names, number = np.unique(np.array(items, object).astype(str), return_inverse=True)
        self.windows, of = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.empty(0, np.int64))
        order = np.argsort(of.ravel(), kind="stable")
        self.owners, self.owner_start = number[owner][order], np.searchsorted(of.ravel()[order], np.arange(len(self.windows) + 1))
        self.length = (self.windows >= 0).sum(axis=1)

    def owned(self, windows: np.ndarray) -> list[str]:
        return [str(self.names[i]) for i in np.unique(np.concatenate([self.owners[self.owner_start[x] : self.owner_start[x + 1]] for x in windows]))]

    def search(self, w: Words, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Exact matches (window, first word) and proximity matches (window, text) in a chunk."""
        none = np.empty(0, np.int64)
        if not len(w) or not len(self.windows):
            return none, none, none, none
        h = w.hashes()
        term = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        term = np.where(self.terms[term] == h, term, -1)
        posted = np.flatnonzero(term >= 0)
        posted = posted[np.argsort(term[posted], kind="stable")]  # the postings, term by term
        count = np.bincount(term[posted], minlength=len(self.terms))
        begin = np.concatenate(([0], np.cumsum(count)))
        seen = np.where(self.windows >= 0, count[self.windows], np.iinfo(np.int64).max)
        by_rarity = np.argsort(seen, axis=1, kind="stable")  # no terms stand last
        rare = np.take_along_axis(self.windows, by_rarity[:, :1], axis=1).ravel()
        alive = np.flatnonzero(seen.min(axis=1) > 0)
        size = count[rare[alive]]
        win = np.repeat(alive, size)
        if not len(win):
            return none, none, none, none
        first_of = np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
        place = posted[begin[rare[win]] + np.arange(len(win)) - first_of]
        start, doc = place - by_rarity[win, 0], w.doc[place]

        def matched(win, start, doc, reach):
            for k in range(1, self.windows.shape[1]):
                if not len(win):
                    break
                off = by_rarity[win, k]
                want = self.windows[win, off]
                fits = want < 0
                for d in range(-reach, reach + 1):
                    at = np.clip(start + off + d, 0, len(w) - 1)
                    fits |= (term[at] == want) & (w.doc[at] == doc) & (at == start + off + d)
                win, start, doc = win[fits], start[fits], doc[fits]
            return win, start, doc

        exact = matched(win, start, doc, 0)[:2]
        if not slop:
            return *exact, exact[0], w.doc[exact[1]] if len(exact[1]) else none
        # The rarest term too may be off by slop from the place that all terms are near to.
        near = [matched(win, start + d, doc, slop) for d in range(-slop, slop + 1)]
        return *exact, np.concatenate([n[0] for n in near]), np.concatenate([n[2] for n in near])


def _find(shard, slop: int):
    def run(batches):
        s = shard.value
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                w = Words(as_bytes(part.column("text")), ALNUM, lower=True)
                win, start, near_win, near_doc = s.search(w, slop)
                edge = np.zeros(len(w) + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + s.length[win], -1)
                by_doc = [{}, {}]
                for out, (a, docs) in zip(by_doc, ((win, w.doc[start] if len(start) else start), (near_win, near_doc))):
                    order = np.argsort(docs, kind="stable")
                    cut = np.flatnonzero(np.diff(docs[order], prepend=-1))
                    for i, j in zip(cut, np.append(cut[1:], len(order))):
                        out[int(docs[order[i]])] = np.unique(a[order[i:j]])
                covered = np.cumsum(edge[:-1]) > 0
                hits, items, near = part.column("hits").to_pylist(), part.column("items").to_pylist(), part.column("near").to_pylist()
                for d in by_doc[1].keys() | by_doc[0].keys():
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    c = covered[a:b].copy()
                    for x in hits[d] or []:
                        c[x["lo"] : x["hi"]] = True
                    hits[d] = [{"lo": int(x), "hi": int(y)} for x, y in zip(*runs(np.flatnonzero(c)))]
                    if d in by_doc[0]:
                        items[d] = sorted({*(items[d] or []), *s.owned(by_doc[0][d])})
                    if d in by_doc[1]:
                        near[d] = sorted({*(near[d] or []), *s.owned(by_doc[1][d])})
                yield pa.RecordBatch.from_arrays(
                    [part.column("others"), part.column("text"), pa.array(np.diff(w.first), pa.int64()),
                     pa.array([x or [] for x in hits], pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                     pa.array([x or [] for x in items], pa.list_(pa.string())), pa.array([x or [] for x in near], pa.list_(pa.string()))],
                    names=["others", "text", "n_words", "hits", "items", "near"])
    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = 13, slop: int = 0) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (disjoint word ranges of exact matches), ``n_hit``, ``items`` (ids as
    sorted strings), ``near_items`` (of proximity matches, exact ones included) and ``contaminated``
    (a hit, and a twentieth of the words or more are hit). Jobs over the benchmark run when it is called."""
    spark = docs.sparkSession
    new = ("n_words", "hits", "n_hit", "items", "near_items", "contaminated")
    names, others = carried(docs, new, (text_col,))
    order = [c for c in docs.columns if c == text_col or c in names]
    out = docs.select(others, F.col(f"`{text_col}`").alias("text"),
                      *(F.lit(None).cast(kind).alias(n) for n, kind in _FOUND.items()))
    pieces = (benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
              .where("item is not null and text is not null").mapInArrow(_pieces(window), "item string, piece string"))
    pieces = staged(pieces, "benchmark")
    shards = max(1, -(-(pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0) // SHARD_BYTES))
    for k in range(shards):
        own = pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(shards)) == k).toArrow()
        shard = spark.sparkContext.broadcast(Shard(own.column("item").to_pylist(), as_bytes(own.column("piece")), window))
        out = out.mapInArrow(_find(shard, slop), out.schema)
        if (k + 1) % PASSES == 0 and k + 1 < shards:
            out = staged(out, "found")
    n_hit = F.expr("aggregate(hits, 0L, (s, x) -> s + x.hi - x.lo)")
    return out.select(*(F.col("text" if c == text_col else f"others.`{c}`").alias(c) for c in order), "n_words", "hits", n_hit.alias("n_hit"), "items", F.col("near").alias("near_items"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))
