"""Substring de-duplication by fixed-block anchors.

A window is ``window`` consecutive words of one text. Words are removed that lie in
a window whose word sequence also starts earlier (at a smaller id, or earlier in the
same text); windows are judged on the input.

1. Index and probe. Each text is cut into non-overlapping blocks of ``window // 2``
   words, so every window holds at least one whole block. The blocks are the index,
   and every rolling stretch of as many words, of all texts, probes it. Both are dealt
   by hash into buckets; a block whose hash two or more stretches have is a hit.
   Texts without a hit repeat nothing.
2. Extend. Around the hits, the windows that hold a hit block are hashed in full
   (96 bits) and dealt into buckets, where the earliest start of each is found; the
   later ones are marked.
3. Remove. Overlapping marked windows join to maximal repeats, and their words go.

A chunk of texts sends each distinct stretch or window once, so copies and frequent
passages are combined before the shuffle, and no pairs of occurrences are ever made.

Defined results: a null text has no words. Rows of one id count as one text at the same
place: equal rows are treated alike, and of different texts with one id the earlier
place wins. A null id comes before all others. Other columns are ignored by the work
and returned unchanged; the new columns replace any of the same name. An empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.llm.marks import MARKS, by_row, cells, slotted
from riskspark.llm.stage import carried, dropped, power_of_two, staged
from riskspark.llm.words import U64, Words, as_bytes, in_chunks, mix, runs, windows

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20  # of text for each bucket of the index

_PROBES = "bucket int, rolls binary, blocks binary, owners binary, keys binary, places binary"
_HITS = "id long, key int, place int"
_WINDOWS = "bucket int, hashes binary, checks binary, ids binary, rows binary, places binary"


def _buckets(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets (top bits) that the sorted hashes fall into, and where each begins, with the end."""
    top = h >> U64(shift)
    cut = np.flatnonzero(np.diff(top)) + 1
    begin = np.concatenate(([0], cut)).astype(np.int64)
    return top[begin].astype(np.int32), np.append(begin, len(h))


def _probes(block: int, buckets: int):
    """For each chunk and bucket: the distinct rolling hashes (40 bits below the bucket's) and the blocks."""
    shift = 64 - (buckets.bit_length() - 1)

    def low(h):
        return ((h << U64(64 - shift)) >> U64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()

    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                w = Words(as_bytes(part.column("text")))
                h = windows(w.hashes(), block)
                at = np.flatnonzero(w.window_starts(block))
                if not len(at):
                    continue
                h = h[at]
                order = np.argsort(h, kind="stable")
                rolls, begin, count = np.unique(h[order], return_index=True, return_counts=True)
                many = np.repeat(count > 1, count)
                place = at - w.first[w.doc[at]]
                pick = order[place[order] % block == 0]  # the blocks, by hash
                again = many[place[order] % block == 0]
                ids = part.column("id").to_numpy(zero_copy_only=False)[w.doc[at[pick]]]
                keys = part.column("key").to_numpy(zero_copy_only=False)[w.doc[at[pick]]]
                no = (place[pick] // block).astype(np.int32)
                h = h[pick]
                full, rb = _buckets(rolls, shift)
                bb = np.append(np.searchsorted(h >> U64(shift), full.astype(U64)), len(h))
                ids, keys, no = ids.astype("<i8"), keys.astype("<i4"), no.astype("<i4")
                parts = [[low(rolls[rb[i]:rb[i + 1]]) for i in range(len(full))],
                         # A block met twice in the chunk is a hit already: its hash is sent as all ones.
                         [_flagged(low(h[bb[i]:bb[i + 1]]), again[bb[i]:bb[i + 1]]) for i in range(len(full))],
                         *([x[bb[i]:bb[i + 1]].tobytes() for i in range(len(full))] for x in (ids, keys, no))]
                yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(c, pa.binary()) for c in parts)],
                                                 names=["bucket", "rolls", "blocks", "owners", "keys", "places"])
    return run


def _flagged(low: bytes, again: np.ndarray) -> bytes:
    a = np.frombuffer(low, np.uint8).reshape(-1, 5).copy()
    a[again] = 255
    return a.tobytes()


def _wide(column) -> np.ndarray:
    """The 40-bit values of binary cells, one after the other."""
    a = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 5)
    out = np.zeros((len(a), 8), np.uint8)
    out[:, :5] = a
    return out.view("<u8").ravel()


def _hits(table: pa.Table) -> pa.Table:
    """The blocks of a bucket whose hash comes from two chunks, or twice from one."""
    rolls, blocks = _wide(table.column("rolls")), _wide(table.column("blocks"))
    rolls.sort()
    repeated = rolls[1:][rolls[1:] == rolls[:-1]]
    hit = blocks == (1 << 40) - 1
    if len(repeated):
        near = np.searchsorted(repeated, blocks)
        hit |= repeated[np.minimum(near, len(repeated) - 1)] == blocks
    return pa.table({"id": cells(table.column("owners"), "<i8")[hit], "key": cells(table.column("keys"), "<i4")[hit],
                     "place": cells(table.column("places"), "<i4")[hit]})


def _candidates(block: int, window: int, buckets: int):
    """For each chunk and bucket: the earliest start of each distinct window with a hit block, and marks of the others."""
    shift = 64 - (buckets.bit_length() - 1)

    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                w = Words(as_bytes(part.column("text")))
                hits = part.column("blocks")
                doc = np.repeat(np.arange(part.num_rows), np.diff(hits.offsets.to_numpy()))
                hit = w.first[doc] + hits.flatten().to_numpy(zero_copy_only=False).astype(np.int64) * block
                if not len(hit):
                    continue
                # A window that starts at s holds the block at p if p - (window - block) <= s <= p.
                edge = np.zeros(len(w) + 1, np.int32)
                np.add.at(edge, np.maximum(hit - (window - block), w.first[doc]), 1)
                np.add.at(edge, hit + 1, -1)
                at = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & w.window_starts(window))
                if not len(at):
                    continue
                h1 = w.hashes()
                h, check = windows(h1, window)[at], windows(mix(h1 ^ U64(0x5851F42D4C957F2D)), window)[at].astype(np.uint32)
                ids = part.column("id").to_numpy(zero_copy_only=False)[w.doc[at]]
                rows = part.column("row").to_numpy(zero_copy_only=False)[w.doc[at]]
                place = (at - w.first[w.doc[at]]).astype(np.int32)
                order = np.lexsort((rows, place, ids, check, h))
                h, check, ids, rows, place = (x[order] for x in (h, check, ids, rows, place))
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
                lead = np.flatnonzero(first)[np.cumsum(first) - 1]
                later = (ids != ids[lead]) | (place != place[lead])
                send = ~later
                full, b = _buckets(h[send], shift)
                parts = [x[send] for x in (h.astype("<u8"), check.astype("<u4"), ids.astype("<i8"), rows.astype("<i8"), place.astype("<i4"))]
                out = [pa.array(full), *(pa.array([c[b[i]:b[i + 1]].tobytes() for i in range(len(full))], pa.binary()) for c in parts)]
                # Marks known here travel in buckets of their own, -1 - slot, as they need no comparison.
                slot, whose, known = slotted(rows[later], place[later], buckets)
                extra = [pa.array(-1 - slot.to_numpy()), *(pa.array([b""] * len(slot), pa.binary()) for _ in range(3)), whose, known]
                names = ["bucket", "hashes", "checks", "ids", "rows", "places"]
                yield pa.RecordBatch.from_arrays(out, names=names)
                yield pa.RecordBatch.from_arrays(extra, names=names)
    return run


def _marks(slots: int):
    """The windows of a bucket that are not the earliest of their words, by slots of rows."""
    def run(table: pa.Table) -> pa.Table:
        rows, place = cells(table.column("rows"), "<i8"), cells(table.column("places"), "<i4")
        if table.column("bucket")[0].as_py() >= 0:
            h, check, ids = cells(table.column("hashes"), "<u8"), cells(table.column("checks"), "<u4"), cells(table.column("ids"), "<i8")
            order = np.lexsort((place, ids, check, h))
            h, check, ids, place, rows = (x[order] for x in (h, check, ids, place, rows))
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            later = (ids != ids[lead]) | (place != place[lead])
            rows, place = rows[later], place[later]
        return pa.table(slotted(rows, place, slots), names=["slot", "rows", "places"])
    return run


def _kept(window: int):
    """Each text without its marked words; joined by one space where any went."""
    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                texts = as_bytes(part.column("text"))
                n_words, n_removed, kept = [], [], []
                for text, marks in zip(texts, part.column("marks")):
                    words = text.split()  # bytes: white space is ASCII's
                    n_words.append(len(words))
                    gone = 0
                    if marks.is_valid:
                        a = np.unique(marks.values.to_numpy(zero_copy_only=False))
                        stay, at = [], 0
                        for lo, hi in zip(*runs(a)):
                            stay += words[at:max(at, lo)]
                            gone += hi - 1 + window - max(at, lo)
                            at = int(hi) - 1 + window
                        words = stay + words[at:]
                    n_removed.append(int(gone))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("others"), part.column("text"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["others", "text", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (the words that stay, joined by one space).

    ``window``: words of a window, 2 at least. Jobs run when it is called.
    """
    if window < 2:
        raise ValueError("a window has 2 words at least")
    block = (window + 1) // 2
    new = ("n_words", "n_removed", "kept_text")
    names, others = carried(docs, new, (text_col,))
    order = [c for c in docs.columns if c == text_col or c in names]
    base = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("id"), F.hash(F.col(f"`{text_col}`")).alias("key"),
                       F.col(f"`{text_col}`").alias("text"), others)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = power_of_two(max(16, size / BUCKET_BYTES))
    hits = (base.select("id", "key", "text").mapInArrow(_probes(block, buckets), _PROBES)
            .groupBy("bucket").applyInArrow(_hits, _HITS)
            .groupBy("id", "key").agg(F.collect_set("place").alias("blocks")))
    hits = staged(hits, "hits")
    marked = staged(base.join(hits, ["id", "key"], "left").withColumn("row", F.monotonically_increasing_id()), "texts")
    marks = (marked.where("blocks is not null").select("id", "row", "text", "blocks")
             .mapInArrow(_candidates(block, window, buckets), _WINDOWS)
             .groupBy("bucket").applyInArrow(_marks(buckets), MARKS))
    marks = staged(by_row(marks), "marks")
    dropped(hits)
    found = marked.where("blocks is not null").join(marks, "row", "left").select("others", "text", "marks")
    rest = marked.where("blocks is null").select("others", "text", F.lit(None).cast("array<int>").alias("marks"))
    fields = [StructField("others", marked.schema["others"].dataType), StructField("text", StringType()),
              StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())]
    out = found.unionByName(rest).mapInArrow(_kept(window), StructType(fields))
    return out.select(*(F.col("text" if c == text_col else f"others.`{c}`").alias(c) for c in order), *new)
