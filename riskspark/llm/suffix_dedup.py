"""Exact byte de-duplication by a depth-limited radix sort of suffixes.

A byte is removed that lies in a string of ``depth`` bytes which also starts anywhere
else (in another text, or elsewhere in the same). Two such strings are equal exactly if
their suffixes are in one group after the radix passes through ``depth`` bytes, so the
passes stop there. They go from digits that most suffixes share with none to the full
depth, and a group of one is dropped at once:

1. Digit: the ``depth // 4`` bytes at the anchor. The anchor of a suffix is the place of
   the least hash within its first ``depth`` bytes; equal strings have equal anchors.
   Neighbouring suffixes share an anchor, so that a pass has one row for some 150 of them.
   Texts that repeat nothing end here.
2. Digit: all bytes that the suffixes of an anchor have to ``depth``. Anchors equal in this
   have only repeated strings; anchors with an equal partner need no further pass.
3. What is left, the suffixes at the ends of repeats, gets single rows: they are dealt by
   the first half of their ``depth`` bytes, sorted by it, and groups of two or more are
   sorted by the second half.

Defined results: a null text is empty. Every row is a text of its own, so equal rows
remove each other, whatever their ids. Texts shorter than ``depth`` stay whole. The bytes
that stay may not be valid UTF-8, so they are returned as binary. Other columns are
returned unchanged; the new columns replace any of the same name. An empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from riskspark.llm.marks import MARKS, by_row, cells, slotted
from riskspark.llm.stage import carried, dropped, power_of_two, staged
from riskspark.llm.words import U64, as_bytes, in_chunks, runs, span_hashes

CHUNK_BYTES = 1 << 20
PIECE_BYTES = 1 << 19  # of a text; longer texts are read in overlapping pieces
BUCKET_ROWS = 1 << 20
_PLACE = 22  # bits for a place in a chunk

_ANCHORS = "id long, key int, digit long, stretch long, lo int, hi int"
_SUFFIXES = "bucket int, first binary, second binary, rows binary, places binary"


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by prefix and suffix minima of blocks."""
    n = len(v) - width + 1
    pad = -len(v) % width
    v = np.append(v, np.full(pad, np.iinfo(v.dtype).max, v.dtype)).reshape(-1, width)
    before = np.minimum.accumulate(v, axis=1).ravel()
    after = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes], depth: int):
    """The texts with ``depth`` bytes or more, in overlapping pieces: text, offset, bytes."""
    for d, t in enumerate(texts):
        for at in range(0, len(t) - depth + 1, PIECE_BYTES):
            yield d, at, t[at : at + PIECE_BYTES + depth - 1]


def _groups(texts: list[bytes], depth: int):
    """Pieces of together about CHUNK_BYTES, as arrays: text and offset of each piece, its begin in the buffer, the buffer."""
    group, size = [], 0
    for p in _pieces(texts, depth):
        if group and size + len(p[2]) > CHUNK_BYTES:
            yield _joined(group)
            group, size = [], 0
        group.append(p)
        size += len(p[2]) + 1
    if group:
        yield _joined(group)


def _joined(group):
    begin = np.zeros(len(group) + 1, np.int64)
    np.cumsum([len(p[2]) + 1 for p in group], out=begin[1:])
    return np.array([p[0] for p in group]), np.array([p[1] for p in group]), begin, np.frombuffer(b"\n".join(p[2] for p in group) + b"\n", np.uint8)


def _anchors(depth: int, gram: int):
    """One row for each run of suffixes with the same anchor."""
    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                ids, keys = part.column("id").to_numpy(zero_copy_only=False), part.column("key").to_numpy(zero_copy_only=False)
                for text, offset, begin, buf in _groups(as_bytes(part.column("text")), depth):
                    at = np.arange(len(buf) - gram + 1)
                    h = span_hashes(buf, at, at + gram)
                    low = U64((1 << _PLACE) - 1)
                    anchor = (_least((h & ~low) | at.astype(U64), depth - gram + 1) & low).astype(np.int64)
                    # A suffix starts where its piece has depth bytes left; runs end with the piece or its anchor.
                    piece = np.repeat(np.arange(len(text)), np.diff(begin))[: len(anchor)]
                    good = np.arange(len(anchor)) + depth < begin[piece + 1]
                    start = np.flatnonzero(good)
                    cut = np.flatnonzero((np.diff(anchor[start], prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
                    lo, hi = start[cut], start[np.append(cut[1:], len(start)) - 1]
                    p = piece[lo]
                    shape = (((anchor[lo] - lo) << 16) ^ (hi - lo)).astype(U64)
                    stretch = span_hashes(buf, lo, hi + depth) + shape * U64(0x9E3779B97F4A7C15)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[text[p]]), pa.array(keys[text[p]]), pa.array(h[anchor[lo]].view(np.int64)), pa.array(stretch.view(np.int64)),
                         pa.array((lo - begin[p] + offset[p]).astype(np.int32)), pa.array((hi - begin[p] + offset[p]).astype(np.int32))],
                        names=["id", "key", "digit", "stretch", "lo", "hi"])
    return run


def _suffixes(depth: int, buckets: int):
    """The suffixes to compare through ``depth`` bytes, each different one once a chunk, by the first digit's top bits."""
    half, shift = depth // 2, 64 - (buckets.bit_length() - 1)

    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                texts, rows = as_bytes(part.column("text")), part.column("row").to_numpy(zero_copy_only=False)
                first, second, whose, place, lone = [], [], [], [], []
                for text, row, ends in zip(texts, rows, part.column("ends")):
                    los, his, alone = (np.array(ends.values.field(n).to_numpy(zero_copy_only=False)) for n in ("lo", "hi", "lone"))
                    for lo, hi, one in zip(los, his, alone):
                        buf = np.frombuffer(text[lo : hi + depth], np.uint8)
                        at = np.arange(hi - lo + 1)
                        first.append(span_hashes(buf, at, at + half))
                        second.append(span_hashes(buf, at + half, at + depth))
                        place.append(at + lo)
                        whose.append(np.full(len(at), row))
                        lone.append(np.full(len(at), one))
                if not first:
                    continue
                a, b, whose, place, lone = map(np.concatenate, (first, second, whose, place, lone))
                order = np.lexsort((b, a))
                a, b, whose, place, lone = (x[order] for x in (a, b, whose, place, lone))
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                group = np.cumsum(new) - 1
                size = np.bincount(group)
                # A string met once goes with its place, if that is still to be judged; one met more often goes as two without.
                known = lone & (size[group] > 1)
                own = lone & (size[group] == 1)
                send = np.flatnonzero(new)
                send = np.concatenate((send, send[size > 1]))
                top = a[send] >> U64(shift)
                order = np.lexsort((~own[send], top))  # in each bucket, those with a place first
                send, top = send[order], top[order]
                cut = np.append(np.flatnonzero(np.diff(top, prepend=top[0] + U64(1))), len(top))
                owned = np.concatenate(([0], np.cumsum(own[send])))[cut]
                whose_own, place_own = whose[send][own[send]].astype("<i8"), place[send][own[send]].astype("<i4")
                parts = [*((x[send].astype(k), cut) for x, k in ((a, "<u8"), (b, "<u4"))), (whose_own, owned), (place_own, owned)]
                names = ["bucket", "first", "second", "rows", "places"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top[cut[:-1]].astype(np.int32)), *(pa.array([x[c[i]:c[i + 1]].tobytes() for i in range(len(c) - 1)], pa.binary()) for x, c in parts)], names=names)
                if known.any():  # marks already, in buckets of their own, -1 - slot
                    slot, rows_known, places_known = slotted(whose[known], place[known], buckets)
                    empty = pa.array([b""] * len(slot), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(-1 - slot.to_numpy()), empty, empty, rows_known, places_known], names=names)
    return run


def _repeated(slots: int):
    """The suffixes of a bucket that are in a group of two or more after both digits, by slots of rows."""
    def run(table: pa.Table) -> pa.Table:
        rows, place = cells(table.column("rows"), "<i8"), cells(table.column("places"), "<i4")
        if table.column("bucket")[0].as_py() >= 0:
            a, b = cells(table.column("first"), "<u8"), cells(table.column("second"), "<u4")
            # Where in the bucket the suffixes with a place are: the first ones of each cell.
            n = np.array([len(x) // 8 for x in table.column("first").to_pylist()])
            own = np.array([len(x) // 8 for x in table.column("rows").to_pylist()])
            at = np.full(len(a), -1)
            at[np.repeat(np.cumsum(n) - n - np.cumsum(own) + own, own) + np.arange(len(rows))] = np.arange(len(rows))
            order = np.argsort(a, kind="stable")  # the first digit; groups of one end here
            s = a[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            same[:-1] |= s[1:] == s[:-1]
            order = order[same]
            order = order[np.lexsort((b[order], a[order]))]  # the second digit
            s, t = a[order], b[order]
            equal = (s[1:] == s[:-1]) & (t[1:] == t[:-1])
            hit = np.zeros(len(order), bool)
            hit[1:] = equal
            hit[:-1] |= equal
            found = at[order[hit]]
            found = found[found >= 0]
            rows, place = rows[found], place[found]
        return pa.table(slotted(rows, place, slots), names=["slot", "rows", "places"])
    return run


def _kept(depth: int):
    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                n_bytes, n_removed, n_spans, kept = [], [], [], []
                for text, ranges, marks in zip(as_bytes(part.column("text")), part.column("ranges"), part.column("marks")):
                    edge = np.zeros(len(text) + 1, np.int32)
                    if ranges.is_valid:
                        np.add.at(edge, ranges.values.field("lo").to_numpy(zero_copy_only=False), 1)
                        np.add.at(edge, ranges.values.field("hi").to_numpy(zero_copy_only=False) + depth, -1)
                    if marks.is_valid:
                        m = marks.values.to_numpy(zero_copy_only=False)
                        np.add.at(edge, m, 1)
                        np.add.at(edge, m + depth, -1)
                    lo, hi = runs(np.flatnonzero(np.cumsum(edge[:-1]) > 0))
                    stay, at = [], 0
                    for s, e in zip(lo, hi):
                        stay.append(text[at:s])
                        at = e
                    n_bytes.append(len(text))
                    n_removed.append(int((hi - lo).sum()) if len(lo) else 0)
                    n_spans.append(len(lo))
                    kept.append(b"".join([*stay, text[at:]]))
                yield pa.RecordBatch.from_arrays([part.column("others"), part.column("text"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                                                 names=["others", "text", "n_bytes", "n_removed", "n_spans", "kept_bytes"])
    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 400) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_bytes``.

    ``depth``: bytes of a string, 4 at least. Jobs run when it is called.
    """
    if depth < 4:
        raise ValueError("a string has 4 bytes at least")
    new = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    names, others = carried(docs, new, (text_col,))
    order = [c for c in docs.columns if c == text_col or c in names]
    base = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("id"), F.hash(F.col(f"`{text_col}`")).alias("key"),
                       F.col(f"`{text_col}`").alias("text"), others)
    anchors = staged(base.select("id", "key", "text").mapInArrow(_anchors(depth, depth // 4), _ANCHORS), "anchors")
    # Pass 1: groups by the digit at the anchor; pass 2: by the whole stretch, where a group has different ones.
    # The groups are staged, so that Spark can split the rows of a frequent digit in the joins.
    digits = staged(anchors.groupBy("digit").agg(F.count(F.lit(1)).alias("n"), (F.min("stretch") == F.max("stretch")).alias("alike"))
                    .where("n > 1").select("digit", "alike"), "digits")
    again = staged(anchors.join(digits, "digit"), "groups")
    dropped(anchors, digits)
    mixed = again.where("not alike").groupBy("digit", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "lo")).alias("chief"))
    mixed = staged(mixed, "stretches")
    lone = mixed.groupBy("digit").agg(F.min("n").alias("least")).where("least = 1").select("digit", F.lit(True).alias("open"))
    stretches = staged(mixed.join(lone, "digit", "left"), "stretches")
    seen = (again.join(stretches, ["digit", "stretch"], "left")
            .select("id", "key", "lo", "hi", (F.col("alike") | (F.col("n") > 1)).alias("settled"),
                    (F.coalesce("open", F.lit(False)) & (F.struct("id", "key", "lo") == F.col("chief"))).alias("end")))
    span = F.struct("lo", "hi")
    each = staged(seen.where("settled or end").groupBy("id", "key").agg(
        F.collect_set(F.when(F.col("settled"), span)).alias("ranges"),
        F.collect_set(F.when(F.col("end"), F.struct("lo", "hi", (~F.col("settled")).alias("lone")))).alias("ends")), "spans")
    dropped(again, mixed, stretches)
    texts = staged(base.join(each, ["id", "key"], "left").withColumn("row", F.monotonically_increasing_id()), "texts")
    todo = each.agg(F.sum(F.expr("aggregate(ends, 0L, (s, x) -> s + x.hi - x.lo + 1)"))).first()[0] or 0
    dropped(each)
    buckets = power_of_two(max(16, todo / BUCKET_ROWS))
    marks = (texts.where("size(ends) > 0").select("row", "text", "ends").mapInArrow(_suffixes(depth, buckets), _SUFFIXES)
             .groupBy("bucket").applyInArrow(_repeated(buckets), MARKS))
    marks = staged(by_row(marks), "marks")
    columns = ["others", "text", "ranges", "marks"]
    out = (texts.where("ranges is not null").join(marks, "row", "left").select(*columns)
           .unionByName(texts.where("ranges is null").withColumn("marks", F.lit(None).cast("array<int>")).select(*columns)))
    fields = [StructField("others", texts.schema["others"].dataType), StructField("text", StringType()), *(StructField(n, LongType()) for n in new[:3]), StructField(new[3], BinaryType())]
    out = out.mapInArrow(_kept(depth), StructType(fields))
    return out.select(*(F.col("text" if c == text_col else f"others.`{c}`").alias(c) for c in order), *new)
