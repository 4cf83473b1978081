"""Near-duplicate detection with BagMinHash signatures.

A text is the multiset of its shingles (``shingle`` consecutive words; all words of a shorter
text), and two texts are near copies if their weighted Jaccard similarity, the sum of the lesser
counts over the sum of the greater, is ``similarity`` or more.

Signatures. The counts are weights, discretised at the whole numbers. Each shingle has a Poisson
process over (0, 1], (1, 2], (2, 4], (4, 8] and so on of its weight axis: a point has a time, a
component of the signature, and, going down the halves of its interval, a whole weight. A text
takes the points up to its own weights, and each component keeps the earliest. Two texts keep the
same point with a probability of just their similarity. A process stops as soon as its next time
is after the latest of all components, so a shingle costs little more than one point.

Bands of ``rows`` components are keys; texts with a key in common are candidates. Texts with equal
content are one node from the start. Candidates are not paired off:

1. Each member of a group is held against the group's hub, the member with the most company over all
   its groups (of a text and its edited copies, the text). These pairs are verified by their whole
   multisets, and links join into components.
2. Groups that still hold several components are compared in blocks of at most about ``BLOCK`` members, by
   longer signatures (``LONG`` components, a byte each). Only pairs of different components whose
   estimate is at most four deviations below ``similarity`` leave a block, each from its first common
   group alone; they are verified likewise. A hot group is many blocks, and no member is left out.

At the default parameters a pair of similarity 0.8 is no candidate with a probability of 5e-6, and is
passed over in a block with one of 3e-5.

Defined results: null and empty texts, and those without words, are copies of each other only where
their content is equal (null counts as empty). Equal rows are in one class; of several rows with the
id and content of the class's first document, one is the one to keep. A class's id is its smallest
id; null ids come last, and a class of null ids has a null id. Other columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import carried, dropped, staged
from riskspark.llm.words import U64, Words, as_bytes, in_chunks, mix, windows

CHUNK_BYTES = 1 << 20
BLOCK, LONG = 512, 1024
SLOT_ROWS = 4096  # that one call compares, block after block; a member is a row for each block of its group
_STEP, _SPLIT, _SHIFT = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def bags(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each different shingle of each text, in order of text and hash."""
    w = Words(texts)
    h = w.hashes()
    doc, value = [], []
    n = np.diff(w.first)
    ok = w.window_starts(shingle)
    full = windows(h, shingle)
    at = np.flatnonzero(ok)
    doc.append(w.doc[at])
    value.append(full[at])
    for k in range(1, shingle):
        short = np.flatnonzero(n == k)
        doc.append(short.astype(np.int32))
        value.append(windows(h, k)[w.first[short]] if len(short) else np.empty(0, U64))
    doc, value = np.concatenate(doc), np.concatenate(value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return doc[first], value[first], np.diff(np.append(first, len(doc)))


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, docs: int, m: int) -> np.ndarray:
    """The BagMinHash signature (``m`` point identities) of each text."""
    # A process for each shingle and interval of weights that it reaches into: 0: (0, 1], l: (2^(l-1), 2^l].
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0)
    rep = np.repeat(np.arange(len(doc)), levels + 1)
    level = np.arange(len(rep)) - np.repeat(np.cumsum(levels + 1) - (levels + 1), levels + 1)
    d, c = doc[rep].astype(np.int64), count[rep].astype(np.int64)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    size = np.where(level > 0, low, 1)
    seed = mix(value[rep] + level.astype(U64) * _SHIFT)
    per_doc = np.bincount(d, minlength=docs)
    points = -(-2 * m // np.maximum(per_doc, 1))  # of each process a round, so that small texts fill soon
    time, done = np.zeros(len(d)), np.zeros(len(d), np.int64)
    best = np.full((docs, m), np.inf)
    name = np.zeros((docs, m), U64)
    flat_best, flat_name = best.ravel(), name.ravel()
    active = np.arange(len(d))
    while len(active):
        j = points[d[active]]
        own = np.repeat(np.arange(len(active)), j)
        base = np.repeat(np.cumsum(j) - j, j)
        k = np.arange(len(own)) - base  # number of the point in this round
        who = active[own]
        r = mix(seed[who] + (done[who] + k + 1).astype(U64) * _STEP)
        wait = -np.log(((r >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size[who] * m)
        total = np.cumsum(wait)
        before = np.concatenate(([0.0], total))[np.cumsum(j) - j]
        x = time[who] + (total - before[own])
        q = mix(r ^ _SPLIT)
        slot = d[who] * m + ((q >> U64(32)) % U64(m)).astype(np.int64)
        weight = low[who] + 1 + ((q & U64(0xFFFFFFFF)) % size[who].astype(U64)).astype(np.int64)
        good = np.flatnonzero(weight <= c[who])
        good = good[x[good] < flat_best[slot[good]]]
        np.minimum.at(flat_best, slot[good], x[good])
        good = good[x[good] == flat_best[slot[good]]]
        flat_name[slot[good]] = r[good]
        last = np.cumsum(j) - 1
        time[active], done[active] = x[last], done[active] + j
        latest = best.max(axis=1)
        active = active[time[active] < latest[d[active]]]
    return name


def _bands(shingle: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                doc, value, count = bags(as_bytes(part.column("text")), shingle)
                s = signatures(doc, value, count, part.num_rows, bands * rows).reshape(-1, bands, rows)
                key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), s.shape[:2]).copy()
                for i in range(rows):
                    key = mix(key * _STEP + s[:, :, i])
                some = np.bincount(doc, minlength=part.num_rows) > 0
                ends = np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(key[some].ravel().view(np.int64)))],
                                                 names=["id", "node", "bands"])
    return run


def _long(shingle: int):
    """The longer signatures, the last byte of each component."""
    def run(batches):
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES >> 1):
                full = signatures(*bags(as_bytes(part.column("text")), shingle), part.num_rows, LONG)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([x.tobytes() for x in full.astype(np.uint8)], pa.binary())], names=["node", "long"])
    return run


def _compared(similarity: float):
    """The pairs of a slot's blocks that may be near copies of different components."""
    least = similarity - 4 * np.sqrt(similarity * (1 - similarity) / LONG)
    least = (least + (1 - least) / 256) * LONG  # components that agree, by chance those with another point too

    def run(table: pa.Table) -> pa.Table:
        key, lo, hi, block = (table.column(n).to_numpy() for n in ("key", "lo", "hi", "block"))
        node, root = np.array(table.column("node").to_pylist(), object), np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)[1]
        long = np.frombuffer(b"".join(table.column("long").to_pylist()), np.uint8).reshape(-1, LONG)
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        order = np.lexsort((hi, lo, key))
        new = np.flatnonzero((np.diff(key[order], prepend=0) != 0) | (np.diff(lo[order], prepend=-1) != 0) | (np.diff(hi[order], prepend=-1) != 0) | (np.arange(len(order)) == 0))
        out_a, out_b = [], []
        for x, y in zip(new, np.append(new[1:], len(order))):
            own = order[x:y]
            left = own[block[own] == lo[own[0]]]
            right = own if lo[own[0]] == hi[own[0]] else own[block[own] == hi[own[0]]]
            for at in range(0, len(left), 32):
                some = left[at : at + 32]
                i, j = np.nonzero((long[some][:, None, :] == long[right][None, :, :]).sum(axis=2) >= least)
                i, j = some[i], right[j]
                keep = (root[i] != root[j]) & ((i < j) if right is own else True)
                i, j = i[keep], j[keep]
                same = bands[i] == bands[j]
                first = bands[i, same.argmax(axis=1)] == key[i] if len(i) else np.empty(0, bool)
                out_a += node[i[first]].tolist()
                out_b += node[j[first]].tolist()
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})
    return run


def _similar(shingle: int):
    """The weighted Jaccard similarity of pairs of texts."""
    def run(batches):
        for batch in batches:
            size = 256
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                a, b = as_bytes(part.column("a_text")), as_bytes(part.column("b_text"))
                both = [x for pair in zip(a, b) for x in pair]
                doc, value, count = bags(both, shingle)
                pair, side = doc >> 1, doc & 1
                order = np.lexsort((side, value, pair))
                pair, value, count = pair[order], value[order], count[order]
                same = np.flatnonzero((pair[1:] == pair[:-1]) & (value[1:] == value[:-1]))
                least = np.bincount(pair[same], np.minimum(count[same], count[same + 1]), part.num_rows)
                total = np.bincount(pair, count, part.num_rows)
                most = total - least
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(np.where(most > 0, least / np.maximum(most, 1), 0.0))], names=["a", "b", "similarity"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of the linked nodes, by large and small stars; ``edges``: ``a``, ``b``."""
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        nxt = small.select("a", F.col("m").alias("b")).unionByName(small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        nxt = staged(nxt, "edges")
        now = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        dropped(edges)
        edges = nxt
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _blocks() -> Column:
    """The blocks of a group."""
    return F.ceil(F.col("size") / BLOCK)


def _dealt(members: DataFrame) -> DataFrame:
    """``members`` once for each block that theirs is compared with, in slots of about ``SLOT_ROWS`` such rows. One job runs."""
    rows = members.agg(F.sum(_blocks())).first()[0] or 0
    return (members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), _blocks() - 1))).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
            .withColumn("slot", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(max(1, rows // SLOT_ROWS)))).drop("other", "size"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
                    bands: int = 40, rows: int = 6) -> DataFrame:
    """One row for each document: the id column, ``node`` (its content), ``class_id``, ``copies`` (rows with its content)
    and ``keep`` (its id and content are those of the class's first). Jobs run when it is called."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))
    signed = staged(base.mapInArrow(_bands(shingle, bands, rows), "id long, node binary, bands array<long>"), "signed")
    nodes = staged(signed.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(keyed.join(groups, "key"), "members")
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    wanted = nodes.join(company, "node", "left_semi").select("node", F.col("id").alias("of"))
    texts = staged(base.join(wanted, "node").where(F.col("id").eqNullSafe(F.col("of"))).select("node", "text").dropDuplicates(["node"]), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("node").alias(x), F.col("text").alias(f"{x}_text")) for x in "ab")
        return staged(pairs.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text").mapInArrow(_similar(shingle), "a binary, b binary, similarity double"), "pairs")

    hubs = members.join(company, "node").groupBy("key").agg(F.max_by("node", F.struct("company", "node")).alias("hub"))
    tested = verified(members.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    links = tested.where(F.col("similarity") >= similarity).select("a", "b")
    roots = components(links)

    labelled = members.join(roots, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    open_ = staged(labelled.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), _blocks())), "open")
    inside = open_.select("node").distinct()
    details = staged(texts.join(inside, "node", "left_semi").mapInArrow(_long(shingle), "node binary, long binary").join(nodes.select("node", "bands"), "node"), "details")
    pairs = _dealt(open_).join(details, "node").groupBy("slot").applyInArrow(_compared(similarity), "a binary, b binary")
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    roots = components(links.unionByName(verified(pairs).where(F.col("similarity") >= similarity).select("a", "b")))
    dropped(members, texts, open_, details)
    of = nodes.join(roots, "node", "left").select("node", "id", "copies", F.coalesce("root", "node").alias("root"))
    first = of.groupBy("root").agg(F.min_by(F.struct("id", "node"), F.struct(F.col("id").isNull(), "id", "node")).alias("first"))
    classes = of.join(first, "root").select("node", "first", "copies")
    return signed.select("id", "node").join(classes, "node").select(
        F.col("id").alias(id_col), "node", F.col("first.id").alias("class_id"), "copies", (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("node") == F.col("first.node"))).alias("keep"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` with one document of each class of near copies."""
    keep = near_duplicates(docs, id_col, text_col, **parameters).where("keep").select(F.col(id_col).alias("_id"), F.col("node").alias("_node")).distinct()
    names, others = carried(docs, ())
    node = F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    rows = docs.select(others, node.alias("_node"), F.col(f"`{id_col}`").cast("long").alias("_id"))
    return (rows.join(keep.select(F.col("_id").alias("_kept"), "_node"), "_node").where(F.col("_id").eqNullSafe(F.col("_kept")))
            .dropDuplicates(["_node"]).select(*(F.col(f"others.`{c}`").alias(c) for c in names)))
