"""A hashed maximum-entropy language model with class-factored softmax.

``P(word | history) = P(class | history) P(word | class)``. The most frequent tokens are classes
of their own, the end of a text is one, and every other word has the class of its shape (its first
two bytes, hashed, and whether it ends with a mark), which also holds for words never seen.

* The class is a softmax over features of the history: the word before, the word two places before
  (a skip), and the classes of both together. A frequent word is a feature of its own; others share
  hashed features by their first three bytes and their ending.
* Within a class, a word has the probability (count + 1) / (tokens + words + 1) of its class; the
  share that is left is that of all unseen words. This is the softmax with one feature a word.

Training runs over all texts that may be learned from, in ``ROUNDS`` parts. In each round, every task
starts from the same weights, takes gradient steps over batches of its tokens, and returns what it
added to each feature, with the feature's count; the additions are averaged by count in steps of
bounded groups. Counts of all tokens come from one aggregation. The most frequent tokens, ``KNOWN`` at
most, are sent to the tasks; every rarer token gets its count in a join, so none is left out.

Tokens are the words, A-Z lower-cased, and one end a text. They are told apart by 64-bit hashes.

Defined results: a null text is empty: its end is its only token. Rows whose ``learn`` is null are not
learned from. Without any training text every score is that of unseen tokens. Equal texts get equal
scores. Other columns are returned unchanged; the new columns replace any of the same name. An empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from riskspark.llm.marks import cells
from riskspark.llm.stage import carried, dropped, staged
from riskspark.llm.words import U64, Words, as_bytes, in_chunks, mix

COUNT_BYTES, CHUNK_BYTES, BATCH = 4 << 20, 1 << 20, 8192
KNOWN = 1 << 17
OWN = 24  # classes of single tokens, the end's among them
SHAPES = 16
CLASSES = OWN + SHAPES
RANKED, SHARED = 4096, 4096  # features of a word: its own, or a hashed one
ROWS = 2 * (RANKED + SHARED) + CLASSES * CLASSES
ROUNDS, RATE = 2, 0.2
BLOCKS, GROUP = 16, 64
END = 0x0E4D0E4D0E4D0E4D  # the hash of the end of a text
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?")] = True


class Tokens:
    """The tokens of some texts: ``doc`` of each, ``word``: its number among the different ones."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, lower=True)
        n, docs = len(w), len(texts)
        h = np.empty(n + docs, U64)
        self.doc = np.repeat(np.arange(docs), np.diff(w.first) + 1)
        at, ends = np.arange(n) + w.doc, w.first[1:] + np.arange(docs)
        h[at], h[ends] = w.hashes(), U64(END)
        self.first = w.first[:-1] + np.arange(docs)
        self.hash, some, self.word = np.unique(h, return_index=True, return_inverse=True)
        where = np.full(n + docs, -1)
        where[at] = np.arange(n)
        self.sample = where[some]  # a word of the buffer for each different token, -1: the end
        self.buf, self.start, self.end = w.buf, w.start, w.end

    def shape(self) -> tuple[np.ndarray, np.ndarray]:
        """Class (if not one of its own) and shared feature of each different token."""
        s, e = (np.where(self.sample >= 0, x[np.maximum(self.sample, 0)] if len(x) else 0, 0) for x in (self.start, self.end))
        size = e - s
        byte = [np.where(size > i, self.buf[np.minimum(s + i, len(self.buf) - 1)], 0).astype(U64) for i in range(3)]
        marked = (_MARKS[self.buf[np.maximum(e - 1, 0)]] & (size > 0)).astype(U64)
        two = mix(byte[0] * U64(256) + byte[1] + U64(1))
        three = mix(two + byte[2] * U64(3) + marked)
        return (OWN + (two % U64(SHAPES // 2)) * U64(2) + marked).astype(np.int64), (RANKED + three % U64(SHARED)).astype(np.int64)


@dataclass
class Model:
    """``hashes`` (sorted), ``counts`` and ``ranks`` of the known tokens; sums and numbers of words by class; weights."""

    hashes: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    tokens: np.ndarray
    words: np.ndarray
    total: int
    distinct: int
    weights: np.ndarray

    def looked_up(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count (-1: not known here), class and feature of each different token."""
        shape, shared = t.shape()
        count = np.full(len(t.hash), -1, np.int64)
        rank = np.full(len(t.hash), KNOWN)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, t.hash), len(self.hashes) - 1)
            here = self.hashes[at] == t.hash
            count[here], rank[here] = self.counts[at[here]], self.ranks[at[here]]
        own = np.where(rank < OWN - 1, rank + 1, shape)
        kind = np.where(t.hash == U64(END), 0, own)
        return count, kind, np.where(rank < RANKED, rank, shared)

    def histories(self, t: Tokens, kind: np.ndarray, feature: np.ndarray) -> list[np.ndarray]:
        """The rows of the weights for each token: of the word before, two before, and both classes."""
        end = np.searchsorted(t.hash, U64(END))  # every chunk has an end
        last = np.concatenate(([end], t.word[:-1]))
        last2 = np.concatenate(([end], last[:-1]))
        last2[t.first] = end
        return [feature[last], RANKED + SHARED + feature[last2], 2 * (RANKED + SHARED) + kind[last] * CLASSES + kind[last2]]

    def bias(self) -> np.ndarray:
        return np.log((self.tokens + 1.0) / (self.tokens + 1.0).sum()).astype(np.float32)


def _probabilities(weights: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _counted(batches):
    for batch in batches:
        for part in in_chunks(batch, COUNT_BYTES):
            t = Tokens(as_bytes(part.column("text")))
            kind = np.where(t.hash == U64(END), 0, t.shape()[0])
            yield pa.RecordBatch.from_arrays([pa.array(t.hash.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(np.bincount(t.word).astype(np.int64))], names=["hash", "kind", "n"])


def _stepped(model):
    """Gradient steps over a task's tokens; each feature's sum of additions and count, by block of features."""
    def run(batches):
        m: Model = model.value
        w, bias = m.weights.copy(), m.bias()
        size = np.full(ROWS, 1.0, np.float32)  # sums of squared gradients
        times = np.zeros(ROWS, np.int64)
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                t = Tokens(as_bytes(part.column("text")))
                _, kind, feature = m.looked_up(t)
                rows, want = m.histories(t, kind, feature), kind[t.word]
                for at in range(0, len(want), BATCH):
                    own = [r[at : at + BATCH] for r in rows]
                    g = _probabilities(w, bias, own)
                    g[np.arange(len(g)), want[at : at + BATCH]] -= 1
                    for r in own:
                        order = np.argsort(r, kind="stable")
                        s = r[order]
                        cut = np.flatnonzero(np.diff(s, prepend=-1))
                        add = np.add.reduceat(g[order], cut, axis=0)
                        have = s[cut]
                        size[have] += np.square(add).mean(axis=1)
                        w[have] -= RATE * add / np.sqrt(size[have])[:, None]
                        times[have] += np.diff(np.append(cut, len(s)))
        used = np.flatnonzero(times)
        added = (w[used] - m.weights[used]) * times[used][:, None]
        yield _blocks(TaskContext.get().partitionId(), used, times[used], added)
    return run


def _blocks(task: int, rows: np.ndarray, times: np.ndarray, added: np.ndarray) -> pa.RecordBatch:
    block = rows % BLOCKS
    have = np.unique(block)
    scale = np.maximum(times, 1)[:, None]
    parts = ([x[block == b].tobytes() for b in have] for x in (rows.astype("<i4"), times.astype("<i8"), (added / scale).astype("<f2")))
    return pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(np.full(len(have), task, np.int64)), *(pa.array(p, pa.binary()) for p in parts)],
                                      names=["block", "task", "rows", "times", "added"])


_ADDED = "block int, task long, rows binary, times binary, added binary"


def _averaged(table: pa.Table) -> pa.Table:
    """The additions of up to GROUP tasks to one block, as one."""
    rows, times = cells(table.column("rows"), "<i4"), cells(table.column("times"), "<i8")
    added = cells(table.column("added"), "<f2").reshape(len(rows), CLASSES).astype(np.float64) * times[:, None]
    have, number = np.unique(rows, return_inverse=True)
    total = np.zeros((len(have), CLASSES))
    np.add.at(total, number, added)
    return pa.Table.from_batches([_blocks(table.column("task")[0].as_py(), have, np.bincount(number, times, len(have)).astype(np.int64), total)])


def _scored(model):
    def run(batches):
        m: Model = model.value
        bias = m.bias()
        inside = np.log10(m.tokens + m.words + 1.0)
        whole = np.log10(m.total + m.distinct + 1.0)
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                t = Tokens(as_bytes(part.column("text")))
                count, kind, feature = m.looked_up(t)
                rows, want = m.histories(t, kind, feature), kind[t.word]
                log = np.empty(len(want))
                for at in range(0, len(want), BATCH):
                    p = _probabilities(m.weights, bias, [r[at : at + BATCH] for r in rows])
                    log[at : at + BATCH] = np.log10(p[np.arange(len(p)), want[at : at + BATCH]])
                log -= inside[want]
                up = np.log10(np.maximum(count, 0) + 1.0)[t.word]
                docs = part.num_rows
                n = np.bincount(t.doc, minlength=docs)
                shared = np.bincount(t.doc, up, docs)
                # What may be in the table of the rarer tokens: its hashes, text by text.
                rare = np.flatnonzero(count[t.word] < 0)
                ends = np.concatenate(([0], np.cumsum(np.bincount(t.doc[rare], minlength=docs)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("others"), pa.array(n), pa.array(np.bincount(t.doc, count[t.word] > 0, docs).astype(np.int64)),
                     pa.array(shared - n * whole), pa.array(np.bincount(t.doc, log, docs) + shared),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(t.hash[t.word[rare]].view(np.int64)))],
                    names=["others", "n_tokens", "n_known", "base_score", "score", "rare"])
    return run


def language_scores(docs: DataFrame, learn: Column, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known`` (tokens with a count), ``train_tokens``, ``base_score`` (add-one unigram) and
    ``score`` (log10 probability of the text). ``learn``: the rows to learn from; ``keep``: the columns
    to return (all of them without it). Jobs run when it is called."""
    spark = docs.sparkSession
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    names, others = carried(docs if keep is None else docs.select(*(F.col(f"`{c}`") for c in keep)), new)
    text = F.col(f"`{text_col}`")
    train = docs.where(F.coalesce(learn, F.lit(False))).select(text.alias("text"), F.pmod(F.xxhash64(text), F.lit(ROUNDS)).alias("round"))

    counts = staged(train.select("text").mapInArrow(_counted, "hash long, kind int, n long").groupBy("hash", "kind").agg(F.sum("n").alias("n")), "counts")
    by_kind = {r.kind: (r.n, r.words) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()}
    # The known tokens are those from a count on that at most KNOWN tokens have; a histogram of counts tells it.
    size = F.floor(F.log2("n") * 16)
    cut, known = None, 0
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["size"]):
        known += r.words
        if known > KNOWN:
            break
        cut = r["size"]
    everything = known <= KNOWN
    top = counts.where(F.lit(False) if cut is None else size >= cut).toArrow()
    order = np.lexsort((top.column("hash").to_numpy(), -top.column("n").to_numpy()))
    hashes, n, kinds = top.column("hash").to_numpy()[order].view(U64), top.column("n").to_numpy()[order], top.column("kind").to_numpy()[order]
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for kind, (a, b) in by_kind.items():
        tokens[kind], words[kind] = a, b
    own = np.flatnonzero(hashes != U64(END))[: OWN - 1]
    ranks = np.full(len(n), KNOWN - 1)
    ranks[own] = np.arange(len(own))
    rest = np.setdiff1d(np.arange(len(n)), own)
    ranks[rest] = np.arange(len(own), len(own) + len(rest))
    for rank, i in enumerate(own):  # tokens that leave their shape's class for one of their own
        tokens[kinds[i]] -= n[i]
        words[kinds[i]] -= 1
        tokens[rank + 1], words[rank + 1] = n[i], 1
    order = np.argsort(hashes)
    model = Model(hashes[order], n[order], ranks[order], tokens, words, sum(x[0] for x in by_kind.values()), sum(x[1] for x in by_kind.values()), np.zeros((ROWS, CLASSES), np.float32))

    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        added = staged(train.where(F.col("round") == r).select("text").mapInArrow(_stepped(sent), _ADDED), "steps")
        tasks = (added.agg(F.max("task")).first()[0] or 0) + 1
        while tasks > 1:
            fewer = staged(added.withColumn("task", F.floor(F.col("task") / GROUP)).groupBy("block", "task").applyInArrow(_averaged, _ADDED), "steps")
            dropped(added)
            added, tasks = fewer, -(-tasks // GROUP)
        weights = model.weights.copy()
        for x in added.collect():  # one row a block
            weights[np.frombuffer(x.rows, "<i4")] += np.frombuffer(x.added, "<f2").reshape(-1, CLASSES).astype(np.float32)
        dropped(added)
        sent.unpersist()
        model.weights = weights

    base = docs.select(others, text.alias("text"))
    fields = [base.schema["others"], StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()),
              StructField("rare", ArrayType(LongType()))]
    scored = staged(base.mapInArrow(_scored(spark.sparkContext.broadcast(model)), StructType(fields)).withColumn("row", F.monotonically_increasing_id()), "scores")
    out = scored.withColumn("train_tokens", F.lit(int(model.total)).cast("long"))
    if not everything:
        rarer = counts.where(F.lit(True) if cut is None else size < cut).select("hash", "n")
        found = (scored.select("row", F.explode("rare").alias("hash")).groupBy("row", "hash").agg(F.count(F.lit(1)).alias("times")).join(rarer, "hash")
                 .groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("up")))
        out = out.join(found, "row", "left")
    else:
        out = out.withColumn("known", F.lit(0)).withColumn("up", F.lit(0.0))
    up = F.coalesce("up", F.lit(0.0))
    return out.select(*(F.col(f"others.`{c}`").alias(c) for c in names), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"), "train_tokens",
                      (F.col("base_score") + up).alias("base_score"), (F.col("score") + up).alias("score"))
