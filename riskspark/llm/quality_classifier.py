"""Text quality by supervised subword embeddings.

A word stands for itself and for its character n-grams (with ``<`` and ``>`` at its ends), each
hashed into one of ``BUCKETS`` rows of a table of learned vectors. Each place has one feature more, the
pattern of its word n-gram: is it the word one, two or three places before, and did it follow the
same word before in the text. A document's vector is the
mean over all of its words' features, and a softmax layer over it gives the label's probability.
Vectors and layer are trained together by stochastic gradient descent in numpy, on at most
``sample`` labelled documents, drawn by the hash of their ids (all of them if there are fewer).

In scoring, a document's logit is linear in its features, so the table folds into one number for
each bucket; each different word of a chunk is looked up once. Whole texts are read, in place.

Defined results: a null text is empty; an empty text has the score of the layer's bias. Labels that
are null, or not 0 or 1, are not learned from; a document with several labels is learned from with
each. Without any label the score is 0.5. Equal rows get equal scores. Other columns are returned
unchanged; the new columns replace any of the same name. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskspark.llm.stage import carried
from riskspark.llm.words import Words, as_bytes, in_chunks, span_hashes

CHUNK_BYTES = 1 << 20
BUCKETS = 1 << 16
PATTERNS = 16  # the last buckets
GRAMS = (3, 4, 5)
_LEAD = np.ones(256, bool)  # bytes that begin a character
_LEAD[0x80:0xC0] = False


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bucket of each feature of some words, in order of the words."""
    buf = np.frombuffer(b"".join(b"<%s>" % w for w in words), np.uint8)
    size = np.array([len(w) + 2 for w in words], np.int64)
    begin = np.cumsum(size) - size
    lead = np.flatnonzero(_LEAD[buf])
    word = np.searchsorted(begin, lead, "right") - 1
    number, hashes = [np.arange(len(words))], [span_hashes(buf, begin, begin + size)]
    ends = np.append(lead, len(buf))
    for n in GRAMS:
        if len(lead) >= n:
            at = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :])
            number.append(word[at])
            hashes.append(span_hashes(buf, lead[at], ends[at + n]))
    number, hashes = np.concatenate(number), np.concatenate(hashes)
    order = np.argsort(number, kind="stable")
    return number[order], (hashes[order] % np.uint64(BUCKETS - PATTERNS)).astype(np.int64)


class Chunk:
    """The words of some texts, each different word's features once, and the pattern of each place."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts)
        self.doc, self.docs, self.first = w.doc, len(texts), w.first
        h = w.hashes()
        _, first, self.word = np.unique(h, return_index=True, return_inverse=True)
        self.number, self.bucket = word_features([w.buf[w.start[i]:w.end[i]].tobytes() for i in first])
        self.features = np.bincount(self.number, minlength=len(first))
        pattern = np.zeros(len(w), np.int64)
        for back in (1, 2, 3):
            pattern[back:] |= ((h[back:] == h[:-back]) & (w.doc[back:] == w.doc[:-back])).astype(np.int64) << (back - 1)
        if len(w) > 1:
            pair = h[:-1] * np.uint64(3) + h[1:] + w.doc[1:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            again = np.ones(len(pair), bool)
            again[np.unique(pair, return_index=True)[1]] = False
            pattern[1:] |= (again & (w.doc[1:] == w.doc[:-1])).astype(np.int64) << 3
        self.pattern = pattern + BUCKETS - PATTERNS

    def logits(self, weight: np.ndarray, bias: float) -> np.ndarray:
        of_word = np.bincount(self.number, weight[self.bucket], len(self.features))
        total = np.bincount(self.doc, of_word[self.word] + weight[self.pattern], self.docs)
        return total / np.maximum(np.bincount(self.doc, self.features[self.word] + 1, self.docs), 1) + bias

    def bags(self):
        """For each text its buckets and the share of its features in each."""
        begin = np.concatenate(([0], np.cumsum(self.features)))
        for d in range(self.docs):
            own = slice(self.first[d], self.first[d + 1])
            words, times = np.unique(self.word[own], return_counts=True)
            have = [self.bucket[begin[x]:begin[x + 1]] for x in words]
            share = np.bincount(np.concatenate([*have, self.pattern[own]]), np.concatenate((np.repeat(times, self.features[words]), np.ones(own.stop - own.start))), BUCKETS)
            used = np.flatnonzero(share)
            yield used.astype("<u2"), (share[used] / max(share.sum(), 1)).astype("<f4")


def _bagged(batches):
    for batch in batches:
        for part in in_chunks(batch, CHUNK_BYTES):
            bags = list(Chunk(as_bytes(part.column("text"))).bags())
            yield pa.RecordBatch.from_arrays([part.column("label"), part.column("order"), pa.array([b.tobytes() for b, _ in bags], pa.binary()), pa.array([s.tobytes() for _, s in bags], pa.binary())],
                                             names=["label", "order", "buckets", "shares"])


def trained(labels: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], dims: int, epochs: int, rate: float, seed: int = 1) -> tuple[np.ndarray, float]:
    """Each bucket's contribution to the logit of label 1, and the bias, after gradient descent."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (BUCKETS, dims)).astype(np.float32)
    layer, bias = np.zeros((dims, 2), np.float32), np.log(np.array([np.mean(labels == 0) + 1e-3, np.mean(labels == 1) + 1e-3], np.float32))
    steps, batch = 0, 32
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            used = np.unique(np.concatenate([bags[i][0] for i in own]).astype(np.int64))
            x = np.zeros((len(own), len(used)), np.float32)
            for row, i in enumerate(own):
                x[row, np.searchsorted(used, bags[i][0])] = bags[i][1]
            v = vectors[used]
            hidden = x @ v
            out = hidden @ layer + bias
            p = np.exp(out - out.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), labels[own]] -= 1  # the gradient of the loss
            step = rate * (1 - steps / (epochs * -(-len(order) // batch)))
            vectors[used] = v - step * (x.T @ (p @ layer.T))
            layer -= step * (hidden.T @ p)
            bias -= step / len(own) * p.sum(axis=0)
            steps += 1
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _fitted(dims: int, epochs: int, rate: float):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("order").to_numpy(), kind="stable")
        buckets, shares = table.column("buckets").to_pylist(), table.column("shares").to_pylist()
        bags = [(np.frombuffer(buckets[i], "<u2"), np.frombuffer(shares[i], "<f4")) for i in order]
        weight, bias = trained(table.column("label").to_numpy()[order], bags, dims, epochs, rate)
        return pa.table({"weight": [weight.astype("<f4").tobytes()], "bias": [bias]}, schema=pa.schema([("weight", pa.binary()), ("bias", pa.float64())]))
    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = 4000, dims: int = 8, epochs: int = 5, rate: float = 4.0) -> tuple[np.ndarray, float]:
    """The model: a weight for each bucket, and a bias. ``learn``: which rows of ``labels`` it may learn from."""
    allowed = (labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
               .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"), F.xxhash64(id_col, label_col).alias("order")))
    share = min(1.0, 2 * sample / max(1, allowed.count()))  # so that few more than ``sample`` rows are sorted
    chosen = allowed.where(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("order").limit(sample)
    rows = (docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
            .join(F.broadcast(chosen), "_id")  # at most ``sample`` rows of three numbers
            .select("label", "order", "text"))
    bags = rows.mapInArrow(_bagged, "label int, order long, buckets binary, shares binary")
    model = bags.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fitted(dims, epochs, rate), "weight binary, bias double").collect()
    return (np.frombuffer(model[0].weight, "<f4"), model[0].bias) if model else (np.zeros(BUCKETS, np.float32), 0.0)


def _scored(model):
    def run(batches):
        weight, bias = model.value
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                z = Chunk(as_bytes(part.column("text"))).logits(weight, bias)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["row", "score"])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, and ``predicted``; ``keep``: the columns to return (all without it)."""
    names, others = carried(docs if keep is None else docs.select(*(F.col(f"`{c}`") for c in keep)), ("score", "predicted"))
    rows = docs.select(others.alias("row"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), StructType([rows.schema["row"], StructField("score", DoubleType())]))
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in names), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
