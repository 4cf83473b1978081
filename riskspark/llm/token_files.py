"""Token ids in binary files: frequency-ranked, byte-aligned codes with separate control bytes.

``write_ids`` reads the texts once and keeps their ids in a staged table. Every id of the corpus
is counted; the most frequent one gets rank 0, and so on. Then the ids are dealt out by ranges of
the document id, and each range is sorted and coded into one file: a rank takes 1 to 4 bytes, and
the lengths of four ranks share one control byte, so that no code has to be taken bit by bit.

The files lie under ``path/ids`` and are written by Spark's own writer, so a lost task leaves
no half file and any store that Spark writes to will do. A file is a run of blocks, each followed
by one newline byte. A block has a header of little-endian values (``HEADER``), then for each of
its documents the id (8 bytes), whether the id is null (1 byte) and the number of tokens (8
bytes), each kind by itself, then the control bytes, then the data bytes. ``path/ranks`` is a
Parquet table of ``rank`` and ``id``, ``path/shards`` one of the ids in each file.

``read_ids`` decodes the blocks with numpy: a table of 256 rows gives the four lengths of a
control byte, their running sum the place of each code, and the table of ranks the ids.

Ids are those that ``tokenizers`` gives for the whole text. The vocabulary drops white space and
lets no token cross it, so texts are cut there (and before a full stop or comma after an ASCII
letter or digit, where its pattern cuts too), each different piece is read once by the library,
and the pieces' ids are put together with numpy. Pieces already read are remembered by the Python
worker, up to ``MEMORY`` of them; that bounds memory and changes no result.

Defined results: a null or empty text is the end id alone. Every row is a document of its own;
documents ascend by id, null ids first, equal ids by the text's hash. Other columns are ignored.
An empty table gives an empty table (and no file).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.stage import dropped, staged
from riskspark.llm.words import LOWER, NOT_SPACE, as_bytes, in_chunks
from riskspark.session import scratch_path

CHUNK_BYTES = 1 << 22
BLOCK_IDS = 1 << 20
MEMORY = 800_000  # pieces remembered by a Python worker

#: The header of a block: mark, shard, block in the shard, ids in the shard before it, documents, ids, data bytes.
MARK = 0x31444954
HEADER = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("block", "<u8"), ("before", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("data", "<u8")])

#: The steps before the merges of the vocabulary whose texts may be cut.
STEPS = [["NFC", None], ["Replace", r"\s+"], ["Lowercase", None],
         ["Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"], ["ByteLevel", None]]

#: Letters that these steps leave as they are, but for the names of their bytes: a to z and the small letters of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_WORD = re.compile(f"[{LETTERS}]+")

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit ``ranks``."""
    r = ranks.astype("<u4")
    extra = (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[: len(r)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    return control.tobytes(), r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of control and data bytes."""
    length = _LENGTHS[control].ravel()[:n]
    at = np.cumsum(length, dtype=np.int64) - length
    out = data[at].astype(np.uint32)
    for j in (1, 2, 3):
        more = np.flatnonzero(length > j)
        out[more] |= data[at[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


class _Reader:
    """The ids of many texts by way of their different pieces."""

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        path = path or public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path) as f:
            spec = json.load(f)
        parts = [*(spec.get("normalizer") or {}).get("normalizers", []), *(spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        steps = [[x.get("type"), x.get("pattern", {}).get("Regex")] for x in parts]
        self.cuts = steps == STEPS  # a vocabulary with other steps reads whole texts
        self.letters = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LETTERS} if self.cuts else {}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pieces = self.used = 0
        self.ids, self.first, self.count = np.empty(1 << 16, "<u4"), np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def _ids(self, pieces: list[bytes]) -> list[list[int]]:
        """The library's ids of each piece. One word of letters that its steps leave alone goes to the merges at once."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        words = [bool(_WORD.fullmatch(t)) for t in texts] if self.cuts else [False] * len(texts)
        other = iter(self.tokenizer.encode_batch_fast([t for t, w in zip(texts, words) if not w], add_special_tokens=False))
        merges = self.tokenizer.model.tokenize
        return [[x.id for x in merges(t.translate(self.letters))] if w else next(other).ids for t, w in zip(texts, words)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Read pieces that are not known yet."""
        lists = self._ids(pieces)
        n = np.array([len(x) for x in lists], np.int64)
        at, ends = self.pieces, self.used + np.cumsum(n)
        while ends[-1] > len(self.ids):
            self.ids = np.append(self.ids, np.empty(len(self.ids), "<u4"))
        while at + len(n) > len(self.first):
            self.first, self.count = (np.append(x, np.empty(len(x), np.int64)) for x in (self.first, self.count))
        self.ids[self.used:ends[-1]] = np.fromiter(chain.from_iterable(lists), "<u4")
        self.first[at:at + len(n)], self.count[at:at + len(n)] = ends - n, n
        self.known.update(zip(pieces, range(at, at + len(n))))
        self.pieces, self.used = at + len(n), int(ends[-1])

    def _begins(self, buf: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Where pieces begin: after white space, and at a full stop or comma after an ASCII letter or digit."""
        plain = ((buf >= 0x61) & (buf <= 0x7A)) | ((buf >= 0x41) & (buf <= 0x5A)) | ((buf >= 0x30) & (buf <= 0x39))
        start = inside.copy()
        start[1:] &= ~inside[:-1] | (plain[:-1] & ((buf[1:] == 0x2E) | (buf[1:] == 0x2C)))
        return np.flatnonzero(start)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts``, one after the other, and the number of each text's."""
        if not self.cuts:
            lists = self._ids(texts)
            return np.fromiter(chain.from_iterable(lists), "<u4"), np.array([len(x) for x in lists], np.int64)
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, np.uint8)
        if b"<|" not in joined:  # else lower case might make a special token's string
            buf = LOWER[buf]
        inside = NOT_SPACE[buf]
        begin = self._begins(buf, inside)
        # The bytes of all pieces without what lies between them; a piece ends where the next begins.
        kept = np.concatenate(([0], np.cumsum(inside)))
        offsets = np.append(kept[begin], kept[-1]).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])]).dictionary_encode()
        different = pieces.dictionary.to_pylist()
        if len(self.known) + len(different) > MEMORY or self.used > 16 * MEMORY:
            self._forget()
        new = [p for p in different if p not in self.known]
        if new:
            self._learn(new)
        which = np.array([self.known[p] for p in different], np.int64)[pieces.indices.to_numpy(zero_copy_only=False)]
        n = self.count[which]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = self.ids[np.repeat(self.first[which] - total[:-1], n) + np.arange(total[-1])]
        ends = np.cumsum([len(t) + 1 for t in texts])
        return ids, np.diff(total[np.searchsorted(begin, np.concatenate(([0], ends)))])


@lru_cache(2)
def _reader(path: str | None) -> _Reader:
    return _Reader(path)


def _slices(text: bytes):
    """A text in slices of about CHUNK_BYTES that end before white space."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        space = np.flatnonzero(~NOT_SPACE[np.frombuffer(text, np.uint8, min(len(text) - at - CHUNK_BYTES, CHUNK_BYTES), at + CHUNK_BYTES)])
        upto = at + CHUNK_BYTES + int(space[0]) if len(space) else min(len(text), at + 2 * CHUNK_BYTES)
        if not len(space):  # no white space in reach: the first one after it, or the rest
            far = [i for i in (text.find(bytes([c]), upto) for c in np.flatnonzero(~NOT_SPACE)) if i >= 0]
            upto = min(far, default=len(text))
        yield text[at:upto]
        at = upto
    yield text[at:]


def _texts(reader: _Reader, part, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts in a slice of a batch, each with its end id, and the number of each."""
    texts = as_bytes(part.column("text"))
    if len(texts) == 1 and len(texts[0]) > 2 * CHUNK_BYTES:
        ids = np.concatenate([reader.read([s])[0] for s in _slices(texts[0])])
        n = np.array([len(ids)])
    else:
        ids, n = reader.read(texts)
    return np.insert(ids, np.cumsum(n), end).astype("<u4"), n + 1


def _read(path: str | None, end: int, kind: str):
    """The ids of each text as one binary value."""
    def run(batches):
        reader = _reader(path)
        for batch in batches:
            for part in in_chunks(batch, CHUNK_BYTES):
                flat, n = _texts(reader, part, end)
                ends = np.concatenate(([0], np.cumsum(n))) * np.dtype(kind).itemsize
                raw = flat.astype(kind).tobytes()
                cells = pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), cells], names=["id", "key", "ids"])
    return run


def _counts(kind: str):
    """The ids of a task's texts and how often each occurs."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind), minlength=len(total))
            found[:len(total)] += total
            total = found
        have = np.flatnonzero(total)
        if len(have):
            yield pa.RecordBatch.from_arrays([pa.array(have, pa.int64()), pa.array(total[have], pa.int64())], names=["id", "n"])
    return run


def _blocks(kind: str, rank: np.ndarray):
    """The blocks of a sorted range of documents."""
    def run(batches):
        shard = TaskContext.get().partitionId()
        number = before = 0

        def block(keys, cells):
            nonlocal number, before
            n = np.array([len(c) // np.dtype(kind).itemsize for c in cells], "<u8")
            flat = np.frombuffer(b"".join(cells), kind)
            control, data = encode_ranks(rank[flat])
            head = np.array([(MARK, shard, number, before, len(n), len(flat), len(data))], HEADER)
            null = keys.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            out = b"".join([head.tobytes(), keys.fill_null(0).to_numpy().astype("<i8").tobytes(), null.tobytes(), n.tobytes(), control, data])
            number, before = number + 1, before + len(flat)
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["block"])

        for batch in batches:
            cells = batch.column("ids").to_pylist()
            held = np.cumsum([len(c) // np.dtype(kind).itemsize for c in cells])
            cut = [0, *(np.flatnonzero(np.diff(held // BLOCK_IDS)) + 1), len(cells)]
            for a, b in zip(cut, cut[1:]):
                if b > a:
                    yield block(batch.column("id").slice(a, b - a), cells[a:b])
    return run


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 2,
              vocabulary: str | None = None, shard_ids: int = 1 << 25) -> None:
    """Write the ids of every text under ``path``, in files of about ``shard_ids`` ids (or, where the session has more
    shuffle partitions than that makes, as many files). ``vocabulary``: the file for ``tokenizers``; by default the
    public word-level one of 49k."""
    spark = docs.sparkSession
    size = _reader(vocabulary).size
    kind = "<u2" if max(size, end + 1) <= 1 << 16 else "<u4"
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("key"), F.col(f"`{text_col}`").alias("text"))
    ids = staged(docs.mapInArrow(_read(vocabulary, end, kind), "id long, key long, ids binary"), "ids", compression="zstd")
    # At most one row for each id of the vocabulary comes back.
    counts = ids.select("ids").mapInArrow(_counts(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    order = sorted((-r.n, r.id) for r in counts)
    rank = np.zeros(max(size, end + 1), "<u4")
    rank[[i for _, i in order]] = np.arange(len(order))
    spark.createDataFrame([(k, i) for k, (_, i) in enumerate(order)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    parts = max(-(-sum(-n for n, _ in order) // shard_ids), int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = F.asc_nulls_first("id"), F.col("key")
    blocks = ids.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("id", "ids").mapInArrow(_blocks(kind, rank), "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("compression", "none").text(f"{path}/ids")
    dropped(ids)
    shards = _files(spark, path).mapInArrow(_headers, "shard long, block long, before long, ids long").groupBy("shard").agg(F.max(F.col("before") + F.col("ids")).alias("ids"))
    shards.coalesce(1).write.parquet(f"{path}/shards")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").select("content")


def _each_block(content: bytes):
    """The header and the bytes after it of every block of a file."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, HEADER, 1, at)[0]
        if head["mark"] != MARK:
            raise ValueError(f"no block at byte {at}")
        at += HEADER.itemsize
        size = int(head["docs"]) * 17 + -(-int(head["ids"]) // 4) + int(head["data"])
        yield head, np.frombuffer(content, np.uint8, size, at)
        at += size + 1


def _headers(batches):
    for batch in batches:
        for content in batch.column("content"):
            heads = [tuple(int(h[k]) for k in ("shard", "block", "before", "ids")) for h, _ in _each_block(content.as_py())]
            if heads:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*heads)], names=["shard", "block", "before", "ids"])


def _decoded(first: dict[int, int], ids_of: np.ndarray, whole: bool):
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for head, body in _each_block(content.as_py()):
                    d, n = int(head["docs"]), int(head["ids"])
                    keys, null, lengths = body[:8 * d].copy().view("<i8"), body[8 * d:9 * d].astype(bool), body[9 * d:17 * d].copy().view("<u8").astype(np.int64)
                    control = body[17 * d:17 * d + -(-n // 4)]
                    ids = ids_of[decode_ranks(control, body[17 * d + len(control):], n)]
                    upto = np.cumsum(lengths)
                    start = first[int(head["shard"])] + int(head["before"]) + upto - lengths
                    raw = ids.tobytes()
                    cells = [raw[4 * a:4 * b] for a, b in zip(upto - lengths, upto)]
                    last = pa.array(cells, pa.binary()) if whole else pa.array([zlib.crc32(c) for c in cells], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64(), mask=null), pa.array(start, pa.int64()), pa.array(lengths, pa.int64()), last],
                                                     names=["id", "start", "n_tokens", "ids" if whole else "ids_crc32"])
    return run


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id", checksums: bool = False) -> DataFrame:
    """The documents of the files under ``path``: the id, ``start`` (ids of all documents before it), ``n_tokens``, and
    ``ids`` (little-endian unsigned 32-bit), or with ``checksums`` their ``ids_crc32``.

    Comes to the driver: the ranks (at most the vocabulary) and the ids in each file (two numbers a file)."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()
    ids_of = np.zeros(len(ranks), "<u4")
    ids_of[[r["rank"] for r in ranks]] = [r.id for r in ranks]
    first, total = {}, 0
    for shard, n in sorted(tuple(r) for r in spark.read.schema("shard long, ids long").parquet(f"{path}/shards").select("shard", "ids").collect()):
        first[shard], total = total, total + n
    kind = "id long, start long, n_tokens long, " + ("ids_crc32 long" if checksums else "ids binary")
    return _files(spark, path).mapInArrow(_decoded(first, ids_of, not checksums), kind).withColumnRenamed("id", id_col)


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: int = 2, vocabulary: str | None = None) -> str:
    """``write_ids`` to a fresh folder of the shared one; its path."""
    path = scratch_path(docs.sparkSession, "llm-token-ids")
    write_ids(docs, path, id_col, text_col, end, vocabulary)
    return path
