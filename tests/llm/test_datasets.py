"""Centroid clustering, Merkle manifests and token files."""

import os
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import riskspark.llm.centroids as centroids
import riskspark.llm.token_files as files
from riskspark.llm.merkle import lower_case, manifest
from riskspark.session import scratch_path

LANG = "doc_id long, lang string, text string"


def vectors(rng, n, dims, groups):
    means = rng.normal(size=(groups, dims))
    return [(i, [float(x) for x in means[rng.integers(groups)] + 0.15 * rng.normal(size=dims)]) for i in range(n)]


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 300, 6, 7)
    rows += [rows[0]] * 40 + [(None, rows[1][1]), (None, rows[2][1]), (900, None), (901, [0.5] * 5), (902, [0.5] * 5 + [None]), (903, [float("nan")] * 6),
                              (904, [float("inf")] + [0.0] * 5), (905, []), (906, [-0.0] * 6), (907, [1e-3, -1e-3] * 3)]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance string").repartition(5)
    kept = [(r.vec_id, r.embedding) for r in frame.collect()]
    for k, rounds in ((4, 3), (9, 2), (1, 1)):
        out, middle = centroids.cluster_vectors(frame, k=k, rounds=rounds, dims=6, scale=64)
        want, where = brute.clusters(kept, k, rounds, 6, 64, "1")
        key = lambda r: (r[0] is not None, r)
        assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)
        assert middle == where
        full = centroids.with_inertia(out, middle)
        assert full.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        sums = {}
        for _, c, d in want:
            sums[c] = sums.get(c, 0) + d
        got = {(r.cluster, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in full.collect()}
        assert got == {(c, s, sum(sums.values()), brute.sha(",".join(map(str, where[c])))) for c, s in sums.items()}


def test_clusters_of_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    out, middle = centroids.cluster_vectors(frame, dims=2)
    assert middle == [[64, 128]] * 2 and sorted(tuple(r) for r in out.collect()) == [(1, 0, 0), (2, 0, 0)]  # ties go to the smaller number
    for none in (frame.limit(0), frame.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"))):
        out, middle = centroids.cluster_vectors(none, dims=2)
        assert middle == [] and centroids.with_inertia(out, middle).count() == 0


def test_components_are_held_within_64_bits(spark):
    frame = spark.createDataFrame([(1, [3e38, -3e38]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    out, middle = centroids.cluster_vectors(frame, k=1, rounds=1, dims=2)
    assert all(0 < r.distance < 1 << 63 for r in out.collect())
    assert centroids.with_inertia(out, middle).first().inertia > 0


def test_bounds_never_pass_the_distance():
    rng = np.random.default_rng(5)
    for scale in (3, 1000, 1 << 26):
        v = rng.integers(-scale, scale + 1, (400, 8))
        v[:50] = v[0]  # pivots that are equal, and vectors on a pivot
        pivots, middle = v[:12], v[30:60]
        bounds = centroids.Bounds(pivots, middle)
        to = np.stack([((v - p) ** 2).sum(1) for p in pivots], 1)
        exact = ((v[:, None] - middle[None]) ** 2).sum(2)
        assert (bounds.below(to) <= exact).all()
        cluster, distance, _ = bounds.nearest(v, to)
        assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_bounds_spare_distances_of_vectors_in_groups():
    rng = np.random.default_rng(6)
    v = np.floor(64 * np.array([x for _, x in vectors(rng, 4000, 8, 16)])).astype(np.int64)
    middle = v[:16]
    to = np.stack([((v - p) ** 2).sum(1) for p in v[:centroids.PIVOTS]], 1)
    assert centroids.Bounds(v[:centroids.PIVOTS], middle).nearest(v, to)[2] < 0.5 * len(v) * len(middle)


def proofs(frame, **more):
    return [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in manifest(frame, ("doc_id", "lang", "text"), **more).collect()]


@pytest.mark.parametrize("sizes", [(70, 9, 8, 1, 1), (1,), (20,), (1, 1), (3, 300)])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    langs = [None, "", "en", "é", "zz"]
    rows = [(rng.choice([None, *range(-5, 400)]), langs[k], rng.choice([None, "", "Some Text", "éÀB c", "plain"])) for k, n in enumerate(sizes) for _ in range(n)]
    rows += rows[:1] * (3 if len(sizes) > 2 else 0)  # rows that are equal
    rng.shuffle(rows)
    forged = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
    want = brute.merkle(rows, lambda r: (*r[:2], brute.lower(r[2]) if r[2] is not None else None) if forged(r) else r)
    got = proofs(spark.createDataFrame(rows, LANG).repartition(4), tampered={"text": lower_case(F.col("text"))}, tampers=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[-1] for r in got} <= {True, False}


def test_manifest_with_another_fanout_and_large_sides(spark, monkeypatch):
    import riskspark.llm.merkle as merkle
    monkeypatch.setattr(merkle, "SMALL_NODES", 0)  # no side is sent to all tasks
    rows = [(i, f"l{i % 40}" if i % 2 else "hot", f"T{i}") for i in range(400)]
    assert sorted(proofs(spark.createDataFrame(rows, LANG), fanout=3)) == sorted(brute.merkle(rows, lambda r: r, 3))


def test_manifest_odd_rows(odd, empty):
    frame = odd.withColumn("lang", F.col("source"))
    got = proofs(frame)
    rows = [(r.doc_id, r.lang, r.text) for r in frame.collect()]
    assert sorted(got, key=repr) == sorted(brute.merkle(rows, lambda r: r), key=repr)
    assert all(r[-1] for r in got)
    assert proofs(empty.withColumn("lang", F.col("source"))) == []


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(plain, rows, end=2):
    """(id, start, n, ids) in file order; rows in that order."""
    out, start = [], 0
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def round_trip(spark, frame, **more):
    path = scratch_path(spark, "test-ids")
    files.write_ids(frame, path, **more)
    return path, [tuple(r) for r in files.read_ids(spark, path).orderBy("start").collect()]


def test_token_files_round_trip(spark, plain, monkeypatch):
    monkeypatch.setattr(files, "BLOCK_IDS", 300)
    rng = random.Random(8)
    words = ["Hello", "world,", "it's", "DON'T", "é", "e\u0301", "x1.5", "...", "a.b.", "Σ", "ΑΣ", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "\u00a0", "\u2028", "日本", "naïve.", "ß", "k" * 300]
    rows = [(i, rng.choice([None, ""]) if i % 19 == 0 else rng.choice([" ", "\n", "\t ", ""]).join(rng.choice(words) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path, got = round_trip(spark, frame, shard_ids=1000)
    assert got == expected(plain, rows)
    sums = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in files.read_ids(spark, path, checksums=True).collect()}
    assert sums == {i: (s, n, zlib.crc32(b)) for i, s, n, b in got}
    # The ids ascend by document through the files, in the order of their names.
    folder = path.removeprefix("file:") + "/ids"
    seen = []
    for name in sorted(n for n in os.listdir(folder) if n.startswith("part-")):
        with open(f"{folder}/{name}", "rb") as f:
            for head, body in files._each_block(f.read()):
                seen += np.frombuffer(body[:8 * int(head["docs"])].tobytes(), "<i8").tolist()
    assert seen == list(range(150))
    # The most frequent id has rank 0.
    ranks = {r["rank"]: r.id for r in spark.read.parquet(f"{path}/ranks").collect()}
    counts = np.bincount(np.concatenate([np.frombuffer(b, "<u4") for *_, b in got]))
    assert [ranks[k] for k in range(len(ranks))] == sorted(np.flatnonzero(counts), key=lambda i: (-counts[i], i))


def test_token_files_odd_rows(spark, plain, odd, empty):
    _, got = round_trip(spark, odd)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text", F.xxhash64("text").alias("k")).orderBy(F.asc_nulls_first("doc_id"), "k").collect()]
    assert got == expected(plain, rows)
    assert round_trip(spark, empty)[1] == []
    assert round_trip(spark, empty.unionByName(odd.where("text is null")))[1] == expected(plain, [(None, None), (2, None)])


def test_token_files_of_another_vocabulary(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "Some  text"), (2, " more\n\ntext")]
    _, got = round_trip(spark, spark.createDataFrame(rows, "doc_id long, text string"), vocabulary=path, end=70_000)
    assert got == expected(Tokenizer.from_file(path), rows, 70_000)


def test_very_long_texts_are_read_in_slices(plain, monkeypatch):
    monkeypatch.setattr(files, "CHUNK_BYTES", 64)
    reader = files._Reader(None)
    for text in ("ab cd, " * 200, "x" * 1000 + " y. " * 50, "z" * 500, "é. " * 100 + "w" * 300):
        slices = list(files._slices(text.encode()))
        assert b"".join(slices) == text.encode()
        got = np.concatenate([reader.read([s])[0] for s in slices])
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_are_read_as_whole_texts(plain):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    reader = files._Reader(None)
    odd = st.sampled_from(list("aAzZ09.,'\u0301\u0338=<>|ßÉéΣςİK\u00a0\u0085\u200b\x00\x1c \n") + ["'s", "'Re", "<|endoftext|>", "<|STARTOFTEXT|>", "日"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.lists(st.one_of(odd, st.characters(exclude_categories=["Cs"])), max_size=25).map("".join), max_size=4))
    def check(texts):
        ids, n = reader.read([t.encode() for t in texts])
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])

    check()


def test_ranks_of_all_lengths():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype("<u4")
        control, data = files.encode_ranks(ranks)
        assert len(control) == -(-n // 4) and len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
        assert (files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == ranks).all()
