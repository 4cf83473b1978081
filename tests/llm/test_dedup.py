"""Substring, suffix and near-duplicate removal against brute force."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import riskspark.llm.minhash_dedup as near
import riskspark.llm.substring_dedup as sub
import riskspark.llm.suffix_dedup as suffix


def passages(rng, n=150, null=0.03):
    common = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(["a", "b", "c", "é", "dd", f"x{rng.randint(0, 50)}"]) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.4:
            t += "\t" + rng.choice(common) + "\n" + t[:30]
        rows.append((i, t if rng.random() > null else None))
    return rows


@pytest.mark.parametrize("window", [3, 20])
def test_substrings_equal_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(sub, "CHUNK_BYTES", 500)  # many chunks
    rows = passages(random.Random(window))
    got = sub.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=window)
    got = {r.doc_id: (r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got.collect()}
    want = brute.substrings(rows, window)
    assert sum(x[2] for x in want) > 0
    assert got == {x[0]: x for x in want}


@pytest.mark.parametrize("depth", [5, 30])
def test_suffixes_equal_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 500)
    monkeypatch.setattr(suffix, "PIECE_BYTES", 70)
    rows = passages(random.Random(depth)) + [(1000 + i, "z" * i) for i in range(0, 90, 10)]
    got = suffix.remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), depth=depth)
    got = {r.doc_id: (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) for r in got.collect()}
    want = brute.repeated_bytes(rows, depth)
    assert sum(x[2] for x in want) > 0
    assert got == {x[0]: x for x in want}


def test_substrings_odd_rows(odd, empty):
    got = sub.remove_repeats(odd, window=4)
    assert got.columns == [c for c in odd.columns if c != "n_words"] + ["n_words", "n_removed", "kept_text"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(brute.substrings(rows, 4), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got.collect()), key=repr) == want
    assert sub.remove_repeats(empty).count() == 0


def test_suffixes_odd_rows(odd, empty):
    got = suffix.remove_repeated_bytes(odd, depth=8)
    assert got.columns == [c for c in odd.columns if c != "n_bytes"] + ["n_bytes", "n_removed", "n_spans", "kept_bytes"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(brute.repeated_bytes(rows, 8), key=repr)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) for r in got.collect()), key=repr) == want
    assert suffix.remove_repeated_bytes(empty).count() == 0


def near_copies(rng):
    rows = []
    for base in range(12):
        words = [f"{rng.choice('abcdefg')}{rng.randint(0, 300)}" for _ in range(rng.choice([6, 30, 120]))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = f"y{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows), "p q " * 40), (len(rows) + 1, "p q " * 44), (len(rows) + 2, "p q " * 20), (len(rows) + 3, "one"), (len(rows) + 4, "one")]
    return rows


def test_near_classes_equal_brute_force(spark):
    rows = near_copies(random.Random(5))
    got = {r.doc_id: r.class_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.classes(rows)


def test_near_recall_on_a_given_table(spark):
    """Every pair of documents that are alike to 0.8 or more is in one class, and every class is held together by such pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    bags = {r.doc_id: brute.bag(r.text, 5) for r in docs.collect()}
    where = {}
    for i, b in bags.items():
        for x in b:
            where.setdefault(x, []).append(i)
    pairs = {p for ids in where.values() for k, i in enumerate(ids) for p in ((i, j) for j in ids[k + 1:])}
    alike = {p for p in pairs if brute.similarity(bags[p[0]], bags[p[1]]) >= 0.8}
    named = {r.doc_id: r.class_id for r in near.near_duplicates(docs).select("doc_id", "class_id").collect()}
    assert len(alike) > 90 and all(named[i] == named[j] for i, j in alike)
    top = {i: i for i in bags if bags[i]}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in sorted(alike):
        a, b = sorted((find(i), find(j)))
        top[b] = a
    want, got = {}, {}
    for i in top:
        want.setdefault(find(i), set()).add(i)
        got.setdefault(named[i], set()).add(i)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_signatures_estimate_weighted_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 3, 40, 300):
        a = {int(rng.integers(1 << 62)): int(rng.integers(1, 9)) for _ in range(n)}
        b = {k: max(1, v + int(rng.integers(-2, 3))) for k, v in a.items() if rng.random() < 0.9 or n < 5}
        part = lambda x, i: (np.full(len(x), i), np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)]))
        doc, value, count = (np.concatenate(z) for z in zip(part(a, 0), part(b, 1)))
        s = near.signatures(doc, value, count, 2, 4000)
        assert abs((s[0] == s[1]).mean() - brute.similarity(a, b)) < 0.04  # five deviations


def test_calls_stay_small_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    monkeypatch.setattr(near, "SLOT_ROWS", 128)
    members = spark.range(2000).selectExpr("7L key", "id node", "2000L size", "id root").withColumn("block", F.pmod(F.xxhash64("node"), near._blocks()))
    dealt = near._dealt(members)
    assert dealt.count() == 2000 * 125
    assert dealt.groupBy("slot").count().agg(F.max("count")).first()[0] < 8 * 128
    assert dealt.groupBy("lo", "hi").agg(F.countDistinct("slot").alias("n")).where("n > 1").count() == 0


def test_near_classes_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    monkeypatch.setattr(near, "SLOT_ROWS", 16)
    rng, template = random.Random(9), [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(rng.choice("pq") + str(k) if k // 6 in places else w for k, w in enumerate(template)))
            for i, places in enumerate({rng.randrange(20)} for _ in range(60))]
    got = {r.doc_id: r.class_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.classes(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 105), (105, 103), (200, 201)]
    got = {r.node: r.root for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 103: 100, 105: 100, 201: 200}


def test_near_odd_rows(spark, odd, empty):
    got = near.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.class_id)
    assert by_id[6] == by_id[5] == {5} and by_id[2] == by_id[3] == {2} and by_id[1] == {1}
    kept = near.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 2, 4, 5, 7, 8, 9]
    assert near.one_of_each(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert near.one_of_each(nulls).count() == 1
