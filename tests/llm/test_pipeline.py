"""The pipeline's stages against brute force, each on its own input, and the registered queries."""

import os
import random

import brute
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of documents and benchmark with copies, near copies, shared passages and leaks."""
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    item = [" ".join(word() for _ in range(16)) for _ in range(3)]
    passage = " ".join(word() for _ in range(60))
    texts = []
    for k in range(60):
        words = [word() for _ in range(rng.randint(40, 150))]
        texts.append(" ".join(words))
        if k % 5 == 0:
            texts += [texts[-1]] * 2
        if k % 7 == 0:
            words[10] = "edited"
            texts.append(" ".join(words))
        if k % 6 == 1:
            texts.append(" ".join(words[:50]) + f" tail{k}\n" + passage + f"\n{word()} {word()}")
        if k % 11 == 2:
            texts.append(" ".join(word() for _ in range(60)) + " " + item[k % 3])
    texts += [None, "", "x y z " * 60, "too short"]
    rng.shuffle(texts)
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0]]  # a row twice
    d = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(enumerate(item)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, item


def test_stages_against_brute_force(spark, small, tmp_path):
    d, item = small
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality_rules", "minhash_dedup", "substring_dedup", "decontamination", "packing"]

    def kept(name, frame):
        out = stages[name](spark, frame, d)
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        rows = sorted(tuple(r) for r in out.collect())
        if name != "packing":
            assert out.columns == docs.columns
        return out, rows

    before = sorted((tuple(r) for r in docs.collect()), key=repr)
    frame, rows = kept("quality_rules", docs)
    gone = brute.frequent_lines([(r[3], r[1]) for r in before], 20, 10, 0.005)
    assert rows == sorted(r for r, g in zip(before, gone) if not brute.rules(r[1])[5] and 2 * g <= brute.rules(r[1])[0])

    before = rows
    frame, rows = kept("minhash_dedup", frame)
    of = brute.classes(sorted({(r[0], r[1]) for r in before}))
    assert rows == sorted({r for r in before if of[r[0]] == r[0]}) and len(rows) < len(before)

    before = rows
    frame, rows = kept("substring_dedup", frame)
    judged = {x[0]: x for x in brute.substrings([(r[0], r[1]) for r in before], 20)}
    assert any(x[2] for x in judged.values())
    for old, new in zip(before, rows):
        _, n, removed, digest = judged[old[0]]
        assert new[0] == old[0] and new[2:4] == old[2:4]
        assert (brute.sha(new[1]) == digest and new[4] == len(new[1])) if removed else new == old

    before = rows
    frame, rows = kept("decontamination", frame)
    bad = {x[0] for x in brute.benchmark([(r[0], r[1]) for r in before], list(enumerate(item)), 13) if x[4]}
    assert bad and rows == [r for r in before if r[0] not in bad]

    before = rows
    frame, pieces = kept("packing", frame)
    lengths = {}
    for doc, start, length, _, total, *_ in pieces:
        lengths.setdefault(doc, []).append((start, length, total))
    assert set(lengths) == {r[0] for r in before}
    for own in lengths.values():
        assert sum(x[1] for x in own) == own[0][2] and [x[0] for x in sorted(own)] == list(np.cumsum([0, *(x[1] for x in sorted(own))])[:-1])


def test_frequent_lines_go(spark, tmp_path):
    rng = random.Random(13)
    line = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.choice('ijklmnop')}{rng.choice('qrstuvwx')}" for _ in range(n))
    footer, rows, want = line(30), [], []
    for i in range(30):
        own = [line(40), "", line(40) + "  "]
        held = i < 20
        rows.append((i, "\n".join([f"Posted on {i + 10} May", *own, footer, f"posted  ON {i + 10} may"] if held else own), "en", "s", -1))
        want.append((i, "\n".join(own), "en", "s", len("\n".join(own)) if held else -1))
    rows += [(100, footer + "\n" + line(29), "en", "s", -1), (101, None, "en", "s", -1), (102, f"{footer}\n{line(60)}", "en", None, -1)]
    want += [rows[-1]]  # the lines of another host
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(pipeline.STAGES)["quality_rules"](spark, docs, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == want


def test_run_applies_all_stages(spark, small):
    out = pipeline.run(spark, small[0])
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_stages_on_an_empty_table(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small[0]}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, small[0]).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, small[0]).count() == 0


def test_all_queries_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op8_quality_rules", "op9_suffix_dedup", "op11_centroid_clusters", "op12_merkle_manifest"])
def test_queries_match_their_sql(spark, name):
    from riskspark.testing.compare import compare, duckdb_connection

    out = compare(name, entry.queries()[name](spark, SF), duckdb_connection(SF), entry.oracle_sql()[name])
    assert out.ok, out.detail


@pytest.mark.parametrize("name", ["op1_url_filter", "op2_license_scan", "op8_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_contract_columns(spark):
    want = {
        "op4_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op6_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op9_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op10_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    }
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    for name, columns in want.items():
        out = entry.queries()[name](spark, SF)
        assert out.columns[: len(columns)] == columns and out.count() == docs.count()
