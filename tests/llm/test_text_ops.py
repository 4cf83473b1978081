"""Decontamination, packing, rules, licences, URLs, scoring and the classifier."""

import random
import re
import textwrap
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import riskspark.llm.decontaminate as dec
import riskspark.llm.maxent_lm as lm
import riskspark.llm.packing as packing
import riskspark.llm.quality_classifier as qc
from riskspark.llm.license_scan import RULES, SENTENCES, WRAP, normalised, scan
from riskspark.llm.quality_rules import judge
from riskspark.llm.queries import URL_RULES
from riskspark.llm.url_filter import filter_urls


def columns_kept(frame, out, new):
    """The frame's columns without those named like one of the last ``new``."""
    taken = {c.lower() for c in out.columns[-new:]}
    return [c for c in frame.columns if c.lower() not in taken]


def test_benchmark_equals_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(dec, "SHARD_BYTES", 120)  # several passes
    monkeypatch.setattr(dec, "CHUNK_BYTES", 300)
    monkeypatch.setattr(dec, "PIECE_WORDS", 3)
    items = [(i, " ".join(rng.choice(["a", "B", "c", "é", "dd"]) for _ in range(rng.choice([0, 2, 5, 5, 6, 9])))) for i in range(30)] + [(None, "a b"), (7, None), (3, "dd dd dd dd")]
    docs = [(i, " ".join(rng.choice(["a", "b", "C", "é", "dd", "--", "x1"]) for _ in range(rng.randint(0, 60))) if i % 17 else None) for i in range(200)]
    out = dec.find_benchmark(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=4, slop=1).collect()
    got = {r.doc_id: (r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out}
    assert got == {x[0]: x for x in brute.benchmark(docs, items, 4)}
    assert {r.doc_id: r.near_items for r in out} == dict(brute.near(docs, items, 4, 1))
    assert any(set(r["items"]) < set(r.near_items) for r in out)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "d c b a"), (3, "a b c d")], "doc_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in dec.find_benchmark(docs, spark.createDataFrame([(5, "a b c d")], "item_id long, text string"), slop=1).collect()}
    assert got == {1: ([], ["5"]), 2: ([], []), 3: (["5"], ["5"])}


def test_benchmark_odd_rows(spark, odd, empty):
    items = [(1, "a b c"), (1, "a b c"), (2, None), (None, "z z"), (3, "line two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dec.find_benchmark(odd, bench)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()), key=repr)
    assert got == sorted(brute.benchmark([(r.doc_id, r.text) for r in odd.collect()], items, 13), key=repr)
    assert out.columns[:-6] == columns_kept(odd, out, 6)
    assert dec.find_benchmark(empty, bench).count() == 0
    assert dec.find_benchmark(odd, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0


@pytest.mark.parametrize("k", [1, 2, 7])
def test_differencing_deals_all_pieces(k):
    rng = random.Random(k)
    sizes = [rng.randint(1, 99) for _ in range(60)]
    dealt = packing.differencing(sizes, k)
    assert sorted(i for w in dealt for i in w) == list(range(60)) and len(dealt) <= k
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert max(sums) - min(sums) <= 3


def test_windows_rise_when_too_full():
    assert packing.windows_of([6, 6, 6], 10) == [[0], [1], [2]] or len(packing.windows_of([6, 6, 6], 10)) == 3
    assert packing.windows_of([], 10) == []


def test_packing_round_trip(spark, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, " ".join(random.Random(i).choice(["the", "naïve", "cat's", "42", "\n\n", "  x", "<|endoftext|>"]) for _ in range(i * 7))) for i in range(60)]
    docs = odd.select("doc_id", "text").where("doc_id > 1").unionByName(spark.createDataFrame([(1000 + i, x) for i, x in rows], "doc_id long, text string"))
    out = packing.pack(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        own = sorted(by[d.doc_id], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own])
        assert ids.tolist() == [*t.encode(d.text or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1]) and all(r.doc_tokens == len(ids) for r in own)
    windows = {}
    for r in out:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(odd).groupBy().sum("length").first()[0] == packing.pack(odd).select(F.sum(F.length("ids")) / 4).first()[0]
    assert packing.pack(empty).count() == 0


def test_packing_of_very_long_runs(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x " + "\t " * 1_000_000, "z" * 2_000_000, "!" * 2_000_000]
    out = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(out, key=lambda r: r.start) if r.doc_id == i])
        assert ids.tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("line_words", [20, None])
def test_rules_equal_brute_force(spark, odd, empty, line_words):
    rng = random.Random(4)
    common = ["Share this page", "Posted on 12 May", "All rights  reserved"]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choice(["alpha", "b#", "c", "Dd", "e|f", f"n{rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        lines += rng.sample(common, rng.randint(0, 3)) + ["same line here"] * rng.choice([0, 0, 0, 3]) + (["x y z " * 40] if rng.random() < 0.1 else [])
        rows.append((i, rng.choice(["h", None, "g"]), "\n".join(lines)))
    rows += [(500, "h", rows[0][2]), (501, "h", None)]
    out = judge(spark.createDataFrame(rows, "doc_id long, source string, text string"), line_words=line_words, limit=3, share=0.05).collect()
    gone = dict(zip((r[0] for r in rows), brute.frequent_lines([(h, t) for _, h, t in rows], line_words or 10**9, 3, 0.05)))
    assert any(gone.values())
    for r in out:
        base = brute.rules(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert r.n_removed_words == gone[r.doc_id] and r.kept == (not base[5] and 2 * gone[r.doc_id] <= base[0])
    out = judge(odd)
    assert out.columns[:-8] == columns_kept(odd, out, 8)
    for r in out.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.rules(r.text)
    assert judge(empty).count() == 0


def test_long_lines_are_counted(spark, tmp_path):
    from riskspark.llm.queries import op8_quality_rules

    rng = random.Random(12)
    footer = " ".join(f"footer{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70))
    own = lambda n: " ".join(f"w{rng.choice('abcdefgh')}{rng.choice('ijklmnop')}{rng.choice('qrstuvwx')}" for _ in range(n))
    rows = [(i, "h", own(60 if i % 2 else 100) + "\n" + (footer if i < 24 else own(30))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    gone = brute.frequent_lines([(h, t) for _, h, t in rows], 10**9, 10, 0.005)
    assert gone == [70] * 24 + [0] * 16
    out = {r.doc_id: r for r in op8_quality_rules(spark, str(tmp_path)).collect()}
    assert [out[i].n_removed_words for i, *_ in rows] == gone
    assert not any(r.base_failed for r in out.values()) and [i for i in out if not out[i].kept] == [i for i in out if i < 24 and i % 2]
    import duckdb

    from riskspark.llm.oracles import QUALITY_RULES
    from riskspark.testing.compare import compare

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    same = compare("op8", op8_quality_rules(spark, str(tmp_path)), con, QUALITY_RULES)
    assert same.ok, same.detail


def licences(text):
    cut = lambda t: [s for s in re.split(r"\n|(?<=[.!?:;])[\x20\x09-\x0D]+", t or "") if s.strip(" ")]
    ended = lambda s: re.search(r"[.!?:;][^0-9A-Za-z]*$", s) is not None

    def flat(xs):
        """The words of the parts, with a point where a part but the last ends a sentence."""
        return " ".join(w for j, x in enumerate(xs) for w in [*normalised(x).split(), *["."] * (j < len(xs) - 1 and ended(x))])

    known = {flat(cut(s)): n for n, forms in SENTENCES.items() for s in forms}
    parts = cut(text)
    ids = []
    for i in range(len(parts)):
        for back in range(min(i + 1, WRAP)):
            if k := known.get(flat(parts[i - back:i + 1])):
                ids.append(k)
                break
    left, out = "".join(f",{x}," for x in ids), []
    for name, sequence in RULES:
        if (p := "".join(f",{x}," for x in sequence)) in left:
            left = left.replace(p, ",-,")
            out += [name] if name not in out else []
    return len(parts), ids, out


def test_licences_equal_brute_force(spark, odd, empty):
    rng = random.Random(6)
    forms = [s for f in SENTENCES.values() for s in f]
    rows = [(-1, "all\nrights\nRESERVED!\nx")]
    for i in range(150):
        parts = [rng.choice(forms) if rng.random() < 0.6 else "Some other words." for _ in range(rng.randint(0, 6))]
        rows.append((i, rng.choice(["\n", " ", ". \n"]).join(p.replace(", ", ",\n  ", rng.randint(0, 2)) if rng.random() < 0.3 else p.upper() if rng.random() < 0.2 else p for p in parts)))
    out = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert any("BSD-2-Clause" in r.licences or "MIT" in r.licences for r in out)
    for r in out:
        assert (r.n_sentences, r.sentence_ids, r.licences) == licences(r.text)
    out = scan(odd)
    assert out.columns[:-3] == columns_kept(odd, out, 3)
    for r in out.collect():
        assert (r.n_sentences, r.sentence_ids, r.licences) == licences(r.text)
    assert scan(empty).count() == 0


def test_licences_are_found_as_published(spark):
    wrapped = [(name, textwrap.fill(form, width, initial_indent=indent, subsequent_indent=indent, break_long_words=False))
               for name, forms in SENTENCES.items() for form in forms for width in (1, 24, 50, 78) for indent in ("", " * ")]
    wrapped += [(name, form) for name, forms in SENTENCES.items() for form in forms]
    out = scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(wrapped)], "doc_id long, text string")).collect()
    assert {r.doc_id: set(r.sentence_ids) for r in out} == {i: {name} for i, (name, _) in enumerate(wrapped)}

    rules = [(name, "\n\n".join(textwrap.fill(SENTENCES[x][0], 78) for x in ids)) for name, ids in RULES]
    rules += [("GPL-3.0-or-later", "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
               "    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.\n"),
              ("Apache-2.0", '   Licensed under the Apache License, Version 2.0 (the "License");\n   you may not use this file except in compliance with the License.\n'
               "   You may obtain a copy of the License at\n\n       http://www.apache.org/licenses/LICENSE-2.0\n")]
    out = scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rules)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in out} == {i: [name] for i, (name, _) in enumerate(rules)}


def test_headers_of_licences_and_near_misses(spark):
    later = ("    This library is free software; you can redistribute it and/or\n    modify it under the terms of the GNU {} License as published by the Free Software\n"
             "    Foundation{} either version {} of the License, or (at your option) any later\n    version.\n")
    found = {
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n": ["GPL-3.0"],
        "GNU LESSER GENERAL PUBLIC LICENSE\n\nVersion 2.1, February 1999": ["LGPL-2.1"],
        "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n": ["Apache-2.0"],
        "Mozilla Public License Version 2.0\n==================================\n": ["MPL-2.0"],
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/. */": ["MPL-2.0"],
        "Copyright (c) 2020, A. Author\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\"": ["ISC"],
        "Creative Commons Legal Code\n\nCC0 1.0 Universal\n": ["CC0-1.0"],
        "=====\n\nCreative Commons Attribution-ShareAlike 4.0 International Public\nLicense\n\nBy exercising": ["CC-BY-SA-4.0"],
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy": ["Unlicense"],
        later.format("Lesser General Public", ";", "2.1"): ["LGPL-2.1-or-later"], later.format("Lesser General Public", ",", "3"): ["LGPL-3.0-or-later"],
        later.format("Affero General Public", ",", "3"): ["AGPL-3.0-or-later"], later.format("General Public", ";", "2"): ["GPL-2.0-or-later"],
        later.format("General Public", ",", "4"): [],  # no such version
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 30 June 2007": [], "We like the Mozilla Public License and others.": [],
        "Permission to use, copy, modify, and distribute this software for any purpose is refused.": [],
    }
    out = scan(spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")).collect()
    assert {r.text: r.licences for r in out} == found


def test_known_sentences_with_ends_inside(spark):
    texts = ["Free: you may\ncopy it. More.", "free:\nyou may copy; it.", "free you may copy it."]
    out = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sentences={"x": ["Free: you may copy it."]}, rules=[("X", ["x"])]).collect()
    assert {r.doc_id: r.licences for r in out} == {0: ["X"], 1: [], 2: []}


def test_ordered_rules_use_sentences_up(spark):
    text = " ".join(f[0] for n, f in SENTENCES.items() if n.startswith("bsd")) + "\nLicensed under the MIT License"
    r = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.licences == ["BSD-3-Clause", "MIT"]


def test_urls(spark, odd, empty):
    urls = [None, "nohost", "HTTP://EX.com?x", "a://b.net/es/1/2/3/4/5?z://q", "http://www.Example.com/en/a#b", "http://x.www.example.com/en/", "://", "http://example.com/en", "http://notexample.com/en/",
            "http://aexample.com/en/x", "ftp://net/fr/", "http://h.org/ü/%20"]
    urls += [f"http://big.net/{x}/{i}" for x in ("es", "fr", "en", "de") for i in range(30)] + ["http://big.net/odd/z.html"]
    urls += [f"http://shop.net/es/x{i}" for i in range(3)]
    rows = [(i if i % 5 else None, u, "v") for i, u in enumerate(urls + urls[:3])]
    out = filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), URL_RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "template", "purity", "verdict"]
    got = out.collect()
    assert sorted((r.url or "") for r in got) == sorted((u or "") for _, u, _ in rows)
    for r in got:
        assert (r.host, r.path, r.rule) == brute.url(r.url, URL_RULES)
        if r.rule:
            assert r.verdict == URL_RULES[r.rule]
    template = {r.url: r.template for r in got}
    assert template["http://big.net/es/3"] == template["http://big.net/fr/3"] == "/{es|fr}/*"  # alike, and all blocked
    assert template["http://big.net/en/3"] == "/{de|en}/*" and template["http://big.net/odd/z.html"] == "/*/*"
    assert {r.verdict for r in got if r.template == "/{de|en}/*"} == {"allow"}
    assert filter_urls(empty.selectExpr("doc_id page_id", "text url", "row"), URL_RULES).count() == 0


def test_templates_are_rejected_by_labelled_purity(spark):
    urls = [f"http://h.org/bad/{i}" for i in range(40)] + [f"http://h.org/new/{i}" for i in range(40)]
    out = filter_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"), {f"h.org/bad/{i}": "block" for i in range(1, 10)}).collect()
    unruled = {r.url: r.verdict for r in out if r.rule is None}
    assert set(unruled) == {"http://h.org/bad/0", *urls[40:]}
    assert unruled["http://h.org/bad/0"] == "block" and {unruled[u] for u in urls[40:]} == {"allow"}


def test_tree_equals_brute_force(spark):
    rng = random.Random(4)
    urls = [f"http://many.net/s{x}/{i}" for x in range(25) for i in range(8)]  # 25 sections of 4 %
    urls += [f"http://many.net/es/{i}.html" for i in range(40)] + [f"http://many.net/fr/{i}.html" for i in range(30)]
    urls += [f"http://deep.net/a/{i}/b/{'comments' if i % 2 else 'es'}/c/{i % 3}" for i in range(40)] + ["http://deep.net/a/1/b/2/c/d/e/f/g/h"]
    urls += [f"http://hot.org/{rng.choice(['x', 'y', 'z'])}/{rng.randint(0, 30)}/{rng.choice(['p', 'q.html', '7'])}" for _ in range(200)]  # a third of the pages
    urls += [f"http://tie.net/{x}/{i}" for x in ("fr", "b", "c") for i in range(6)] + [None, "x", "http://", "http://one.net/fr/1/2/3"]
    urls += urls[::7]
    rules = {**URL_RULES, "hot.org/x/1": "block", "hot.org/y/": "allow", "many.net/s3/": "block"}
    out = filter_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(5), rules).collect()
    want = brute.url_verdicts(urls, rules)
    assert len(out) == len(urls)
    assert {(r.url, r.template, r.verdict) for r in out} == {(u, *v) for u, v in want.items()}
    named = {r.template for r in out}
    assert any("|+" in t for t in named) and any(t.count("/") == 6 for t in named)
    clean = [r.verdict for r in out if r.rule is None and r.url and "/s" in r.url]
    assert clean and set(clean) == {"allow"}  # the sections beside the blocked ones stay


def test_contamination_equals_its_sql(spark):
    from riskspark.llm.oracles import DECONTAMINATION
    from riskspark.llm.queries import op6_decontamination
    from riskspark.testing.compare import compare, duckdb_connection

    sf = "/root/testdata/sf0.001"
    got = compare("op6", op6_decontamination(spark, sf).drop("n_near_items"), duckdb_connection(sf), DECONTAMINATION)
    assert got.ok, got.detail


def sentences(rng, n):
    words = {"a": ["the", "cat", "sat", "on", "a", "mat."], "b": ["der", "hund", "lief", "in", "das", "haus."]}
    return [(i, " ".join(words[k][j % 6] if rng.random() < 0.9 else rng.choice(words[k]) for j in range(rng.randint(0, 40)))) for i in range(n) for k in rng.choice("ab")]


@pytest.mark.parametrize("known", [4, 1 << 17])
def test_language_scores(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)  # 4: most counts come from the join
    rows = sentences(random.Random(7), 300) + [(400, None), (401, "A unseen Words cat")]
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    out = lm.language_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ~held).collect()
    want = {i: x for (i, _), x in zip(rows, brute.unigram([(zlib.crc32(str(i).encode()) % 7 != 2, t) for i, t in rows]))}
    for r in out:
        n, k, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, total) and abs(r.base_score - base) < 1e-9 * max(1, abs(base))
    fair = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    if known > 4:
        assert sum(r.score for r in fair) > sum(r.base_score for r in fair)


def test_class_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(0)
    weights, bias = rng.normal(size=(lm.ROWS, lm.CLASSES)).astype(np.float32), rng.normal(size=lm.CLASSES).astype(np.float32)
    p = lm._probabilities(weights, bias, [rng.integers(0, lm.ROWS, 50) for _ in range(3)])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_language_odd_rows(odd, empty):
    out = lm.language_scores(odd, F.col("doc_id") < 8)
    assert out.columns[:-5] == columns_kept(odd, out, 5)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((n, k, total) for n, k, total, _ in brute.unigram([(i is not None and i < 8, t) for i, t in rows]))
    got = out.collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == want and all(np.isfinite(r.score) for r in got)
    none = lm.language_scores(odd, F.lit(False)).collect()
    assert all(r.base_score == 0 and r.n_known == 0 for r in none)
    assert lm.language_scores(empty, F.lit(True)).count() == 0


def test_classifier_held_out(spark, odd, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        rows.append((i, " ".join(rng.choice(["the", "river", "stone", "flows", "é"]) if good else rng.choice(["BUY!!", "win$$", "the", "click>>"]) for _ in range(rng.randint(5, 60)))))
        labels.append((i, int(good)))
    labels += [(0, None), (1, 7), (None, 1), (2, 1)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = qc.fit(docs, known, ~held)
    out = [r for r in qc.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in out]) > 0.97
    scored = qc.score(odd, model)
    assert scored.columns[:-2] == columns_kept(odd, scored, 2)
    got = scored.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert qc.score(empty, model).count() == 0
    assert {r.score for r in qc.score(odd, qc.fit(docs, known.limit(0), ~held)).collect()} == {0.5}


def test_repeats_are_patterns_of_words():
    c = qc.Chunk([b"At At At", b"one two three"])
    assert (c.pattern - (qc.BUCKETS - qc.PATTERNS)).tolist() == [0, 1, 1 | 2 | 8, 0, 0, 0]
