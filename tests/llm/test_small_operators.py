"""Exact copies, top-k search, URL filter, packing, mixing and licence scan against plain
Python on small fixtures."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from liftkit.llm import exact_dedup, license_scan, packing, source_mixing, topk_search, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in rows], DOCS)


# -- exact copies ------------------------------------------------------------------------------

def copies_in_python(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    seen, out = set(), []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        first = i == keep and (i, t or "") not in seen
        seen.add((i, t or ""))
        out.append((i, keep, len(ids), first, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("capacity,depth", [(50_000, 12), (2, 6), (1, 3)])
def test_exact_copies(spark, capacity, depth):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "c ", "é", "x" * 5000, None, ""]) if i % 3 else f"own {i}") for i in range(200)]
    rows += [(7, rows[7][1]), (None, "a"), (None, "lonely"), (500, "A"), (501, "a\n")]
    got = sorted((tuple(r) for r in exact_dedup.exact_copies(docs_of(spark, rows), capacity=capacity, max_depth=depth).collect()), key=repr)
    assert got == copies_in_python(rows)


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    slots = exact_dedup.directory(keys, 100, 8).collect()
    held = {}
    for r in keys.select(exact_dedup._slot(F.col("key"), 8).alias("slot")).collect():
        held[r["slot"]] = held.get(r["slot"], 0) + 1
    assert {r["slot"] for r in slots} == set(held)
    for r in slots:
        width = 1 << (8 - r["depth"])
        assert r["bucket"] % width == 0 and r["bucket"] <= r["slot"] < r["bucket"] + width
        assert sum(n for s, n in held.items() if r["bucket"] <= s < r["bucket"] + width) <= 100 or r["depth"] == 8


def test_drop_copies_keeps_columns_and_one_row(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, "")]
    df = docs_of(spark, rows).withColumn("_sha", F.lit("mine")).withColumn("keep_id", F.lit(9))
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns and {r["_sha"] for r in out.collect()} == {"mine"}
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 4]
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


# -- top-k -------------------------------------------------------------------------------------

def brute_top_k(rows, k, every):
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q)[:k]
            out += [(q, r + 1, c, -n) for r, (n, c) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("bucket,block,k", [(2048, 512, 20), (17, 3, 5), (4, 2, 20)])
def test_top_k_is_exact(spark, bucket, block, k):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.choice([0.05, 1, 6])]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, [1.0, None] * 4), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8),
             (304, [0.0] * 8), (305, []), (306, [1.0, -2.0, 3.0]), (-20, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("other"))
    narrow = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in topk_search.top_k(df, k=k, every=10, bucket=bucket, block=block).collect())
    assert got == brute_top_k(narrow, k, 10)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(empty).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk_search.top_k(few).collect()] == [(0, 1, 1, 64 * 128)]


# -- URL filter --------------------------------------------------------------------------------

def test_rules_hosts_and_sql(spark):
    urls = ["https://A.Example.NET/en/1?x", "http://net/", "http://xnet/a", "http://b.net", "http://b.net/", "http://example.com/de/9",
            "http://w.example.com/de", "http://w.example.org/fr/", "http://worg/fr/", "no scheme /fr/", "", None, "x://h#f", "a://b://c/d",
            "http://example.com/es/ÄÖ%20" + "y" * 3000, "http://b.net/", "ftp://É.net/x\ny"]
    urls += [f"https://site{i}.example.{'com' if i % 2 else 'org'}/{'en' if i % 3 else 'fr'}/{i}" for i in range(60)]
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, urls[3])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("_url", F.lit(2))
    got = {(r["page_id"]): r for r in url_filter.judge(df).collect()}
    want = {0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("net", "/", "net/", "block"), 2: ("xnet", "/a", None, None),
            3: ("b.net", "", None, None), 4: ("b.net", "/", "net/", "block"), 5: ("example.com", "/de/9", "example.com/de/", "block"),
            6: ("w.example.com", "/de", None, None), 7: ("w.example.org", "/fr/", "org/fr/", "allow"), 8: ("worg", "/fr/", None, None),
            9: ("", "", None, None), 10: ("", "", None, None), 11: ("", "", None, None), 12: ("h", "", None, None), 13: ("b:", "//c/d", None, None)}
    for i, (host, path, rule, verdict) in want.items():
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), urls[i]
        assert verdict is None or got[i]["verdict"] == verdict
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    cols = ["page_id", "host", "path", "rule", "verdict"]
    sql = sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({url_filter.oracle()})").fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in url_filter.judge(df).collect()), key=repr) == sql


def test_url_filter_without_training_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(df).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0)).count() == 0


# -- packing -----------------------------------------------------------------------------------

def naive_first_fit(sizes, capacity):
    free, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
        if b is None:
            b = len(free)
            free.append(capacity)
        free[b] -= sizes[i]
        out[i] = b
    return out


def test_tournament_tree_is_first_fit_decreasing():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300):
        sizes = rng.integers(1, 101, n)
        assert packing.first_fit_decreasing(sizes, 100)[0].tolist() == naive_first_fit(sizes.tolist(), 100)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdeéß,.!'") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += [None, "", "word " * 9000, "Σας ΟΔΟΣ İstanbul", "日本語 テスト", "é ́x\x85y\x1cz", "<|endoftext|> don't WE'LL", "a\tb\r\nc"]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    df = docs_of(spark, rows).withColumn("offset", F.lit("clash"))
    got = packing.pack(df, group=16).collect()
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    seen, bins = {}, {}
    for r in got:
        a = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(a) and zlib.crc32(a[r["start"]: r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, a in ids.items():
        times = 2 if i == 0 else 1
        assert sorted(seen[i]) == sorted([(s, min(2048, len(a) - s)) for s in range(0, len(a), 2048)] * times)
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(df.limit(0)).count() == 0


# -- mixing ------------------------------------------------------------------------------------

def test_mixing_meets_its_limit_and_keeps_every_document(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "en", s, 0) for i, s in enumerate(["big"] * 900 + ["mid"] * 200 + ["low"] * 60 + [None] * 25)]
    df = spark.createDataFrame(rows, DOCS).withColumn("_tokens", F.lit("clash"))
    tokens, docs = {}, {}
    for _, t, _, s, _ in rows:
        tokens[s] = tokens.get(s, 0) + max(1, len(t.split()))
        docs[s] = docs.get(s, 0) + 1
    for limit in (1.0, 2.0, 3.5, 1e9):
        totals = source_mixing.source_totals(df, "source", "text")
        a = source_mixing.find_exponent(totals, repeat_limit=limit)
        p = {s: n / sum(tokens.values()) for s, n in tokens.items()}
        spread = max(p.values()) / min(p.values())
        exact = max(0.0, 1 - math.log(limit) / math.log(spread))
        assert a == pytest.approx(exact, abs=1e-6)
    out = source_mixing.mix(df, repeat_limit=2.0).collect()
    again = source_mixing.mix(df, repeat_limit=2.0).collect()
    assert sorted((r["doc_id"], r["_epoch"]) for r in out) == sorted((r["doc_id"], r["_epoch"]) for r in again)
    times, mixed = {}, {}
    for r in out:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        mixed[r["source"]] = mixed.get(r["source"], 0) + r["_tokens"]
    assert len(times) == len(rows) and max(times.values()) <= 3
    a = source_mixing.find_exponent(totals, repeat_limit=2.0)
    weight = {s: (n / sum(tokens.values())) ** a for s, n in tokens.items()}
    total = max(tokens[s] / weight[s] for s in tokens)
    for s in tokens:
        assert abs(mixed[s] - weight[s] * total) <= 41, s  # within a document of the budget


def test_mixing_by_entropy_and_budget(spark):
    rows = [(i, "a b c", "en", "x" if i < 300 else "y" if i < 360 else "z", 0) for i in range(380)]
    df = spark.createDataFrame(rows, DOCS)
    totals = source_mixing.source_totals(df, "source", "text")
    shares = np.array([300, 60, 20]) / 380

    def entropy(a):
        w = shares ** a / (shares ** a).sum()
        return -(w * np.log(w)).sum()

    a = source_mixing.find_exponent(totals, entropy=0.9)
    assert entropy(a) == pytest.approx(0.9, abs=1e-6)
    out = source_mixing.mix(df, entropy=0.9, total_tokens=600).groupBy("source").agg(F.sum("_tokens").alias("t")).collect()
    w = shares ** a / (shares ** a).sum()
    for r, x in zip(sorted(out), w):
        assert abs(r["t"] - 600 * x) <= 4
    assert source_mixing.mix(df.limit(0)).count() == 0


# -- licences ----------------------------------------------------------------------------------

def test_alignment_is_increasing_and_matches_equal_words():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))]
        m = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:]))
        assert license_scan.align(a, a) == [(i, i) for i in range(len(a))]


def test_longest_increasing_subsequence():
    from itertools import combinations

    rng = random.Random(9)
    for _ in range(100):
        b = rng.sample(range(20), rng.randint(0, 9))
        got = license_scan._increasing(list(enumerate(b)))
        best = max((len(c) for n in range(len(b) + 1) for c in combinations(b, n) if list(c) == sorted(c)), default=0)
        assert len(got) == best and [y for _, y in got] == sorted(y for _, y in got)


def test_notices_are_found_whole_twice_and_with_edits(spark):
    mit = license_scan.TEMPLATES["MIT"][1]
    edited = mit.replace("hereby granted", "granted").replace("merge, ", "").replace("distribute", "distribute widely")
    text = f"The rights of the work. {mit} And then the software went on and on. {edited} Done under the sun. Released under the MIT License."
    rows = [(1, text), (2, "plain prose about the licence of kings and the mit of time"), (3, None), (4, ""),
            (5, "x " * 30000 + "LICENSED under\nCC   BY-NC 4.0."), (6, "This work is licensed under the GNU General Public License, version 3."),
            (7, "Licensed under the Apache License, Version 2.0. " * 3), (7, "Released under the MIT License.")]
    df = docs_of(spark, rows).withColumn("license", F.lit("clash"))
    got = {}
    for r in license_scan.scan_licenses(df).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["aligned"], round(r["coverage"], 2), r["first_word"]))
    n = len(license_scan.words(mit))
    found = sorted(got[1], key=lambda x: x[3])
    assert [f[0] for f in found] == ["MIT"] * 3 and found[0][1] == n and found[1][2] >= 0.9 and found[2][1] == 5
    assert set(got) == {1, 5, 6, 7} and got[5] == [("CC-BY-NC-4.0", 5, 1.0, 30000)]
    assert [x[0] for x in got[6]] == ["GPL-3.0"] and sorted(x[0] for x in got[7]) == ["Apache-2.0"] * 3 + ["MIT"]
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("text,want", [
    ("Released under the BSD License.", ["BSD"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("Licensed under CC BY-NC 3.0.", ["CC-BY-NC-3.0"]), ("Licensed under CC BY-XX 4.0.", []), ("Released under the Foo License.", []),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("This work is licensed under the GNU Great General Public License, version 9.", ["GPL"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
    ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]), ("Licensed under the Mozilla Public License, Version 2.0.", ["MPL-2.0"]),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
     "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ["GPL-2.0"]),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", ["LGPL-2.1"]),
])
def test_near_miss_notices_are_told_apart(text, want):
    assert [n for n, *_ in license_scan.Scanner().scan(f"Some words before. {text} Some words after.")] == want


def test_whole_licence_texts_are_told_apart():
    scanner = license_scan.Scanner()
    for name, texts in license_scan.TEMPLATES.items():
        for text in texts:
            size = len(license_scan.words(text))
            hits = scanner.scan(f"Copyright 2020 The Authors. {text} int main(void);")
            assert [(n, k) for n, _, _, k, _ in hits] == [(name, size)], text


def test_clashing_names_in_mixing_and_shield(spark):
    rows = [(i, f"s{i % 3}", "word " * (i + 1)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    more = docs.withColumns({c: F.lit(1) for c in ("cut_turn", "cut_block", "cut_place", "cut_source", "_x", "in_x", "IN_y", "_y", "_cut_turn", "before", "left")})
    plain = sorted(tuple(r) for r in source_mixing.mix(docs, repeat_limit=1.5).select("doc_id", "_epoch", "_order").collect())
    mixed = source_mixing.mix(more, repeat_limit=1.5)
    assert set(more.columns) <= set(mixed.columns)
    assert sorted(tuple(r) for r in mixed.select("doc_id", "_epoch", "_order").collect()) == plain


def test_equal_rows_are_packed_in_many_groups(spark):
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same words here").alias("text"))
    got = packing.pack(docs, group=1000).collect()
    assert len(got) == 20_000 and len({(r.sequence_id, r.offset) for r in got}) == 20_000
    groups = {}
    for r in got:
        groups[r.sequence_id >> 24] = groups.get(r.sequence_id >> 24, 0) + 1
    assert len(groups) == 20 and max(groups.values()) < 1300


def test_top_k_of_large_components_and_a_lone_long_vector(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)] + [(120, [1e12, 0.0, 3.0, 0.0, 0.0, 1.0]), (121, [9e15, 1.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = []
    for q, v in whole:
        if q % 20 == 0:
            scored = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in whole if i != q)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    got = sorted(tuple(r) for r in topk_search.top_k(df, k=5, bucket=16, block=4).collect())
    assert got == sorted(want)
