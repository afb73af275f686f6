"""Suffix-array repeats and the chosen-path join against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from liftkit.llm import chosen_path, suffix_repeats
from liftkit.llm.common import table
from liftkit.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def brute_repeats(rows, size=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p: p + size] for _, b in texts for p in range(len(b) - size + 1))
    out = []
    for i, b in texts:
        mask = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if count[b[p: p + size]] > 1:
                mask[p: p + size] = b"\1" * size
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        out.append((i, len(b), sum(mask), spans, hashlib.sha256(bytes(x for x, m in zip(b, mask) if not m)).hexdigest()))
    return sorted(out, key=repr)


def repeat_rows():
    rng = random.Random(3)
    long = "".join(rng.choice("abcde é") for _ in range(2500))

    def noise(n):
        return "".join(rng.choice("uvwxyz ") for _ in range(n))

    rows = []
    for k in range(30):
        a, n = rng.randint(0, 1500), rng.randint(380, 900)
        rows.append((1000 + k, noise(rng.randint(0, 50)) + long[a: a + n] + noise(rng.randint(0, 50))))
    rows += [(2000 + k, noise(rng.randint(0, 600)) + long[100:560] + noise(rng.randint(0, 600))) for k in range(40)]
    rows += [(1, "ab" * 900), (2, "a" * 800), (3, "a" * 399), (4, None), (5, ""), (None, "q" * 500), (6, "a" * 400), (1000, rows[0][1]),
             (7, "é" * 200), (8, "zé" * 133 + "z")]
    return rows


@pytest.mark.parametrize("cap", [20_000, 30, 3])
def test_removed_bytes_match_brute_force(spark, cap):
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("th", F.lit(1))
    got = sorted((tuple(r) for r in suffix_repeats.remove_repeats(df, key_cap=cap).collect()), key=repr)
    assert got == brute_repeats(rows)


def test_segments_do_not_change_anchors(monkeypatch):
    rng = np.random.default_rng(0)
    text = rng.integers(97, 101, 30_000).astype(np.uint8)
    whole = suffix_repeats.anchor_positions(text)
    monkeypatch.setattr(suffix_repeats, "SEGMENT", 1000)
    assert suffix_repeats.anchor_positions(text).tolist() == whole.tolist()
    assert len(whole) < 30_000 / 60


def test_maximal_repeat_groups():
    """Every group of the stack scan is a repeat of all its members, cannot be extended to the
    right by all of them, nor to the left; and every pair of long enough repeats is covered."""
    rng = random.Random(1)
    for _ in range(150):
        n, need = rng.randint(2, 9), rng.randint(1, 6)
        left = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(n)]
        right = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(n)]
        groups = list(suffix_repeats.repeat_groups(left, right, need))
        for l, r, members in groups:
            assert l + r >= need and len(members) > 1
            assert len({left[m][len(left[m]) - l:] for m in members}) == 1 and len({right[m][:r] for m in members}) == 1
            further = {left[m][-l - 1: len(left[m]) - l] for m in members}
            assert len(further) > 1 or b"" in further
        want = {}
        for i in range(n):
            for j in range(n):
                if i != j:
                    l = suffix_repeats.common_prefix(left[i][::-1], left[j][::-1])
                    r = suffix_repeats.common_prefix(right[i], right[j])
                    if l + r >= need:
                        a, b = want.get(i, (0, 0))
                        want[i] = (max(a, l), max(b, r))
                        assert any(i in m and j in m and x <= l and y <= r for x, y, m in groups)
        assert suffix_repeats.widest(left, right, need) == want


def test_groups_are_put_out_with_all_occurrences(spark):
    rows = [(i, f"{i:03d}" * 60 + "common passage. " * 40 + f"{i + 500:03d}" * 60) for i in range(6)]
    spans = suffix_repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), groups=True)
    assert spans.filter("repeat_id <> 0").select("id").distinct().count() == 6
    assert suffix_repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("cap", [20_000, 3])
def test_one_group_holds_every_occurrence_of_its_passage(spark, cap):
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("uvwxyz ") for _ in range(n))

    passages = ["".join(rng.choice("abcdefg") for _ in range(500)) for _ in range(2)]
    rows, held = [], []
    for k, passage in enumerate(passages):
        copy = noise(300) + passage + noise(300)
        texts = [copy] * 5 + [noise(300) + passage + noise(300) for _ in range(6)]
        rows += [(100 * k + i, t) for i, t in enumerate(texts)]
        held.append({(100 * k + i, 300, 800) for i in range(len(texts))})
    groups = {}
    for r in suffix_repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), key_cap=cap, groups=True).collect():
        groups.setdefault(r["repeat_id"], set()).add((r["id"], r["start"], r["stop"]))
    for want in held:
        ids = {i for i, _, _ in want}
        assert any({i for i, _, _ in g} == ids for g in groups.values())
        if cap > 3:  # the scan finds the passage's ends where the window reaches them
            assert any({i for i, _, _ in g} == ids and min(e - s for _, s, e in g) >= 400 for g in groups.values())
    assert all(len({i // 100 for i, _, _ in g}) == 1 for g in groups.values())


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[j: j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
    holders = {}
    for x, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(x)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, s in enumerate(sets):
        for y, k in Counter(y for g in s for y in holders[g] if y < x).items():
            if 5 * k >= 4 * (len(s) + len(sets[y]) - k):
                links[x] += 1
                links[y] += 1
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    members = {}
    for x in range(len(rows)):
        members.setdefault(find(x), []).append(rows[x][0])
    same = Counter(s for s in sets if s)
    return sorted(((rows[x][0], min((i for i in members[find(x)] if i is not None), default=None), links[x], same.get(sets[x], 1))
                   for x in range(len(rows))), key=repr)


def near_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rng = random.Random(3)

    def word():
        return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))

    base = [word() for _ in range(200)]
    for k in range(200):  # a large group of near copies
        b = list(base)
        for _ in range(rng.randint(1, 5)):
            b[rng.randrange(200)] = word()
        rows.append((10**6 + k, " ".join(b)))
    for k in range(120):  # one passage in many documents
        rows.append((2 * 10**6 + k, " ".join([word() for _ in range(40)] + base[20:80] + [word() for _ in range(60)])))
    return rows + [(3 * 10**6, None), (3 * 10**6 + 1, ""), (3 * 10**6 + 2, "a b"), (3 * 10**6 + 3, "a b"), (3 * 10**6 + 4, "a b c"),
                   (None, "x y z w v u"), (None, "x y z w v u"), (3 * 10**6 + 5, " \n ")]


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("size", F.lit(0))
    got = sorted((tuple(r) for r in chosen_path.near_duplicates(df).collect()), key=repr)
    assert got == brute_near(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = near_rows(spark)[200:]
    monkeypatch.setattr(chosen_path, "BLOCK", 40)
    monkeypatch.setattr(chosen_path, "VERIFY_SETS", 40)
    monkeypatch.setattr(chosen_path, "MAX_DEPTH", 4)
    monkeypatch.setattr(chosen_path, "PROPOSE", 0.55)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in chosen_path.near_duplicates(df).collect()), key=repr) == brute_near(rows)


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text), (1, text + " x"), (2, text), (2, text), (9, "other words that stand quite alone here"), (10, ""), (11, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_th", F.lit("mine"))
    out = chosen_path.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 9, 10, 11]
    assert chosen_path.drop_near_duplicates(df.limit(0)).count() == 0


def test_runs_follow_the_recall():
    assert chosen_path.runs_for(0.9) == 1 and chosen_path.runs_for(0.99995) == 4
    assert [chosen_path.runs_for(r) for r in (0.9, 0.99, 0.9999)] == sorted(chosen_path.runs_for(r) for r in (0.9, 0.99, 0.9999))


def test_four_runs_miss_like_independent_ones():
    """Pairs that agree in each min-hash with probability 0.7 meet in trees as the formula says."""
    runs, n, share = 4, 20_000, 0.7
    assert chosen_path.misses()[0] ** chosen_path.runs_for(0.99995) + chosen_path.misses()[1] <= 5e-5 and chosen_path.misses()[1] < 1e-7
    rng = np.random.default_rng(5)
    hashes = chosen_path.min_hashes(np.arange(1, 50, dtype=np.uint64) * np.uint64(chosen_path.MIX), runs)
    assert len(hashes) == runs * chosen_path.COORDS
    a = rng.integers(0, 1 << 16, (n, len(hashes))).astype(hashes.dtype)
    b = np.where(rng.random(a.shape) < share, a, rng.integers(0, 1 << 16, a.shape).astype(a.dtype))
    sides = []
    for m in (a, b):
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array([x.tobytes() for x in m], pa.binary())], names=["node", "mh"])
        sides.append([set(zip(o.column("node").to_pylist(), o.column("path").to_pylist())) for o in
                      [pa.Table.from_batches(chosen_path._grow(runs)([batch]))]][0])
    missed = n - len({node for node, _ in sides[0] & sides[1]})
    assert missed / n <= 1.25 * chosen_path.misses(share)[0] ** runs


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    pairs = {}
    for n, c in got.items():
        assert pairs.setdefault(find(n), c) == c
    assert len(set(pairs.values())) == len(pairs)
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
