"""Conversation repair against exhaustive search and a plain pass over the rows."""

import hashlib
import random
import re
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from liftkit.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(rows):
    """Least (cost, audit) over all edits with at most two inserted rows a gap. ``rows``: (role, must go, truncated)."""
    best = None

    def go(i, initials, cost, audit, gap):
        nonlocal best
        if cost > (best[0] if best else 2 * len(rows)):  # deleting all rows always does
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best = min(best, (cost, audit)) if best else (cost, audit)
        if gap < 2:
            for c in "ua":
                go(i, initials + c, cost + 5, audit + "I", gap + 1)
        if i < len(rows):
            role, must_go, cut = rows[i]
            go(i + 1, initials, cost + 2, audit + "D", 0)
            if not must_go:
                if role:
                    go(i + 1, initials + role[0], cost + 5 * cut, audit + "K", 0)
                for c in "ua":
                    go(i + 1, initials + c, cost + 1 + 5 * cut, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def brute(rows):
    """The contract, row by row."""
    out = []
    key = lambda r: (r[0] is not None, r[0] or 0)
    for conv, own in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        hurt = []
        for _, turn, role, text in own:
            role, text = (" " if x is None else x for x in (role, text))
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            order = (turn is not None, turn or 0, role, text)
            if code:
                now = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
                hurt += [(order, turn, "user" if code == 4 else role, now)] * (2 if code == 3 else 1)
        hurt.sort(key=lambda r: r[0])
        seen, steps, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in hurt:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            steps.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = exhaustive(steps) if len(steps) <= 5 else (None, None)
        turns = [t for _, t, _, _ in hurt if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(hurt, hurt[1:]))
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, [(r, t) for _, _, r, t in hurt]))
    return out


def lines_of(rows, audit):
    """The repaired lines, by counting positions in the output."""
    rows, out = iter(rows), []
    system = False
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter == "K":
            system = system or (not out and role.startswith("s"))
        else:
            role = "user" if (len(out) - system) % 2 == 0 else "assistant"
        out.append(f"{role}:{text}")
    return "\n".join(out)


def check(spark, rows, **sizes):
    conv = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({"conv": F.lit(1), "n": F.lit("x"), "c": F.lit(2)})
    got = {r[0]: tuple(r) for r in cr.repair(conv, **sizes).collect()}
    want = brute(rows)
    assert set(got) == {r[0] for r in want} and len(got) == len(want)
    for conv, gaps, blank, dup, cut, illegal, cost, audit, hurt in want:
        g = got[conv]
        assert g[1:6] == (gaps, blank, dup, cut, illegal), (conv, g)
        if cost is not None:
            assert g[6:8] == (cost, audit), (conv, hurt, g)
        assert re.fullmatch("[KRDI]*", g[7]) and g[8] == hashlib.sha256(lines_of(hurt, g[7]).encode()).hexdigest()
    return got


def random_rows(seed, convs, longest):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", None, ""], ["Hi.", "Yes!", "no end", " \n", "", None, "What?  ", "é."]
    return [(c, rnd.choice([t, t, t, 0, None]), rnd.choices(roles, [6, 6, 2, 1, 1, 1])[0], rnd.choices(texts, [5, 5, 3, 1, 1, 1, 3, 1])[0] if rnd.random() < .5 else f"T{t}.")
            for c in range(convs) for t in range(rnd.randint(1, longest))]


def test_equals_exhaustive_search(spark):
    rows = random_rows(1, 150, 5) + [(None, 0, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ok.")]
    check(spark, rows)


def test_segments_give_the_same_repair(spark):
    rows = random_rows(2, 60, 5) + random_rows(3, 3, 40)
    whole = check(spark, rows)
    assert check(spark, rows, segment=2, fan=2) == whole
    assert check(spark, rows, segment_chars=3, fan=3) == whole


def test_one_long_conversation_is_spread(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(3000)] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yo.")]
    rows += [(9, 5, "user", "same.")] * 500
    got = check(spark, rows, segment=100)
    assert got[9][7].count("D") >= 499 and got[9][3] >= 499
    faults = cr.faults(cr.damage(spark.createDataFrame(rows, SCHEMA)))
    assert faults.filter("conv = 9").count() <= 1


def test_search_through_one_conversation():
    rnd = random.Random(5)
    for _ in range(300):
        rows = [(rnd.choice("suauat"), rnd.random() < .2, rnd.random() < .3) for _ in range(rnd.randint(0, 5))]
        assert cr.cheapest([(None, False, 1) if go else (r, cut, 0) for r, go, cut in rows]) == exhaustive([(r, go, cut and not go) for r, go, cut in rows])


def test_nothing_left_and_empty_table(spark):
    gone = next(t for t in range(10_000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = check(spark, [(1, gone, "user", "Hi.")])
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert check(spark, []) == {}


def test_a_very_long_text(spark):
    check(spark, [(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", " " * 1_000_000), (1, 2, "assistant", "Done.")])


def test_without_damage(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "assistant", "B."), (1, 2, "assistant", "B."), (2, 0, "assistant", "C.")]
    got = {r[0]: tuple(r) for r in cr.repair(spark.createDataFrame(rows, SCHEMA), damaged=False).collect()}
    assert got[1][2:8] == (0, 1, 0, 1, 2, "KKD") and got[2][6:8] == (2, "D")
