"""Personal data: patterns against plain regular expressions, the random field against enumeration
and held-out rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftkit.llm import personal_data as pd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def field():
    return pd.train()


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card":
                twice = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 12 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), list(PLAIN).index(kind), m.end()))
    return sorted(out)


def test_patterns_equal_plain_expressions():
    rnd = random.Random(3)
    pieces = ["a", "b.c", "@", "@x.org", "4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (017) 555-7713",
              "+", "+4", "12", ".", "-", " ", "  ", "_", "%", "(", ")", "é", "٣", "\n", "0000.00.1.01", "٣.1.1.1", "378282246310005", "++1-2"]
    for _ in range(6000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        assert pd.pattern_spans(text) == brute(text), text


def test_patterns_take_linear_time():
    import time

    begun = time.time()
    for unit in ("a", "1", "1 ", "+1 ", "a@", "a.b@", "1.", "+", "a@b.", "1-"):
        pd.pattern_spans(unit * 500_000)
    assert time.time() - begun < 30


def test_viterbi_equals_enumeration():
    rnd = np.random.default_rng(4)
    k = len(pd.LABELS)
    field = pd.Field({"a": 2, "b": 3}, {(2, 3): 1}, [rnd.normal(size=(n, k)) for n in [4] * 5 + [2] * 2], rnd.normal(size=(k, k)), rnd.normal(size=k))
    shapes = [["a"], ["b", "a"], ["a", "b", "a", "c"], ["b", "b", "b"]]
    batch = [field.features(s) for s in shapes]
    for f, got in zip(batch, field.decode(batch)):
        e = field.scores(f)
        best = max((y for y in itertools.product(range(k), repeat=len(e)) if pd.OPENING[y[0]] and all(pd.ALLOWED[a, b] for a, b in zip(y, y[1:]))),
                   key=lambda y: field.start[y[0]] + sum(e[i, y[i]] for i in range(len(y))) + sum(field.move[a, b] for a, b in zip(y, y[1:])))
        assert tuple(got) == best


def test_held_out_rows(field):
    table = pd.labelled_table(600, seed=77)
    right = marked = true = 0
    for (_, spans), got in zip(table, pd.field_spans(field, [t for t, _ in table])):
        found = {(pd.KINDS[k], a, b) for a, k, b in got}
        right, marked, true = right + len(found & set(spans)), marked + len(found), true + len(spans)
    assert right / marked > 0.97 and right / true > 0.97


def test_field_adds_irregular_forms_and_leaves_plain_text_alone(field):
    hits = {"please call me on (415) 555-0199 after lunch": ("phone", "(415) 555-0199"), "write to jane at work dot com today": ("email", "jane at work dot com"),
            "paid by card xxxx xxxx xxxx 1234 today": ("card", "xxxx xxxx xxxx 1234"), "from 2001:db8:0::1 today": ("ip", "2001:db8:0::1")}
    for (text, (kind, what)), got in zip(hits.items(), pd.field_spans(field, list(hits))):
        assert [(pd.KINDS[k], text[a:b]) for a, k, b in got] == [(kind, what)], text
    clean = ["meet me at 10 for tea", "order 473696257 was sent", "9807915762804490 and 2024-05-17", "token = \"04dbebab91ab85687d33\"", "the dot com boom of 1999",
             "| 12 | 345 | 6 |", "version 2.3.1", "12:30:45"]
    assert pd.field_spans(field, clean) == [[] for _ in clean]


def test_long_windows_are_decoded_whole(field):
    filler = "12 " * 4000
    text = filler + "call me on (415) 555-0199 please " + filler
    assert [(pd.KINDS[k], text[a:b]) for a, k, b in pd.field_spans(field, [text])[0]] == [("phone", "(415) 555-0199")]


def test_merge_keeps_patterns_and_drops_overlaps():
    base = [(0, 0, 50), (10, 2, 12), (60, 1, 70)]
    assert pd.merge(base, [(20, 3, 30), (50, 3, 60), (69, 0, 80), (80, 0, 90)]) == base[:2] + [(50, 3, 60), (60, 1, 70), (80, 0, 90)]


def test_query_result(spark, field):
    rows = [(1, "mail a@b.org or +1 (017) 555-7713"), (2, None), (3, ""), (None, "10.0.0.1"), (3, ""), (4, "# " * 500_000 + " 10.0.0.1"),
            (5, "Äé 4111 1111 1111 1111, call me on (415) 555-0199 please")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "spans": F.lit(1)})
    got = sorted([tuple(r) for r in pd.find_personal_data(docs, field=field).collect()], key=repr)
    want = []
    for i, text in rows:
        base = brute(text or "")
        named = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in base)
        spans = named + ",phone:35:49" if i == 5 else named
        want.append((i, *[sum(k == x for _, k, _ in base) for x in range(4)], hashlib.sha256(named.encode()).hexdigest(), spans))
    assert got == sorted(want, key=repr)
    assert pd.find_personal_data(docs.limit(0), field=field).collect() == []
