"""Long repeated passages by a distributed sparse suffix array.

A passage of ``min_len`` bytes that starts at two places must hold, at both, the same
anchor: the leftmost smallest hash of the 32-byte strings in its first ``WINDOW``
positions. Anchors depend on content alone, one per hundred bytes or so, and stand for the
suffixes that begin there; every passage reaches at least ``min_len - WINDOW + 1`` bytes
right of its anchor, so the hash of that many bytes is the key of a suffix.

1. Keys that occur once are dropped (counts are aggregated before the shuffle).
2. Occurrences whose whole context (``WINDOW - 1`` bytes left of the anchor and ``min_len``
   right of it) recurs are repeats over that context; they are settled by counting, so
   thousands of copies cost one row each and are never gathered.
3. What is left are the ends of repeats: one suffix for each different context of a key. Its
   bytes are fetched, the suffixes of a key are sorted, and a stack scan of the enhanced
   suffix array walks the common-prefix intervals. In each interval the left extensions are
   tested: occurrences that agree far enough to the left to make ``min_len`` bytes are a
   group, left-maximal where its members' further left bytes differ, right-maximal because
   the interval ends there. All occurrences of a group are put out on request (``groups``),
   copies included; ``remove_repeats`` needs and takes only the widest span of each.
4. A key with more than ``KEY_CAP`` different contexts is not gathered in a task. It is
   settled by halving: the offsets of a passage around the anchor form a range; rows that
   share the least bytes of a range are a smaller key, scanned as in 3 once few enough; a
   range whose widest bytes recur is taken whole, and any other is halved. Each round is two
   grouped counts.

Both ways are exact; keys are 64-bit hashes and contexts are told apart by 128 bits.

Defined results: a null text is empty. Passages never cross documents, and overlapping
occurrences in one document count. Texts shorter than ``min_len`` bytes lose nothing. Rows
repeated with one id and text are separate documents and so copies of each other; a null id
is an id like any other. Empty tables give an empty result. Long texts are read in segments,
so memory does not grow with them beyond the text itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of

MIN_LEN = 400
WINDOW = 200
GRAM = 32
SEGMENT = 1 << 21
KEY_CAP = 20_000  # contexts of a key that one task sorts: 600 bytes each, 12 MB
ANCHORS = "h long, c long, id long, th long, pos int"


def _table() -> np.ndarray:
    """256 well-mixed 64-bit numbers from a fixed rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from every position, by doubling."""
    h, size = _table()[data], 1
    while size < GRAM:
        h = h[:-size] * np.uint64(0xD6E8FEB86659FD93 + 2 * size) + h[size:]
        size *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchor_positions(text: np.ndarray, min_len: int = MIN_LEN, window: int = WINDOW) -> np.ndarray:
    """Positions of the anchors of one text's passages, in order."""
    n, found = len(text), []
    for at in range(0, n - min_len + 1, SEGMENT):
        part = text[at: at + SEGMENT + min_len - 1]
        h = gram_hashes(part)
        key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        starts, size, least = len(part) - min_len + 1, 1, key
        while size * 2 <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < window:
            least = np.minimum(least[: -(window - size)], least[window - size:])
        found.append(np.unique((least[:starts] & np.uint64(0xFFFFFF)).astype(np.int64)) + at)
    return np.unique(np.concatenate(found)) if found else np.array([], np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _anchors(min_len: int, window: int):
    reach = min_len - window + 1

    def run(batches):
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            hs, cs, ids, ths, ps = [], [], [], [], []
            for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_buffer()
                n = raw.size
                if n < min_len:
                    continue
                view = memoryview(raw)
                at = anchor_positions(np.frombuffer(raw, np.uint8), min_len, window).tolist()
                for p in at:
                    left = p if p < window - 1 else window - 1
                    hs.append(_signed(digest(view[p: p + reach])))
                    cs.append(_signed(digest(view[p - left: p + min_len], left + 1)))
                ids += [doc] * len(at)
                ths += [th] * len(at)
                ps += at
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hs, pa.int64()), pa.array(cs, pa.int64()), pa.array(ids, pa.int64()), pa.array(ths, pa.int64()),
                     pa.array(ps, pa.int32())], names=["h", "c", "id", "th", "pos"])

    return run


def _fetch(min_len: int, window: int):
    """Bytes on both sides of the chosen anchors of each document."""
    reach = min_len - window + 1

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, th, text, at in zip(batch.column("id").to_pylist(), batch.column("th").to_pylist(), batch.column("text"),
                                         batch.column("at").to_pylist()):
                raw = memoryview(text.as_buffer())
                for a in at:
                    p = a["pos"]
                    for column, value in zip(out, (a["h"], doc, th, p, a["nv"], bytes(raw[max(0, p - window + 1): p]),
                                                   bytes(raw[p + reach: p + min_len]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.int32()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.binary()),
                 pa.array(out[6], pa.binary())], names=["h", "id", "th", "pos", "nv", "left", "right"])

    return run


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n - 1
    while low < high:
        mid = (low + high + 1) // 2
        if x[:mid] == y[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def prefix_intervals(lcp: list[int]):
    """The common-prefix intervals (depth, first, last) of sorted suffixes, children first.
    ``lcp[i]`` is the common prefix of suffixes i and i + 1."""
    stack: list[list[int]] = []
    for i, depth in enumerate(lcp + [-1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append([depth, first])


def repeat_groups(left: list[bytes], right: list[bytes], need: int):
    """Maximal repeats among the suffixes of one key: (bytes left, bytes right, members).

    A group is an interval of the sorted right sides whose members also share so many bytes
    to the left that both together are at least ``need``; classes of left extensions are
    runs in the order of the reversed left sides.
    """
    back = [x[::-1] for x in left]
    order = sorted(range(len(right)), key=right.__getitem__)
    rank = {m: r for r, m in enumerate(sorted(range(len(back)), key=back.__getitem__))}
    lcp = [common_prefix(right[a], right[b]) for a, b in zip(order, order[1:])]
    for depth, first, last in prefix_intervals(lcp):
        members = sorted(order[first: last + 1], key=rank.__getitem__)
        run, shared = [members[0]], need
        for a, b in zip(members, members[1:]):
            same = common_prefix(back[a], back[b])
            if same + depth >= need:
                shared = same if len(run) == 1 else min(shared, same)
                run.append(b)
                continue
            if len(run) > 1:
                yield shared, depth, run
            run = [b]
        if len(run) > 1:
            yield shared, depth, run


def widest(left: list[bytes], right: list[bytes], need: int) -> dict[int, tuple[int, int]]:
    """The bytes left and right of the anchor that repeats cover, for each member in any: all
    its repeats hold the anchor, so their union is one stretch."""
    back = [x[::-1] for x in left]
    order = sorted(range(len(right)), key=right.__getitem__)
    rank = {m: r for r, m in enumerate(sorted(range(len(back)), key=back.__getitem__))}
    lcp = [common_prefix(right[a], right[b]) for a, b in zip(order, order[1:])]
    out: dict[int, tuple[int, int]] = {}
    for depth, first, last in prefix_intervals(lcp):
        members = sorted(order[first: last + 1], key=rank.__getitem__)
        before = -1
        for i, m in enumerate(members):
            after = common_prefix(back[m], back[members[i + 1]]) if i + 1 < len(members) else -1
            best = max(before, after)
            if best + depth >= need:
                seen = out.get(m, (0, 0))
                out[m] = (max(best, seen[0]), max(depth, seen[1]))
            before = after
    return out


def _runs(batches, columns):
    """Groups of rows with one ``h`` from batches sorted by it, one group at a time."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if row[0] != key:
                if rows:
                    yield key, rows
                key, rows = row[0], []
            rows.append(row)
    if rows:
        yield key, rows


def _scan(min_len: int, window: int, groups: bool):
    """Stack-scan each key's suffixes; put out spans, or all maximal repeat groups."""
    reach, need = min_len - window + 1, window - 1

    def spans(rows):
        lefts, rights = [r[4] for r in rows], [r[5] for r in rows]
        for m, (l, r) in widest(lefts, rights, need).items():
            doc, th, p = rows[m][1:4]
            yield doc, th, p - l, p + reach + r, 0, p

    def repeats(rows):
        import xxhash

        lefts, rights = [r[4] for r in rows], [r[5] for r in rows]
        for l, r, members in repeat_groups(lefts, rights, need):
            name = xxhash.xxh3_64_intdigest(
                lefts[members[0]][len(lefts[members[0]]) - l:] + b"|" + rights[members[0]][:r], rows[0][6] & (2**64 - 1))
            for m in members:
                doc, th, p = rows[m][1:4]
                yield doc, th, p - l, p + reach + r, _signed(name), p

    def run(batches):
        out: list[tuple] = []
        for _, rows in _runs(batches, ["h", "id", "th", "pos", "left", "right", "root"]):
            out += repeats(rows) if groups else spans(rows)
            if len(out) > 20_000:
                yield _span_batch(out)
                out = []
        if out:
            yield _span_batch(out)

    return run


SPANS = "id long, th long, start int, stop int, repeat_id long, pos int"


def _span_batch(rows):
    a, b, c, d, e, f = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int32()),
                                       pa.array(d, pa.int32()), pa.array(e, pa.int64()), pa.array(f, pa.int32())],
                                      names=["id", "th", "start", "stop", "repeat_id", "pos"])


def _scanned(rows: DataFrame, min_len: int, window: int, groups: bool) -> DataFrame:
    """The stack scan of every key in ``rows`` (h, root, id, th, pos, left, right); ``root`` is the
    key that names groups, of which ``h`` may be a part."""
    return rows.repartition("h").sortWithinPartitions("h", "id", "th", "pos").mapInArrow(_scan(min_len, window, groups), SPANS)


def _halving(hot: DataFrame, min_len: int, window: int, key_cap: int, groups: bool) -> DataFrame:
    """Spans of keys with very many contexts: ranges of offsets, halved round by round. Rows of
    a range that share its least bytes form a key of their own, scanned in a task as soon as
    it is small enough. With ``groups``, ranges that are settled are halved too, since rows
    that differ in a range's widest bytes may form a group over fewer."""
    need = window - 1
    size = 1
    while size < window:
        size *= 2
    live = hot.select("h", "id", "th", "pos", "left", "right", F.lit(0).alias("a"))
    found = []

    def parts(l, r):
        """Hash of the last l bytes to the left and the first r to the right; l and r are columns."""
        lo = F.when(l > 0, F.expr("left").substr(F.length("left") - l + 1, l)).otherwise(F.lit(b""))
        return F.xxhash64(lo, F.col("right").substr(F.lit(1), F.greatest(r, F.lit(0))))

    while size:
        a = F.col("a")
        least = live.filter((F.length("left") >= a) & (F.length("right") >= need - (a + size - 1))).withColumn(
            "k", parts(a, need - (a + size - 1)))
        again = least.groupBy("h", "a", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = materialise(least.join(again, ["h", "a", "k"]), "shared")
        few = shared.filter(F.col("n") <= key_cap).select(F.xxhash64("h", "a", "k").alias("h"), F.col("h").alias("root"), "id", "th", "pos", "left", "right")
        found.append(_scanned(few, min_len, window, groups))
        held = shared.filter(F.col("n") > key_cap).drop("n")
        if held.isEmpty():
            break
        fits = (F.length("left") >= a + size - 1) & (F.length("right") >= need - a) & (a + size - 1 <= need)
        held = materialise(held.withColumn("w", F.when(fits, parts(a + size - 1, need - a))), "held")
        twice = held.filter("w IS NOT NULL").groupBy("h", "a", "w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        marked = held.join(twice.withColumn("hit", F.lit(True)), ["h", "a", "w"], "left").withColumn(
            "done", F.coalesce(F.col("hit"), F.lit(False)))
        marked = materialise(marked, "marked")
        found.append(marked.filter("done").select("id", "th", (F.col("pos") - (a + size - 1)).alias("start"),
                                                  (F.col("pos") - a + min_len).alias("stop"),
                                                  (F.xxhash64("h", "a", "w") if groups else F.lit(0).cast("long")).alias("repeat_id"), "pos"))
        if size == 1:
            break
        # settled rows stay as partners of the unsettled ones of their range
        unsettled = marked.groupBy("h", "a", "k").agg(F.min("done").alias("all")).filter("NOT all").drop("all")
        rest = (marked if groups else marked.join(unsettled, ["h", "a", "k"])).select("h", "id", "th", "pos", "left", "right", "a")
        size //= 2
        live = rest.withColumn("a", F.explode(F.array(F.col("a"), F.col("a") + size))).filter(F.col("a") <= need)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN,
                   window: int = WINDOW, key_cap: int = KEY_CAP, groups: bool = False) -> DataFrame:
    """Spans of documents that recur: ``id, th`` (the text's hash), ``start, stop,
    repeat_id``. A stop of -1 marks the whole context of an anchor at ``start``. With
    ``groups``, every maximal repeat group of the scan is put out with all its occurrences,
    copies included, instead of each occurrence's widest span."""
    keyed = _keyed(docs, id_col, text_col)
    anchors = materialise(keyed.mapInArrow(_anchors(min_len, window), ANCHORS), "anchors")
    twice = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    again = materialise(anchors.join(twice, "h"), "again")
    contexts = materialise(again.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "pos")).alias("rep")), "contexts")
    settled = again.join(contexts.filter("n > 1").select("h", "c"), ["h", "c"]).select(
        "id", "th", F.col("pos").alias("start"), F.lit(-1).alias("stop"), F.col("c").alias("repeat_id"))

    many = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("nv")).filter("nv > 1")
    ends = contexts.join(many, "h").groupBy(F.col("rep.id").alias("p_id"), F.col("rep.th").alias("p_th")).agg(
        F.collect_list(F.struct("h", F.col("rep.pos").alias("pos"), "nv")).alias("at"))
    joined = keyed.join(ends, keyed["id"].eqNullSafe(ends["p_id"]) & (keyed["th"] == ends["p_th"])).select("id", "th", "text", "at")
    bytes_ = materialise(joined.mapInArrow(_fetch(min_len, window),
                                           "h long, id long, th long, pos int, nv long, left binary, right binary"), "ends")
    few = bytes_.filter(F.col("nv") <= key_cap).select("h", F.col("h").alias("root"), "id", "th", "pos", "left", "right")
    out = _scanned(few, min_len, window, groups)
    hot = bytes_.filter(F.col("nv") > key_cap)
    if not hot.isEmpty():
        out = out.unionByName(_halving(hot, min_len, window, key_cap, groups))
    if groups:  # from the one scanned row of each context to all its rows
        places = contexts.select("h", "c", F.col("rep.id").alias("r_id"), F.col("rep.th").alias("r_th"), F.col("rep.pos").alias("r_pos"))
        named = out.distinct().join(places, out["id"].eqNullSafe(places["r_id"]) & (out["th"] == places["r_th"]) & (out["pos"] == places["r_pos"])).select(
            "h", "c", "repeat_id", (F.col("start") - F.col("pos")).alias("first"), (F.col("stop") - F.col("pos")).alias("last"))
        out = again.join(named, ["h", "c"]).select("id", "th", (F.col("pos") + F.col("first")).alias("start"),
                                                   (F.col("pos") + F.col("last")).alias("stop"), "repeat_id").distinct()
    return settled.unionByName(out.select("id", "th", "start", "stop", "repeat_id"))


def _cut(min_len: int, window: int):
    def run(batches):
        for batch in batches:
            ids, sizes, gone, counts, shas = [], [], [], [], []
            for doc, text, spans in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist()):
                raw = memoryview(text.as_buffer())
                n = len(raw)
                merged: list[list[int]] = []
                for s, e in sorted((max(0, x["start"] - window + 1), min(n, x["start"] + min_len)) if x["stop"] < 0
                                   else (x["start"], x["stop"]) for x in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                sha, at = hashlib.sha256(), 0
                for s, e in merged:
                    sha.update(raw[at:s])
                    at = e
                sha.update(raw[at:])
                for column, value in zip((ids, sizes, gone, counts, shas),
                                         (doc, n, sum(e - s for s, e in merged), len(merged), sha.hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(shas, pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN,
                   window: int = WINDOW, key_cap: int = KEY_CAP) -> DataFrame:
    """One row per document: id, ``n_bytes, n_removed, n_spans, kept_sha256``."""
    spans = repeated_spans(docs, id_col, text_col, min_len, window, key_cap)
    per_doc = spans.groupBy(F.col("id").alias("p_id"), F.col("th").alias("p_th")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(per_doc, keyed["id"].eqNullSafe(per_doc["p_id"]) & (keyed["th"] == per_doc["p_th"]), "left")
    out = joined.select("id", "text", "spans").mapInArrow(
        _cut(min_len, window), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)
