"""Near-duplicate join on word shingles by chosen paths.

A document is the set of its five-word shingles; two documents are linked if their sets'
Jaccard similarity is at least 0.8. Documents with equal sets are first collapsed to one
node. A chosen-path tree splits the nodes recursively: a tree node picks two of the tree's 64
sampled tokens (min-hash coordinates) at random, and a set goes to the child named by the
token it has there, so similar sets keep meeting and others part. Four trees (runs) are grown,
each on 64 coordinates of its own, so that they are independent. A pair that agrees in a share
s of a tree's coordinates misses it with a probability of at most the fixed point of
x = (1 - s + s x)^2; averaged over the share, a pair at similarity 0.8 misses one tree with at
most 0.0715, and all four with at most 2.6e-5 (1 in 38,000). The number of runs is chosen
from the target recall by that formula, before the runs; links found are not used to stop.

Buckets shrink level by level. Buckets of equal content are examined once (large ones once a run).
Small buckets are compared by brute force. Large ones are compared with their smallest member first.
What has been proposed gives members labels: equal ones are connected already. Where all but a few
members of a large bucket share a label, as in a large group of near copies, the few are compared
with all others, dealt into blocks, and the bucket is done; only buckets with more members outside
their largest label split again, until what is left is compared in blocks, block against block, with
no more rows than there are sets, or at the last level. So a member of a large group is carried into a bucket of each path of the start depth, but not
further. Comparisons use the run's 64 min-hashes with a threshold low enough to lose a pair at 0.8
with 2e-8 (32 of 64); they only propose links, kept as spanning edges, never as all pairs. Every connected
component of proposals is then verified on the exact shingle sets, block against block, in
tasks that put out counts and spanning edges.

Result: one row per document with its class (``class_id``: the smallest id of the documents
connected by links), the number of links (other documents at similarity 0.8 or more, copies
included) and the number of documents of exactly its set.

Defined results: words are separated by white space and compared as they are. A text of
fewer than five words is one shingle of all its words. A text without words (null, empty)
has no shingles, no links and a class of its own. Null ids may be members; a class of null
ids only has a null ``class_id``. Rows repeated are copies. Empty tables give an empty
result. Texts are read whole. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, shield, small_batches, text_of, unshield
from .components import connected_components

WORDS = 5
SIMILARITY = 0.8
COORDS = 64       # of each run; 16 bits each
BRANCH = 2        # coordinates a tree node picks
START_DEPTH = 3   # levels grown before buckets are counted
MAX_DEPTH = 8
SMALL = 64        # sets in a bucket compared by brute force
BLOCK = 256       # sketches in a block
VERIFY_SETS = 1024         # whole sets in a block that is verified, on average
VERIFY_ITEMS = 2_000_000   # shingles in it, on average
WIDE = 4096       # sets in a block that is compared with a few others
PROPOSE = 0.5     # share of equal min-hashes that proposes a link
MIX = 0x9E3779B97F4A7C15


def misses(similarity: float = SIMILARITY) -> tuple[float, float]:
    """Bounds on the probabilities that a pair at ``similarity`` misses one tree, at any depth, and
    that a comparison loses it, over the coordinates of the run in which the pair agrees."""
    tree = compared = 0.0
    for k in range(COORDS + 1):
        share = math.comb(COORDS, k) * similarity**k * (1 - similarity) ** (COORDS - k)
        miss = 0.0
        for _ in range(1000):
            miss = (1 - k / COORDS + k / COORDS * miss) ** BRANCH
        tree += share * miss
        compared += share if k < PROPOSE * COORDS else 0.0
    return tree, compared


def runs_for(recall: float, similarity: float = SIMILARITY) -> int:
    """Runs needed so that a pair at ``similarity`` is proposed with probability ``recall``."""
    tree, compared = misses(similarity)
    return max(1, math.ceil(math.log(max(1e-12, 1 - recall - compared)) / math.log(min(max(tree, 1e-12), 1 - 1e-12))))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in text.split()], np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(MIX) + w[i: len(w) - k + 1 + i])
    return np.unique(h)


def _multipliers(runs: int) -> np.ndarray:
    return mix(np.arange(1, runs * COORDS + 1, dtype=np.uint64) * np.uint64(MIX)) | np.uint64(1)


def min_hashes(s: np.ndarray, runs: int) -> np.ndarray:
    """The coordinates of all runs, one run after the other."""
    a, best = _multipliers(runs), None
    for at in range(0, len(s), 1 << 12):
        low = np.multiply.outer(a, s[at: at + (1 << 12)])
        low ^= low >> np.uint64(29)
        low = (low * np.uint64(MIX)).min(axis=1)
        best = low if best is None else np.minimum(best, low)
    return (mix(best) >> np.uint64(48)).astype(np.uint16)


def _sketch(runs: int):
    def run(batches):
        import xxhash

        for batch in batches:
            nodes, sizes, mhs = [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py())
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                sizes.append(len(s))
                mhs.append(min_hashes(s, runs).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(mhs, pa.binary())],
                names=["id", "th", "node", "size", "mh"])

    return run


def _children(path: np.ndarray, mh: np.ndarray) -> np.ndarray:
    """The ``BRANCH`` children of each (path, set), an array of one row per set."""
    out = np.empty((len(path), BRANCH), np.uint64)
    rows = np.arange(len(path))
    for b in range(BRANCH):
        pick = mix(path + np.uint64((b + 1) * MIX % (1 << 64)))
        coord = (pick % np.uint64(COORDS)).astype(np.int64)
        out[:, b] = mix(mix(pick ^ coord.astype(np.uint64)) + mh[rows, coord].astype(np.uint64) * np.uint64(MIX))
    return out


def _matrix(sketches, runs: int = 1) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint16).reshape(len(sketches), runs * COORDS)


def _grow(runs: int):
    """Paths of each set at the start depth of each run."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                mh = _matrix(batch.column("mh").to_pylist(), runs)
                node = np.array(batch.column("node").to_pylist(), np.int64)
                for r in range(runs):
                    paths, owners, m = np.full(len(node), mix(np.array([(r + 1) * MIX % (1 << 64)], np.uint64))[0]), node, mh[:, r * COORDS: (r + 1) * COORDS]
                    for _ in range(START_DEPTH):
                        paths = _children(paths, m).ravel()
                        owners, m = np.repeat(owners, BRANCH), np.repeat(m, BRANCH, axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(owners), pa.array(np.full(len(paths), r, np.int32))],
                                                     names=["path", "node", "run"])

    return run


def _split(batches):
    """Children of (path, node, label, run, mh) rows."""
    for batch in batches:
        if batch.num_rows:
            path = np.array(batch.column("path").to_pylist(), np.int64).view(np.uint64)
            kids = _children(path, _matrix(batch.column("mh").to_pylist())).ravel().view(np.int64)
            twice = [pa.array(np.repeat(np.array(batch.column(c).to_pylist(), np.int64), BRANCH)) for c in ("node", "label")]
            runs = pa.array(np.repeat(np.array(batch.column("run").to_pylist(), np.int32), BRANCH))
            yield pa.RecordBatch.from_arrays([pa.array(kids), *twice, runs], names=["path", "node", "label", "run"])


def _groups(batches, key, columns):
    """Runs of rows with one key from batches sorted by it."""
    last, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if row[: key] != last:
                if rows:
                    yield last, rows
                last, rows = row[: key], []
            rows.append(row[key:])
    if rows:
        yield last, rows


def _forest(n: int, pairs) -> list[tuple[int, int]]:
    """Spanning edges (smaller root, member) of the graph on 0..n-1 given by ``pairs``."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(find(i), i) for i in range(n) if find(i) != i]


def _edges(rows):
    u, v = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _compare(batches):
    """Brute force inside small buckets: spanning edges of the proposals."""
    out: list[tuple[int, int]] = []
    for _, rows in _groups(batches, 1, ["path", "node", "mh"]):
        rows = sorted(dict(rows).items())
        m = _matrix([r[1] for r in rows])
        out += _proposals([r[0] for r in rows], m, m, True)
        if len(out) > 50_000:
            yield _edges(out)
            out = []
    yield _edges(out)


def _proposals(names, a, b, same, names_b=None):
    """Spanning edges among sets whose min-hashes agree often enough."""
    need = PROPOSE * COORDS
    pairs = []
    for i in range(len(a)):
        rest = b[i + 1:] if same else b
        hits = np.flatnonzero((rest == a[i]).sum(axis=1) >= need)
        pairs += [(i, (i + 1 if same else len(a)) + int(j)) for j in hits]
    names = list(names) + list(names_b or [])
    return [(names[x], names[y]) for x, y in _forest(len(names), pairs)]


def _compare_blocks(batches):
    """Blocks i and j of a large bucket: columns path, bi, bj, side, node, label, mh. Members of
    one label are connected already; only edges between labels are put out."""
    for _, rows in _groups(batches, 3, ["path", "bi", "bj", "side", "node", "label", "mh"]):
        first = sorted((n, l, m) for side, n, l, m in rows if side == 0)
        second = sorted((n, l, m) for side, n, l, m in rows if side == 1)
        a, b = _matrix([m for *_, m in first]), _matrix([m for *_, m in second])
        whole, k = first + second, len(first)
        found = _proposals(range(k), a, b, False, range(k, len(whole))) if second else _proposals(range(k), a, a, True)
        names = sorted({l for _, l, _ in whole})
        number = {l: i for i, l in enumerate(names)}
        between = [(number[whole[x][1]], number[whole[y][1]]) for x, y in found]
        yield _edges([(names[x], names[y]) for x, y in _forest(len(names), between)])


def block_pairs(df: DataFrame, blocks, member: str) -> DataFrame:
    """Deal the members of each group into ``blocks`` and repeat every member once for each pair of
    blocks that its block belongs to: ``bi <= bj, side``."""
    dealt = df.withColumn("_n", blocks.cast("int")).withColumn(
        "_b", F.pmod(F.xxhash64(member), F.col("_n")).cast("int"))
    met = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return met.withColumn("bi", F.least("_b", "_o")).withColumn("bj", F.greatest("_b", "_o")).withColumn(
        "side", F.when(F.col("_b") == F.col("bi"), 0).otherwise(1)).drop("_n", "_b", "_o")


def _buckets(rows: DataFrame) -> DataFrame:
    """``path, n, leader, led`` (the smallest member and its label) of buckets worth examining: two
    or more members, not all under one label, and one bucket for each content (told by its size and
    the exclusive-or of hashed members); large buckets of equal content stay apart by run, so that
    each run splits them by its own tree."""
    sizes = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("run").alias("run"), F.min("label").alias("lo"),
        F.max("label").alias("hi"), F.min(F.struct("node", "label")).alias("lead")).filter("lo <> hi")
    apart = F.when(F.col("n") > SMALL, F.col("run")).alias("apart")
    return sizes.groupBy("n", "x", apart).agg(F.min(F.struct("path", "lead")).alias("one")).select(
        "one.path", "n", F.col("one.lead.node").alias("leader"), F.col("one.lead.label").alias("led"))


def propose(nodes: DataFrame, runs: int) -> DataFrame:
    """Edges ``u, v`` that connect the sets in ``nodes`` (node, mh) wherever links are proposed."""
    rows = materialise(nodes.mapInArrow(_grow(runs), "path long, node long, run int"), "paths")
    rows = rows.withColumn("label", F.col("node"))

    def own(sketch: str):
        """The run's coordinates."""
        return F.expr(f"substring({sketch}, run * {2 * COORDS} + 1, {2 * COORDS})").alias(sketch)

    total = nodes.count()
    found = []
    for depth in range(START_DEPTH, MAX_DEPTH + 1):
        held = rows.join(_buckets(rows), "path").join(nodes.select("node", "mh"), "node")
        held = materialise(held.select("path", "n", "node", "label", "run", own("mh"), "leader", "led"), "held", few_files=True)
        small = held.filter(F.col("n") <= SMALL).select("path", "node", "mh").repartition("path").sortWithinPartitions("path")
        found.append(materialise(small.mapInArrow(_compare, "u long, v long"), "proposed", few_files=True))
        large = held.filter(F.col("n") > SMALL)
        if large.isEmpty():
            break
        led = large.join(nodes.select(F.col("node").alias("leader"), F.col("mh").alias("lead_mh")), "leader").select(
            "path", "node", "label", "run", "mh", "led", own("lead_mh"))
        led = materialise(led.mapInArrow(_follow, "path long, node long, label long, run int, mh binary, led long"), "led", few_files=True)
        found.append(led.filter("led <> label").select(F.col("led").alias("u"), F.col("label").alias("v")).distinct())
        led = led.withColumn("label", F.coalesce("led", "label")).drop("led")
        if depth == START_DEPTH:
            comps = connected_components(found[0].unionByName(found[1])).withColumnRenamed("node", "k")
            led = led.join(comps, F.col("node") == F.col("k"), "left").withColumn("label", F.coalesce("comp", "label")).drop("k", "comp")
        few, many = _outside_largest(led)
        found.append(materialise(few.mapInArrow(_compare_few, "u long, v long"), "proposed", few_files=True))
        work = many.agg(F.sum(F.ceil(F.col("n") / BLOCK))).first()[0] or 0  # rows that blocks against blocks would take
        if depth == MAX_DEPTH or work <= total:
            pairs = block_pairs(many.select("path", "n", "node", "label", "mh"), F.ceil(F.col("n") / BLOCK), "node")
            pairs = pairs.repartition("path", "bi", "bj").sortWithinPartitions("path", "bi", "bj")
            found.append(materialise(pairs.mapInArrow(_compare_blocks, "u long, v long"), "proposed", few_files=True))
            break
        rows = materialise(many.select("path", "node", "label", "run", "mh").mapInArrow(
            _split, "path long, node long, label long, run int"), "paths")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _outside_largest(led: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets with at most ``SMALL`` members outside their largest label, in blocks of ``WIDE`` of
    its members with all the others in each; and the members of the other buckets that hold more
    than one label."""
    labels = led.groupBy("path", "label").agg(F.count(F.lit(1)).alias("c"))
    tops = labels.groupBy("path").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("n")).select(
        "path", "n", F.col("top.label").alias("largest"), (F.col("n") - F.col("top.c")).alias("others")).filter("others > 0")
    rest = materialise(led.join(tops, "path"), "rest", few_files=True)
    near = rest.filter(F.col("others") <= SMALL).withColumn("blocks", F.ceil((F.col("n") - F.col("others")) / WIDE).cast("int"))
    outside = F.col("label") != F.col("largest")
    whole = near.filter(~outside).select("path", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), F.lit(1).alias("side"), "label", "mh")
    others = near.filter(outside).select("path", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), "label", "mh")
    few = whole.unionByName(others).repartition("path", "block").sortWithinPartitions("path", "block")
    return few, rest.filter(F.col("others") > SMALL)


def _compare_few(batches):
    """The few members outside a bucket's largest label against each other and a block of its
    members: edges between labels."""
    for _, rows in _groups(batches, 2, ["path", "block", "side", "label", "mh"]):
        rows.sort()
        k = sum(side == 0 for side, _, _ in rows)
        names = sorted({label for _, label, _ in rows})
        number = {label: i for i, label in enumerate(names)}
        labels = np.array([number[label] for _, label, _ in rows])
        m = _matrix([x for _, _, x in rows])
        pairs = []
        for i in range(k):
            hits = labels[i + 1:][(m[i + 1:] == m[i]).sum(axis=1) >= PROPOSE * COORDS]
            pairs += [(int(labels[i]), int(j)) for j in np.unique(hits)]
        yield _edges([(names[x], names[y]) for x, y in _forest(len(names), pairs)])


def _follow(batches):
    """``led``: the label of the bucket's leader, null unless the min-hashes propose a link with it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        same = (_matrix(batch.column("mh").to_pylist()) == _matrix(batch.column("lead_mh").to_pylist())).sum(axis=1) >= PROPOSE * COORDS
        led = [x if ok else None for x, ok in zip(batch.column("led").to_pylist(), same)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("path", "node", "label", "run", "mh")] + [pa.array(led, pa.int64())],
                                         names=["path", "node", "label", "run", "mh", "led"])


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted distinct hashes (or within one)."""
    both = sets + (others or [])
    if len(both) == 2:
        n = len(np.intersect1d(both[0], both[1], assume_unique=True))
        return np.array([[n]], np.int64) if others else np.array([[len(both[0]), n], [n, len(both[1])]], np.int64)
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    values, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    again = times > 1
    renamed = np.cumsum(again) - 1
    keep = again[code]
    code, owner = renamed[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    k = len(sets)
    out = np.zeros((k, len(others) if others else k), np.float64)
    total, step = int(again.sum()), 4096
    for at in range(0, total, step):
        lo, hi = np.searchsorted(code, [at, at + step])
        m = np.zeros((len(both), step), np.float32)
        m[owner[lo:hi], code[lo:hi] - at] = 1
        out += m[:k] @ (m[k:] if others else m[:k]).T
    return np.rint(out).astype(np.int64)


def _verify(batches):
    """Exact links of one pair of blocks: weighted link counts and spanning edges."""
    for _, rows in _groups(batches, 3, ["comp", "bi", "bj", "side", "node", "copies", "items"]):
        a = sorted((n, c, s) for side, n, c, s in rows if side == 0)
        b = sorted((n, c, s) for side, n, c, s in rows if side == 1)
        sa, sb = ([np.frombuffer(s, np.uint64) for _, _, s in x] for x in (a, b))
        both = shared_counts(sa, sb) if b else shared_counts(sa)
        size_a = np.array([len(s) for s in sa])
        size_b = np.array([len(s) for s in sb]) if b else size_a
        union = size_a[:, None] + size_b[None, :] - both
        linked = both * 5 >= union * 4  # similarity of 0.8 or more, in integers
        weight_a = np.array([c for _, c, _ in a])
        weight_b = np.array([c for _, c, _ in b]) if b else weight_a
        names = [n for n, _, _ in a] + [n for n, _, _ in b]
        if b:
            links = np.concatenate([linked @ weight_b, linked.T @ weight_a])
            pairs = [(int(i), len(a) + int(j)) for i, j in np.argwhere(linked)]
        else:
            np.fill_diagonal(linked, False)
            links = linked @ weight_a
            pairs = [(int(i), int(j)) for i, j in np.argwhere(np.triu(linked))]
        edges = dict((m, r) for r, m in _forest(len(names), pairs))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(links.astype(np.int64)), pa.array([names[edges.get(i, i)] for i in range(len(names))], pa.int64())],
            names=["node", "links", "root"])


def _items(batches):
    for batch in batches:
        sets = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("comp", "blocks", "node", "copies")] + [pa.array(sets, pa.binary())],
                                         names=["comp", "blocks", "node", "copies", "items"])


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.99995) -> DataFrame:
    """One row per document: ``id, th`` (hash of the text), ``class_id, n_links, n_copies`` and
    ``first``: whether it is the document (id and text) that names its class."""
    text = text_of(text_col)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    runs = runs_for(recall)
    with small_batches(docs.sparkSession):
        sketched = materialise(keyed.mapInArrow(_sketch(runs), "id long, th long, node long, size int, mh binary"), "sketches")
    nodes = sketched.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("mh").alias("mh"), F.min("size").alias("size"), F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("rep"))
    nodes = materialise(nodes, "nodes")
    comps = connected_components(propose(nodes.select("node", "mh"), runs))
    named = comps.join(nodes, "node")
    sizes = named.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / VERIFY_SETS), F.ceil(F.sum("size") / VERIFY_ITEMS)).alias("blocks"))
    chosen = named.join(sizes, "comp").select(
        "comp", "blocks", "node", "copies", F.col("rep.id").alias("r_id"), F.col("rep.th").alias("r_th"))
    items = keyed.join(chosen, keyed["id"].eqNullSafe(chosen["r_id"]) & (keyed["th"] == chosen["r_th"])).select(
        "comp", "blocks", "node", "copies", "text").mapInArrow(_items, "comp long, blocks long, node long, copies long, items binary")
    with small_batches(docs.sparkSession):
        items = materialise(items, "items").dropDuplicates(["node"])
    pairs = block_pairs(items, F.col("blocks"), "node").repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj")
    with small_batches(docs.sparkSession):
        verified = materialise(pairs.select("comp", "bi", "bj", "side", "node", "copies", "items").mapInArrow(
            _verify, "node long, links long, root long"), "verified", few_files=True)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(verified.select(F.col("root").alias("u"), F.col("node").alias("v")))
    least = joined.join(nodes.select("node", "rep"), "node").groupBy("comp").agg(F.min("rep").alias("class_rep"))
    named = joined.join(least, "comp").select("node", "class_rep")
    per_node = nodes.select("node", "copies", "rep").join(named, "node", "left").join(links, "node", "left").select(
        F.col("node").alias("k"), "copies", F.coalesce("class_rep", "rep").alias("rep"), F.coalesce("links", F.lit(0)).alias("links"))
    per_node = materialise(per_node, "classes", few_files=True)
    rows = sketched.select("id", "th", "node").join(per_node, F.col("node") == F.col("k"), "left")
    none = F.col("node").isNull()
    return rows.select(
        "id", "th",
        F.when(none, F.col("id")).otherwise(F.col("rep.id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        (none | (F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("th") == F.col("rep.th")))).alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.99995) -> DataFrame:
    """One row per document: id, ``class_id, n_links, n_copies``."""
    return classes(docs, id_col, text_col, recall).select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.99995) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id. Rows
    without words all stay; of rows repeated with one id and text, one stays."""
    docs, back = shield(docs, id_col, text_col)
    stay = classes(docs, id_col, text_col, recall).filter("first").select(
        F.col("id").alias("_stay_id"), F.col("th").alias("_stay_th"))
    marked = docs.withColumn("_th", F.xxhash64(text_of(text_col)))
    kept = marked.join(stay, marked[id_col].eqNullSafe(stay["_stay_id"]) & (marked["_th"] == stay["_stay_th"]), "left_semi")
    nth = Window.partitionBy(id_col, "_th").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    kept = kept.withColumn("_nth", F.when(F.trim(text_of(text_col)) == "", 1).otherwise(F.row_number().over(nth)))
    return unshield(kept.filter("_nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns]), back)
