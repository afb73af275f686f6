"""Repair of conversation structure: bidirectional Dijkstra over the edit lattice.

A conversation is well formed if its roles' initials spell ``(s?(ua)+)?``. A lattice node is a
row position with a state (nothing yet, after s, after u, after a); edges are the edits: keep a
row (0), give it the role user or assistant (1), delete it (2), insert an empty user or assistant
row (5). Blank rows and rows seen before must be deleted; a truncated row that stays costs 5 more.
A forward heap grows from the first position and a reverse heap from the last. They meet, all
crossings of equal cost are finished, and the least audit (the edits' initials, compared as ASCII)
of all cheapest paths is the repair. The audit fixes the repaired rows, since roles follow from it.

Scale: rows equal in all columns travel as one row with a count. Rows are dealt by ranges of
(conversation, turn, role, text), so a conversation of any length is spread over tasks and read in
order there. A conversation that lies whole within one task's range is repaired on the spot. The
others are cut into segments of at most ``SEGMENT`` rows and ``SEGMENT_CHARS`` characters of text
(or one row); the same search gives the cheapest way through a segment from each state to each
other, and segments' ways are composed ``FAN`` at a time until one is left. The audit then is cut
by segments again, and their repaired rows are hashed one after the other in a stream: SHA-256 runs
in order, so that last step reads one row a segment of a conversation in one task, in bounded memory.

Defined results: a null role or text reads as one space, and null ids and turns do in the damage's
key; null turns come first; rows of one turn are ordered by role and text as they were before any
damage. An empty role has no initial: such a row is never kept. Conversations without rows give
zeros, an empty audit and the hash of nothing. Rows repeated are rows. An empty table gives an empty
result. Further columns are ignored. ``gaps`` is null where it does not fit a long.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, sql_crc

SEGMENT = 512           # rows (equal ones counted once) in a segment
SEGMENT_CHARS = 1 << 20  # characters of text in a segment, if it holds more than one row
FAN = 32                # segments composed at once
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
BLANKS = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # state after a new role
BACK = {q: [p for p, r in NEXT.items() if r == q] for q in range(4)}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
KEPT_BACK = {c: {q: [p for p, r in to.items() if r == q] for q in range(4)} for c, to in KEPT.items()}
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` (as before), ``now_role``, ``now_text`` and ``n`` (how many such
    rows there are), after the damage that the key's CRC-32 names."""
    space = F.lit(" ")
    said = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"),
                       F.coalesce(F.col(text).cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = said.withColumn("hit", F.crc32(key.cast("binary")) % 20).filter("hit <> 0")
    once = hit.groupBy("conv", "turn", "role", "text", "hit").agg(F.count(F.lit(1)).alias("n"))
    return once.select(
        "conv", "turn", "role", "text",
        F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("now_role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("now_text"),
        F.when(F.col("hit") == 3, F.col("n") * 2).otherwise(F.col("n")).alias("n"))


def undamaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as they are, in the form that ``damage`` gives them."""
    space = F.lit(" ")
    said = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"),
                       F.coalesce(F.col(text).cast("string"), space).alias("text"))
    once = said.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    return once.select("conv", "turn", "role", "text", F.col("role").alias("now_role"), F.col("text").alias("now_text"), "n")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``blank``; ``real``: whether the first of its ``n`` copies is neither blank nor
    a duplicate; ``cut``: whether that one is truncated."""
    core = F.rtrim(F.col("now_text"), F.lit(BLANKS))
    marked = rows.withColumns({"digest": F.sha2("now_text", 256), "place": F.struct("turn", "role", "text"),
                               "blank": core == "", "cut": ~F.right(core, F.lit(1)).isin(".", "!", "?")})
    marked = materialise(marked, "marked")
    seen = marked.filter("NOT blank").groupBy(F.col("conv").alias("c"), F.col("now_role").alias("r"), F.col("digest").alias("d")).agg(
        F.min("place").alias("earliest"))
    on = marked["conv"].eqNullSafe(seen["c"]) & (marked["now_role"] == seen["r"]) & (marked["digest"] == seen["d"]) & ~marked["blank"]
    real = F.coalesce(F.col("place").eqNullSafe(F.col("earliest")), F.lit(False))
    return marked.join(seen, on, "left").select("conv", "turn", "role", "text", "now_role", "now_text", "n", "blank", real.alias("real"),
                                                (real & F.col("cut")).alias("cut"))


def _ways_on(step, q):
    """Edges over one step from state ``q``: (state, cost, letters)."""
    initial, cut, forced = step
    more, tail = DELETE * forced, "D" * forced
    if initial is None:
        return [(q, more, tail)]
    extra = more + TRUNCATED * cut
    out = [(q, DELETE + more, "D" + tail), (NEXT[q], REROLE + extra, "R" + tail)]
    kept = KEPT.get(initial, {}).get(q)
    if kept is not None:
        out.append((kept, KEEP + extra, "K" + tail))
    return out


def _ways_back(step, q):
    """Edges over one step that lead to state ``q``: (state before, cost, letters)."""
    initial, cut, forced = step
    more, tail = DELETE * forced, "D" * forced
    if initial is None:
        return [(q, more, tail)]
    extra = more + TRUNCATED * cut
    out = [(q, DELETE + more, "D" + tail)] + [(p, REROLE + extra, "R" + tail) for p in BACK[q]]
    return out + [(p, KEEP + extra, "K" + tail) for p in KEPT_BACK.get(initial, {}).get(q, ())]


def cheapest(steps: list, begin: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of ``steps`` (initial or None if it must go, truncated,
    deletions forced after it) from state ``begin`` to one of ``ends``; None if there are none.

    Nodes of one cost are settled in the order of their position (reverse: from the end), and every
    edge of cost zero moves by one position, so a node's audit is the least when it is settled."""
    n = len(steps)
    there = {(0, begin): (0, "")}
    back = {(n, q): (0, "") for q in ends}
    ahead, behind = [(0, 0, begin)], [(0, 0, q) for q in ends]
    settled: tuple[set, set] = (set(), set())
    best = min((0 for node in back if node in there), default=None)

    def reach(labels, others, heap, node, cost, audit, order):
        nonlocal best
        old = labels.get(node)
        if old is None or (cost, audit) < old:
            labels[node] = (cost, audit)
            if old is None or cost < old[0]:
                heapq.heappush(heap, (cost, order, node[1]))
            met = others.get(node)
            if met is not None and (best is None or cost + met[0] < best):
                best = cost + met[0]

    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best):
        if ahead[0][0] <= behind[0][0]:
            cost, i, q = heapq.heappop(ahead)
            if (i, q) in settled[0]:
                continue
            settled[0].add((i, q))
            audit = there[i, q][1]
            reach(there, back, ahead, (i, NEXT[q]), cost + INSERT, audit + "I", i)
            if i < n:
                for to, more, letters in _ways_on(steps[i], q):
                    reach(there, back, ahead, (i + 1, to), cost + more, audit + letters, i + 1)
        else:
            cost, left, q = heapq.heappop(behind)
            i = n - left
            if (i, q) in settled[1]:
                continue
            settled[1].add((i, q))
            audit = back[i, q][1]
            for p in BACK[q]:
                reach(back, there, behind, (i, p), cost + INSERT, "I" + audit, left)
            if i:
                for p, more, letters in _ways_back(steps[i - 1], q):
                    reach(back, there, behind, (i - 1, p), cost + more, letters + audit, left + 1)
    if best is None:
        return None
    crossings = (there[x][1] + back[x][1] for x in there if x in back and there[x][0] + back[x][0] == best)
    return best, min(crossings)


def ways_through(steps: list) -> list[tuple[int, int, int, str]]:
    """The cheapest edits of a segment from each state to each other: (from, to, cost, audit)."""
    found = ((a, b, cheapest(steps, a, (b,))) for a in range(4) for b in range(4))
    return [(a, b, *way) for a, b, way in found if way is not None]


def compose(first: list, second: list) -> list[tuple[int, int, int, str]]:
    """The cheapest ways through two segments, one after the other."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for a, b, cost, audit in first:
        for b2, c, cost2, audit2 in second:
            if b == b2:
                way = (cost + cost2, audit + audit2)
                if (a, c) not in out or way < out[a, c]:
                    out[a, c] = way
    return [(a, c, *way) for (a, c), way in sorted(out.items())]


def repaired(rows: list, audit: str, state: int = START) -> list[str]:
    """The ``role:text`` lines that ``audit`` makes of ``rows`` (role, text, copies)."""
    out, at = [], 0
    for role, text, copies in rows:
        while audit[at] == "I":
            state = NEXT[state]
            out.append("user:" if state == USER else "assistant:")
            at += 1
        letter = audit[at]
        if letter == "K":
            state = KEPT[role[:1]][state]
            out.append(f"{role}:{text}")
        elif letter == "R":
            state = NEXT[state]
            out.append(("user:" if state == USER else "assistant:") + text)
        at += copies  # the copies after the first are deleted
    for _ in audit[at:]:
        state = NEXT[state]
        out.append("user:" if state == USER else "assistant:")
    return out


def _steps(rows) -> list:
    return [(role[:1], cut, n - 1) if real else (None, False, n) for role, _, n, real, cut in rows]


def _illegal(rows) -> int:
    pairs = sum(n - 1 for _, _, n, _, _ in rows)  # a role beside itself
    return pairs + sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in zip(rows, rows[1:]))


ROWS = "array<struct<role:string,text:string,n:bigint,real:boolean,cut:boolean>>"
WAYS = "array<struct<begin:int,end:int,cost:bigint,audit:string>>"


def _read_ranges(conv_type: pa.DataType, segment: int, segment_chars: int):
    """Repair conversations that lie within the task's range; cut others into segments."""
    row = pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64()), ("real", pa.bool_()), ("cut", pa.bool_())])
    way = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema([("conv", conv_type), ("part", pa.int64()), ("seg", pa.int64()), ("whole", pa.bool_()), ("illegal", pa.int64()),
                        ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()), ("first", pa.string()), ("last", pa.string()),
                        ("ways", pa.list_(way)), ("rows", pa.list_(row))])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[dict] = []

        def put(conv, seg, rows, whole):
            steps = _steps(rows)
            found = {"conv": conv, "part": part, "seg": seg, "whole": whole, "illegal": _illegal(rows)}
            if whole:
                cost, audit = cheapest(steps)
                lines = repaired([(r, t, n) for r, t, n, _, _ in rows], audit)
                found |= {"cost": cost, "audit": audit, "sha": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
            else:
                found |= {"first": rows[0][0][:1], "last": rows[-1][0][:1],
                          "ways": [dict(zip(("begin", "end", "cost", "audit"), w)) for w in ways_through(steps)],
                          "rows": [dict(zip(("role", "text", "n", "real", "cut"), r)) for r in rows]}
            out.append(found)

        conv, rows, chars, seg, first = None, [], 0, 0, True
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for r in batch.slice(at, 1024).to_pylist():
                    if r["conv"] != conv and rows:
                        put(conv, seg, rows, seg == 0 and not first)
                        rows, chars, seg, first = [], 0, 0, False
                    elif rows and (len(rows) >= segment or chars + len(r["now_text"]) > segment_chars):
                        put(conv, seg, rows, False)
                        rows, chars, seg = [], 0, seg + 1
                    conv = r["conv"]
                    rows.append((r["now_role"], r["now_text"], r["n"], r["real"], r["cut"]))
                    chars += len(r["now_text"])
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if rows:
            put(conv, seg, rows, False)
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _merge(pdf):
    import pandas as pd

    pdf = pdf.sort_values(["part", "seg"])
    ways, illegal, last = None, 0, None
    for r in pdf.itertuples():
        own = [(w["begin"], w["end"], w["cost"], w["audit"]) for w in r.ways]
        illegal += r.illegal + (last is not None and last + r.first not in LEGAL)
        ways, last = own if ways is None else compose(ways, own), r.last
    return pd.DataFrame({"conv": pdf["conv"].iloc[:1].to_list(), "part": [pdf["to_part"].iloc[0]], "seg": [pdf["to_seg"].iloc[0]], "illegal": [illegal],
                         "first": [pdf["first"].iloc[0]], "last": [last],
                         "ways": [[dict(zip(("begin", "end", "cost", "audit"), w)) for w in ways]]})


def _fold(segments: DataFrame, conv_type: str, fan: int) -> DataFrame:
    """One row a conversation: ``conv, illegal, cost, audit``."""
    live = segments.select("conv", "part", "seg", "illegal", "first", "last", "ways")
    while not live.groupBy("conv").count().filter("count > 1").isEmpty():
        deep = live.agg(F.max("seg")).first()[0] > 0
        part, seg = ("part", f"seg div {fan}") if deep else (f"part div {fan}", "seg")
        live = live.withColumns({"to_part": F.expr(part), "to_seg": F.expr(seg)}).groupBy("conv", "to_part", "to_seg").applyInPandas(
            _merge, f"conv {conv_type}, part long, seg long, illegal long, first string, last string, ways {WAYS}")
        live = materialise(live, "ways", few_files=True)
    done = F.filter("ways", lambda w: (w["begin"] == START) & w["end"].isin(*ENDS))
    least = F.array_min(F.transform(done, lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"))))
    return live.select("conv", "illegal", least.alias("way")).select("conv", "illegal", "way.cost", "way.audit")


def _pieces(batches):
    """Cut each conversation's audit by its segments: the letters, and the state they begin in."""
    for batch in batches:
        convs, parts, segs, states, pieces = [], [], [], [], []
        for r in batch.select(["audit", "segments"]).to_pylist():
            audit, at, state = r["audit"], 0, START
            for k, s in enumerate(r["segments"]):
                begin = at
                parts.append(s["part"])
                segs.append(s["seg"])
                states.append(state)
                for m in s["marks"]:
                    while audit[at] == "I":
                        state, at = NEXT[state], at + 1
                    letter = audit[at]
                    state = NEXT[state] if letter == "R" else KEPT[m["initial"]][state] if letter == "K" else state
                    at += m["n"]  # the copies after the first are deleted
                if k == len(r["segments"]) - 1:
                    at = len(audit)
                pieces.append(audit[begin:at])
            convs.append(len(r["segments"]))
        which = [i for i, k in enumerate(convs) for _ in range(k)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv").take(pa.array(which, pa.int64())), pa.array(parts, pa.int64()), pa.array(segs, pa.int64()),
             pa.array(states, pa.int32()), pa.array(pieces, pa.string())], names=["conv", "part", "seg", "state", "piece"])


def _lines(batches):
    for batch in batches:
        out = []
        for r in batch.select(["rows", "state", "piece"]).to_pylist():
            lines = repaired([(x["role"], x["text"], x["n"]) for x in r["rows"]], r["piece"], r["state"])
            out.append("".join(f"\n{x}" for x in lines).encode())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("conv", "part", "seg")] + [pa.array(out, pa.binary())],
                                         names=["conv", "part", "seg", "lines"])


def _stream_hash(conv_type: pa.DataType):
    def run(batches):
        conv, state, begun, found = None, None, False, []

        def end():
            if state is not None:
                found.append((conv, state.hexdigest()))

        for batch in batches:
            for i in range(batch.num_rows):
                this, lines = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                if state is None or this != conv:
                    end()
                    conv, state, begun = this, hashlib.sha256(), False
                state.update(lines if begun else lines[1:])
                begun = begun or bool(lines)
        end()
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], conv_type), pa.array([s for _, s in found], pa.string())],
                                         names=["conv", "sha"])

    return run


def repair_rows(rows: DataFrame, segment: int = SEGMENT, segment_chars: int = SEGMENT_CHARS, fan: int = FAN) -> DataFrame:
    """``conv, illegal, cost, audit, sha`` of the conversations in ``rows`` (``faults``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type, arrow_type = rows.schema["conv"].dataType.simpleString(), to_arrow_type(rows.schema["conv"].dataType)
    order = ["conv", "turn", "role", "text"]
    dealt = rows.drop("blank").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "now_role", "now_text", "n", "real", "cut")
    read = materialise(dealt.mapInArrow(
        _read_ranges(arrow_type, segment, segment_chars),
        f"conv {conv_type}, part long, seg long, whole boolean, illegal long, cost long, audit string, sha string, first string, last string, "
        f"ways {WAYS}, rows {ROWS}"), "ranges")
    whole = read.filter("whole").select("conv", "illegal", "cost", "audit", "sha")
    segments = read.filter("NOT whole")
    folded = materialise(_fold(segments, conv_type, fan), "folded", few_files=True)
    marks = F.transform("rows", lambda r: F.struct(F.substring(r["role"], 1, 1).alias("initial"), r["n"].alias("n")))
    named = segments.select("conv", F.struct("part", "seg", marks.alias("marks")).alias("s"))
    listed = named.groupBy(F.col("conv").alias("c")).agg(F.sort_array(F.collect_list("s")).alias("segments"))
    cut = folded.join(listed, folded["conv"].eqNullSafe(listed["c"])).select("conv", "audit", "segments").mapInArrow(
        _pieces, f"conv {conv_type}, part long, seg long, state int, piece string")
    cut = cut.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("seg").alias("s"), "state", "piece")
    met = segments.join(cut, segments["conv"].eqNullSafe(cut["c"]) & (segments["part"] == cut["p"]) & (segments["seg"] == cut["s"]))
    lines = met.select("conv", "part", "seg", "rows", "state", "piece").mapInArrow(_lines, f"conv {conv_type}, part long, seg long, lines binary")
    hashed = lines.repartition("conv").sortWithinPartitions("conv", "part", "seg").mapInArrow(
        _stream_hash(arrow_type), f"conv {conv_type}, sha string").withColumnRenamed("conv", "c")
    rest = folded.join(hashed, folded["conv"].eqNullSafe(hashed["c"])).select("conv", "illegal", "cost", "audit", "sha")
    return whole.unionByName(rest)


def repair(conversations: DataFrame, id_col: str = "conv_id", damaged: bool = True, segment: int = SEGMENT,
           segment_chars: int = SEGMENT_CHARS, fan: int = FAN) -> DataFrame:
    """One row a conversation: its faults, the cost and audit of its repair, and the repaired rows' hash."""
    rows = materialise(faults((damage if damaged else undamaged)(conversations, id_col)), "faults")
    per_turn = rows.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - F.col("real").cast("long")).otherwise(0)).alias("duplicate"),
        F.sum(F.col("cut").cast("long")).alias("truncated"))
    turn = F.col("turn").cast("decimal(20,0)")
    spread = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count("turn"), F.lit(0))
    counted = per_turn.groupBy(F.col("conv").alias("c1")).agg(
        spread.cast("string").try_cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    found = repair_rows(rows, segment, segment_chars, fan).withColumnRenamed("conv", "c2")
    convs = conversations.select(F.col(id_col).alias("conv")).distinct()
    joined = convs.join(counted, convs["conv"].eqNullSafe(counted["c1"]), "left")
    joined = joined.join(found, joined["conv"].eqNullSafe(found["c2"]), "left")
    none = F.col("audit").isNull()
    return joined.select(
        F.col("conv").alias(id_col), F.when(none, 0).otherwise(F.col("gaps")).cast("long").alias("gaps"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _add(way: str, cost: str, letters: str) -> str:
    """SQL: a way (nine digits of cost, then the audit) with an edit added; null stays null."""
    return f"lpad(CAST(CAST({way}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {way}[10:] || '{letters}'"


def _oracle() -> str:
    # b0..b3: ways to a state before a row's position is left, after any inserted rows
    inserted = {0: "s0", 1: "s1", 2: f"least(s2, {', '.join(_add(f's{q}', '5', 'I') for q in (0, 1, 3))})",
                3: f"least(s3, {_add('s2', '5', 'I')}, {_add('s0', '10', 'II')}, {_add('s1', '10', 'II')})"}
    stay = lambda q: _add(f"b{q}", "2", "D")
    new = lambda q: f"CASE WHEN real THEN {_add(f'b{q}', '1 + 5 * cut', 'R')} END"
    keep = lambda c, q: f"CASE WHEN real AND role[1:1] = '{c}' THEN {_add(f'b{q}', '5 * cut', 'K')} END"
    moved = [stay(0), f"least({stay(1)}, {keep('s', 0)})",
             f"least({stay(2)}, {', '.join(f(q) for q in (0, 1, 3) for f in (new, lambda q: keep('u', q)))})",
             f"least({stay(3)}, {new(2)}, {keep('a', 2)})"]
    white = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
    {sql_crc("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit FROM conversations),
hurt AS (SELECT conv_id, turn, role0, text0, CASE WHEN hit = 4 THEN 'user' ELSE role0 END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text
  FROM given, range(2) t(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, text0) AS k FROM hurt),
marked AS (SELECT *, NOT regexp_matches(text, '{white}') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1:1] AS pair FROM placed),
flagged AS (SELECT *, NOT blank AND NOT seen AS real, CASE WHEN NOT blank AND NOT seen AND open_end THEN 1 ELSE 0 END AS cut FROM marked),
walk(conv_id, k, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM flagged
  UNION ALL
  SELECT conv_id, k, {', '.join(moved)} FROM (
    SELECT w.conv_id, f.k, f.role, f.real, f.cut, {', '.join(f'{x} AS b{q}' for q, x in inserted.items())}
    FROM walk w JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1)),
ended AS (SELECT conv_id, least(s0, {inserted[3]}) AS way FROM walk
  WHERE k = (SELECT max(k) FROM flagged f WHERE f.conv_id IS NOT DISTINCT FROM walk.conv_id)),
letters AS (SELECT conv_id, i, way[9 + i:9 + i] AS letter FROM ended, range(1, 1 + CAST((SELECT max(length(way)) FROM ended) AS BIGINT)) t(i)
  WHERE i <= length(way) - 9),
counted AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS k, count(*) FILTER (letter <> 'D') OVER w AS o FROM letters
  WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
put AS (SELECT c.conv_id, c.i, c.letter, c.o, CASE WHEN c.letter = 'I' THEN '' ELSE f.text END AS text, CASE WHEN c.letter = 'K' THEN f.role END AS role
  FROM counted c LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.k = c.k WHERE c.letter <> 'D'),
begun AS (SELECT *, max(CASE WHEN o = 1 AND role[1:1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM put),
lines AS (SELECT conv_id, string_agg(coalesce(role, CASE WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY i) AS body
  FROM begun GROUP BY conv_id),
totals AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (NOT blank AND seen) AS duplicate, sum(cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id),
convs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(CAST(way[1:9] AS BIGINT), 0) AS cost,
  coalesce(way[10:], '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM convs c LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()
