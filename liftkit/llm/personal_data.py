"""Personal data by patterns and a linear-chain conditional random field.

Patterns find the regular forms of e-mail addresses, IPv4 addresses, payment cards and phone
numbers. A conditional random field adds the irregular ones (spelled-out addresses, phone numbers
without a country code, IPv6, masked or dotted cards). Its features are word shapes: a token's shape
and those of two neighbours on either side, alone and in pairs, with white space before a token as
part of the shape and a few cue words as shapes of their own. It is trained on the driver from a
small labelled table (``labelled_table``, ``ROWS`` rows made by rule from the fixed templates below,
or the caller's table of at most ``ROWS`` rows) by gradient steps on the penalised log-likelihood,
and travels to the tasks as a few arrays. Tasks decode windows of many texts at once by Viterbi
over numpy batches.

One narrow pass over the texts, which never travel. A window reaches ``REACH`` characters to each
side of every digit, ``@`` or written-out dot, over the whole text; windows that touch are one
window, whatever its length; one of over ``STRETCH`` tokens is decoded a stretch at a time, each with
``CONTEXT`` tokens to either side. Each pattern runs in time linear in the text.

Spans are ``kind:start:end`` in code points, the end exclusive, in the order of start, then kind. A
span of the random field that overlaps a pattern's span is left out, and so are phones without 7 to
15 digits and cards without 12 to 19 digits or mask signs; patterns' spans always stay.
The counts ``n_email, n_ip, n_card, n_phone`` are of the patterns' spans.

Defined results: a null text is empty and has no spans. Rows repeated give equal rows, null ids stay
null. An empty table gives an empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

KINDS = ("email", "ip", "card", "phone")
ROWS = 1200      # labelled rows trained on, at most
REACH = 40       # characters around a trigger
STRETCH = 512    # tokens of a window decoded together
CONTEXT = 64     # tokens read besides to each side of a stretch
BATCH = 200_000  # tokens decoded at once

# ---- patterns

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMERIC = re.compile(r"[0-9+][0-9+ .()-]*")  # every address, card and phone number lies in one of these
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """An address begins where its run of local characters does, or where the last one ended."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                out.append((start, m.end()))
                free = m.end()
        free = max(free, at + 1)  # no local part reaches over an @
        at = text.find("@", at + 1)
    return out


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind (its place in KINDS), end`` of the patterns' spans, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for region in _NUMERIC.finditer(text):
        a, b = region.span()
        if b - a < 7:
            continue  # shorter than the shortest address
        for m in _IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in region.group():
            for m in _PHONE.finditer(text, a, b):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- tokens and shapes

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_TRIGGER = re.compile(r"[0-9]++|@")
_DOT = re.compile(r"(?i)\b(?:dot|punkt|punto|point)\b|[(\[] ?(?:at|arroba|arobase) ?[)\]]")
# fixed values: cue words by class
CUES = {
    "tel": "tel phone telephone call fax mobile cell telefon telefono teléfono téléphone handy rufen appelez llame ring".split(),
    "mail": "mail email e correo courriel write schreiben écrire escribir contact kontakt".split(),
    "at": "at arroba arobase".split(),
    "dot": "dot punkt punto point".split(),
    "ip": "ip ipv6 host server address adresse dirección router".split(),
    "card": "card visa mastercard amex karte carte tarjeta credit kreditkarte".split(),
    "tld": "com org net de fr es edu info".split(),
}
_CUE = {w: c for c, ws in CUES.items() for w in ws}
_PUNCTUATION = frozenset("()[].-/:@+,;|$%#*=\"'<>")


def shape(token: str) -> str:
    """The shape of a token: its cue class, its digits' number, or its runs of character kinds."""
    low = token.lower()
    if low in _CUE:
        return _CUE[low]
    n = len(token)
    if not token[0].isalnum():
        return token if token in _PUNCTUATION else "p"
    if token.isdecimal():
        return f"d{n}" if n <= 5 else "d6-9" if n <= 9 else "d10-12" if n <= 12 else "d13+"
    if n <= 4 and all(c in "0123456789abcdef" for c in low) and any(c.isdecimal() for c in low):
        return "hex"
    if token.isalpha():
        if n <= 4 and set(low) == {"x"}:
            return "mask"
        return "x" if n == 1 else "xx" if token.islower() else "XX" if token.isupper() else "Xx"
    return "mixed" if n <= 12 else "mixed+"


def tokens(text: str, start: int = 0, end: int | None = None) -> tuple[list[int], list[int], list[str]]:
    """Starts, ends and shapes of the tokens in ``text[start:end]``; ``_`` marks white space before."""
    starts, ends, shapes = [], [], []
    last = -1
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        a, b = m.span()
        starts.append(a)
        ends.append(b)
        shapes.append(("" if a == last else "_") + shape(m.group()))
        last = b
    return starts, ends, shapes


def windows(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Stretches around digits, ``@`` and written-out dots, widened to white space."""
    marks = [m.span() for m in _TRIGGER.finditer(text)]
    written = [m.span() for m in _DOT.finditer(text)]
    if written:
        marks = sorted(marks + written)
    out: list[list[int]] = []
    for begin, end in marks:
        a, b = max(0, begin - reach), min(len(text), end + reach)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


# ---- the labelled table

# fixed values: contexts and forms; # is a digit, ~ a word, {} the labelled form
CONTEXTS = {
    "phone": ["call me on {} please", "tel. {}", "Tel: {} ~", "phone {} or ~", "~ fax {}", "mobile: {}", "Telefon {} ~", "rufen ~ {} an",
              "téléphone : {} ~", "appelez le {}", "teléfono {}", "llame al {} ~", "contact ~ {} ~", "~ ~ {} ~ ~", "ring {} after ~"],
    "email": ["write to {} ~", "mail {}", "E-mail: {}", "contact {} ~ ~", "schreiben ~ an {}", "écrire à {} ~", "correo {} ~", "~ ~ {} ~", "~: {}"],
    "ip": ["from {} ~", "host {} ~", "server {} port ####", "ip {} ~", "~ ~ {} ~", "Adresse {} ~"],
    "card": ["card {} ~", "visa: {}", "paid by card {}", "Karte {} ~", "carte {} ~", "tarjeta {} ~", "credit card no. {} ~"],
}
FORMS = {
    "phone": ["(###) ###-####", "###-###-####", "###.###.####", "0## ## ## ## ##", "0### #######", "00## ### #######", "(0##) #### ####"],
    "email": ["~ at ~ dot com", "~ [at] ~ [dot] org", "~ (at) ~.com", "~ @ ~.net", "~ AT ~ DOT com", "~.~ at ~ dot de", "~ (at) ~ (dot) fr", "~## at ~ dot com"],
    "ip": ["2001:db#:#::#", "fe8#::#a##:##ff:fe##:####", "2a0#:####:##::#", "2001:0db8:85a#:0000:0000:8a2e:0370:####"],
    "card": ["####.####.####.####", "####/####/####/####", "xxxx xxxx xxxx ####", "****-****-****-####", "XXXX-XXXX-XXXX-####", "#### #### #### xxxx"],
}
OTHERS = ["~ ~ ~ ~ 2###-0#-1# ~", "~ 1#.0#.20## ~ ~", "at 1#:##:## ~ ~", "~ $ #,###.## ~", "version #.#.# ~", "v#.##.## ~ ~", "order ######### ~",
          "~ ################", "######### ~ ~", "~ ~ ####### ~", "isbn 978-#-##-######-# ~", "~ | ## | ## | ~", "| ~ | ####### | ~ |", "pages ##-## ~",
          "~ 19##-20## ~", "##% ~ ~", "# # # # # ~", "~ the dot com ~", "meet at ~ ~ ##", "~ at ~ ~ point ~", "score #-# ~", "~ ####x#### ~", "section #.#.#.# ~",
          "token = \"a#b##cd##e#f##\" ~", "~ ##!! ~", "~ ### ~", "~ #### ~ ~", "~, ##. ~", "key: ##a#f##c#b#", "~ ###,### ~", "call ~ ~ at ##", "the card ~ ~ ##",
          "server ~ ~ ##.#", "~ ### / ### ~", "figure ##: ~", "~ ### - ### ~", "(##) ~ ~", "[##] ~ ~", "~ ##### ~ #####", "~ ################ ~", "0.#### 0.#### ~",
          "~ ######-#### ~", "~ point ~ ~", "~ dot ~ ~ at ~", "~ ~ mail ~ ~", "###############", "~ http ~ / ~ ? ~ = ##", "~_## ~_##", "C## ~ ##/## ~",
          "~$$$ ~%%% ################$$$ ~&&& ~***", "~*** ~ token = \"a#b##cd##e#f##\"$$$ ~%%%", "~&&& ~.%%% ################*** ~$$$ ~,&&&",
          "~$$$ ~ *** ~%%% ~ ####### ~&&&", "~%%% token = \"##a#f##c#b#\"%%% ~ &&& ~***", "secret = \"a##bc#d##\" ~ $$$", "~ ################&&& ~$$$", "~, ~. ~ ################ ~. ~",
          "## ## ## ## ## ## ## ## ##", "~ ## ## ## ## ## ~", "### ### ### ### ###", "#### #### #### ####", "## ## ## ## ## ## ## ## ## ## ## ## ## ## ## ## ##",
          "~ ### ## ## ## ~", "#.# #.# #.# #.# #.#", "#-# #-# #-#", "### ### ## ## ## ## ## ##", "#,# #,# #,#", "## # ## # ## # ~"]


def _fill(pattern: str, rnd) -> str:
    vowels, others = "aeiou", "bcdlmnrst"
    out = []
    for c in pattern:
        if c == "#":
            out.append(str(int(rnd.integers(10))))
        elif c == "~":
            word = "".join(others[int(rnd.integers(9))] + vowels[int(rnd.integers(5))] for _ in range(int(rnd.integers(1, 5))))
            out.append(word.capitalize() if rnd.random() < 0.15 else word)
        else:
            out.append(c)
    return "".join(out)


def labelled_table(rows: int = ROWS, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``rows`` rows of text with its spans (kind, start, end), half of them without any; the others
    stand alone or beside other text."""
    rnd = np.random.default_rng(seed)
    out = []
    for i in range(rows):
        if i % 2:
            out.append((_fill(OTHERS[(i // 2) % len(OTHERS)], rnd), []))
            continue
        kind = KINDS[(i // 2) % len(KINDS)]
        before, after = CONTEXTS[kind][int(rnd.integers(len(CONTEXTS[kind])))].split("{}")
        around = [_fill(OTHERS[int(rnd.integers(len(OTHERS)))], rnd) if rnd.random() < 0.5 else "" for _ in range(2)]
        head, form = f"{around[0]} {_fill(before, rnd)}".lstrip(), _fill(FORMS[kind][int(rnd.integers(len(FORMS[kind])))], rnd)
        out.append((f"{head}{form}{_fill(after, rnd)} {around[1]}".rstrip(), [(kind, len(head), len(head) + len(form))]))
    return out


# ---- the random field

LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]  # B at 1 + 2k, I at 2 + 2k
ALLOWED = np.array([[j == 0 or j % 2 == 1 or i in (j, j - 1) for j in range(len(LABELS))] for i in range(len(LABELS))])
OPENING = np.array([j == 0 or j % 2 == 1 for j in range(len(LABELS))])
SLOTS = 7  # shapes at -2, -1, 0, 1, 2; pairs (-1, 0), (0, 1)


class Field:
    """Weights: ``emit`` (slot, shape or pair, label), ``move`` (label, label), ``start`` (label)."""

    def __init__(self, names: dict[str, int], pairs: dict[tuple[int, int], int], emit: list[np.ndarray], move: np.ndarray, start: np.ndarray):
        self.names, self.pairs, self.emit, self.move, self.start = names, pairs, emit, move, start
        size = len(names) + 2  # 0: beyond the text, 1: a shape not seen in training
        table = np.zeros((size, size), np.int64)
        for (a, b), k in pairs.items():
            table[a, b] = k
        self.table = table

    def features(self, shapes: list[str]) -> np.ndarray:
        """One row a token: the index of each slot's shape or pair."""
        ids = np.array([self.names.get(s, 1) for s in shapes], np.int64)
        n = len(ids)
        wide = np.zeros(n + 4, np.int64)
        wide[2: n + 2] = ids
        around = [wide[i: n + i] for i in range(5)]
        return np.stack([*around, self.table[around[1], around[2]], self.table[around[2], around[3]]], axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return sum(self.emit[s][features[..., s]] for s in range(SLOTS))

    def decode(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence of features, by Viterbi over all of them at once."""
        lengths = np.array([len(f) for f in batch])
        order = np.argsort(-lengths, kind="stable")
        longest, k = int(lengths.max()), len(LABELS)
        live_at = [int(np.searchsorted(-lengths[order], -t, side="left")) for t in range(longest)]  # sequences longer than t
        flat = self.scores(np.concatenate([batch[i] for i in order]))
        begin = np.concatenate([[0], np.cumsum(lengths[order])])[:-1]
        back = [np.zeros((0, k), np.int8)]
        best = flat[begin] + np.where(OPENING, self.start, -np.inf)
        move = np.where(ALLOWED, self.move, -np.inf)
        for t in range(1, longest):
            n = live_at[t]
            via = best[:n, :, None] + move
            came = via.argmax(axis=1)
            best[:n] = np.take_along_axis(via, came[:, None, :], axis=1)[:, 0] + flat[begin[:n] + t]
            back.append(came.astype(np.int8))
        at = best.argmax(axis=1)
        out = [np.zeros(n, np.int8) for n in lengths]
        path = np.zeros(int(lengths.sum()), np.int8)
        path[begin + lengths[order] - 1] = at
        for t in range(longest - 1, 0, -1):
            n = live_at[t]
            at[:n] = back[t][np.arange(n), at[:n]]
            path[begin[:n] + t - 1] = at[:n]
        for place, i in enumerate(order):
            out[i] = path[begin[place]: begin[place] + lengths[i]]
        return out


def _labels(starts: list[int], ends: list[int], spans: list[tuple[str, int, int]]) -> np.ndarray:
    y = np.zeros(len(starts), np.int64)
    for kind, a, b in spans:
        inside = [i for i, (s, e) in enumerate(zip(starts, ends)) if s >= a and e <= b]
        if inside:
            y[inside] = 2 + 2 * KINDS.index(kind)
            y[inside[0]] -= 1
    return y


def train(table: list[tuple[str, list[tuple[str, int, int]]]] | None = None, steps: int = 80, penalty: float = 0.05, rows: int = ROWS) -> Field:
    """Fit the field to at most ``rows`` rows of (text, spans) by sign-based gradient steps (Rprop)."""
    table = (labelled_table(rows) if table is None else table)[:rows]
    read = [tokens(text) for text, _ in table]
    kept = [i for i, r in enumerate(read) if r[0]]
    k = len(LABELS)
    names = {s: i + 2 for i, s in enumerate(sorted({s for i in kept for s in read[i][2]}))}
    seen = set()
    for i in kept:
        ids = [0, *[names[s] for s in read[i][2]], 0]
        seen.update(zip(ids, ids[1:]))
    pairs = {p: i + 1 for i, p in enumerate(sorted(seen))}
    sizes = [len(names) + 2] * 5 + [len(pairs) + 1] * 2
    field = Field(names, pairs, [np.zeros((n, k)) for n in sizes], np.zeros((k, k)), np.zeros(k))
    if not kept:
        return field
    feats = [field.features(read[i][2]) for i in kept]
    gold = [_labels(read[i][0], read[i][1], table[i][1]) for i in kept]
    longest, n = max(map(len, gold)), len(gold)
    x, y, there = np.zeros((n, longest, SLOTS), np.int64), np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for i, (f, g) in enumerate(zip(feats, gold)):
        x[i, : len(g)], y[i, : len(g)], there[i, : len(g)] = f, g, True
    params = [*field.emit, field.move, field.start]
    rate, last = [np.full(p.shape, 0.1) for p in params], [np.zeros(p.shape) for p in params]
    sums = [_grouped(x[there][:, slot], len(field.emit[slot])) for slot in range(SLOTS)]
    for _ in range(steps):
        for p, g, r, old in zip(params, _gradient(field, x, y, there, penalty, sums), rate, last):
            same = np.sign(g) * np.sign(old)
            r *= np.where(same > 0, 1.2, np.where(same < 0, 0.5, 1.0))
            np.clip(r, 1e-4, 0.5, out=r)
            p += np.sign(g) * r
            old[...] = np.where(same < 0, 0, g)
    return field


def _grouped(index: np.ndarray, size: int):
    """A function that sums rows by ``index``."""
    order = np.argsort(index, kind="stable")
    held, first = np.unique(index[order], return_index=True)

    def total(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((size, rows.shape[1]))
        out[held] = np.add.reduceat(rows[order], first, axis=0)
        return out

    return total


def _gradient(field: Field, x, y, there, penalty: float, sums) -> list[np.ndarray]:
    """The gradient of the penalised log-likelihood: counts in the labels less expected counts, by
    a forward and a backward pass over all rows, scaled at each position."""
    n, longest = y.shape
    k = len(LABELS)
    emit = field.scores(x)
    emit = np.exp(emit - emit.max(axis=2, keepdims=True))
    move = np.where(ALLOWED, np.exp(field.move), 0.0)
    ahead, behind, scale = np.zeros((n, longest, k)), np.ones((n, longest, k)), np.ones((n, longest, 1))
    for t in range(longest):
        a = (ahead[:, t - 1] @ move if t else np.where(OPENING, np.exp(field.start), 0.0)) * emit[:, t]
        scale[:, t] = a.sum(axis=1, keepdims=True)
        ahead[:, t] = a / scale[:, t]
    for t in range(longest - 2, -1, -1):
        b = (emit[:, t + 1] * behind[:, t + 1]) @ move.T / scale[:, t + 1]
        behind[:, t] = np.where(there[:, t + 1, None], b, 1.0)
    share = ahead * behind * there[:, :, None]
    hit = np.zeros((n, longest, k))
    np.put_along_axis(hit, y[:, :, None], 1.0, axis=2)
    gap = (hit - share)[there]
    out = [total(gap) - penalty * w for total, w in zip(sums, field.emit)]
    g = np.zeros((k, k))
    for t in range(1, longest):
        both = there[:, t]
        g -= move * (ahead[both, t - 1].T @ (emit[both, t] * behind[both, t] / scale[both, t]))
        g += hit[both, t - 1].T @ hit[both, t]
    out.append(np.where(ALLOWED, g - penalty * field.move, 0))
    out.append(np.where(OPENING, (hit[:, 0] - share[:, 0]).sum(axis=0) - penalty * field.start, 0))
    return out


def _plausible(text: str, start: int, kind: int, end: int) -> bool:
    least, most, signs = {"card": (12, 19, "0123456789xX*"), "phone": (7, 15, "0123456789")}.get(KINDS[kind], (0, 0, ""))
    return not signs or least <= sum(c in signs for c in text[start:end]) <= most


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """``start, kind, end`` of the spans that the field marks in each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, list[int], list[int]]] = []
    parts: list[np.ndarray] = []  # features of the stretches with their context
    owners: list[tuple[int, int, int]] = []  # window, first token and end of what counts of a stretch

    def flush():
        labels = [np.zeros(len(starts), np.int8) for _, starts, _ in held]
        for (w, a, b), y in zip(owners, field.decode(parts) if parts else []):
            skip = min(a, CONTEXT)
            labels[w][a:b] = y[skip: skip + b - a]
        for (doc, starts, ends), y in zip(held, labels):
            marked = np.flatnonzero(y)
            for i in marked[(y[marked] % 2) == 1].tolist():
                j = i + 1
                while j < len(y) and y[j] == y[i] + 1:
                    j += 1
                span = (starts[i], int(y[i] - 1) // 2, ends[j - 1])
                if _plausible(texts[doc], *span):
                    out[doc].append(span)
        for x in (held, parts, owners):
            x.clear()

    size = 0
    for doc, text in enumerate(texts):
        for a, b in windows(text):
            while a and not text[a - 1].isspace() and b - a < 4 * REACH:
                a -= 1
            starts, ends, shapes = tokens(text, a, b)
            features = field.features(shapes)
            for at in range(0, len(starts), STRETCH):
                owners.append((len(held), at, min(len(starts), at + STRETCH)))
                parts.append(features[max(0, at - CONTEXT): at + STRETCH + CONTEXT])
            held.append((doc, starts, ends))
            size += len(starts)
            if size >= BATCH:
                flush()
                size = 0
    flush()
    return out


def _name(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def merge(base: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All base spans and those added ones that overlap none of them, in order."""
    if not added:
        return base
    out, edges = list(base), sorted((a, b) for a, _, b in base)
    reach, furthest = 0, []
    for _, b in edges:
        reach = max(reach, b)
        furthest.append(reach)
    begins = np.array([a for a, _ in edges])
    for a, k, b in added:
        before = int(np.searchsorted(begins, b))  # base spans that begin before this one ends
        if not before or furthest[before - 1] <= a:
            out.append((a, k, b))
    return sorted(out)


def _find(field: Field):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            bases = [pattern_spans(t) for t in texts]
            spans = [_name(merge(b, f)) for b, f in zip(bases, field_spans(field, texts))]
            counts = [[sum(k == kind for _, k, _ in b) for b in bases] for kind in range(len(KINDS))]
            digests = [hashlib.sha256(_name(b).encode()).hexdigest() for b in bases]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per document: id, the patterns' counts, the hash of their spans, and all spans."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    found = rows.mapInArrow(_find(field or train()), "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return found.withColumnRenamed("id", id_col)
