"""Packing tokenised documents into fixed-length sequences.

Documents are tokenised where they are scanned; only pieces (id, start, length, checksum)
travel on. A document longer than a sequence is cut into whole sequences and a rest. The
pieces are dealt into randomised groups of bounded size by a number written with the piece (so
rows repeated with one id and text are spread too), and each group is packed by itself, first-fit decreasing: a
tournament tree over the bins' free capacities finds the first bin that still holds a piece
in log(bins) steps.

Distinct words repeat far more often than they occur first, so each worker keeps the ids of
words it has met (at most ``MEMO`` of them; beyond that it starts afresh). Words are cut at
plain spaces and line ends, where the tokenizer cuts as well, and go through its own
normaliser, pre-tokenizer and model.

Defined results: a null text is empty and becomes the single end id. Rows repeated with one
id are packed as separate documents. An empty table gives an empty result. Further columns
are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches, text_of

LENGTH = 2048
GROUP = 4096     # pieces in a group, on average
MEMO = 200_000   # words, and as many word pieces, whose ids a worker remembers: some 60 MB
END_ID = 1
PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long"
NUMBERED = PIECES + ", nth long"  # nth: a number of the written piece, different for equal rows too


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordMemo:
    """Ids of texts, by way of a bounded memory of words.

    Words of Latin-1 characters are normalised and cut here by the tokenizer's published
    rules (lower case; its word pattern; bytes shown as characters); any other word goes
    through the tokenizer's own normaliser and pre-tokenizer. The model is its own throughout.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.norm, self.pre, self.model = self.tok.normalizer, self.tok.pre_tokenizer, self.tok.model
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.shown = {b: chr(b) for b in shown} | {
            b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.latin = {i: "".join(self.shown[b] for b in chr(i).encode()) for i in range(128, 256)}
        # fixed value: the tokenizer's word pattern, written out for lower-case Latin-1
        self.find = re.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾\s]+").findall
        self.plain = re.compile(r"[!-~\u00a1-\u00ac\u00ae-\u00ff]*").fullmatch

    def _part(self, part: str) -> bytes:
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part)])
        if len(self.parts) >= MEMO:
            self.parts.clear()
        self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        parts = self.parts
        if self.plain(word):
            found = self.find(word.lower())
            if not word.isascii():
                found = [p.translate(self.latin) for p in found]
        else:
            found = [p for p, _ in self.pre.pre_tokenize_str(self.norm.normalize_str(word))]
        out = b"".join([parts.get(p) or self._part(p) for p in found])
        if len(self.words) >= MEMO:
            self.words.clear()
            self.words[""] = b""
        self.words[word] = out
        return out

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``."""
        if any(s in text for s in self.specials):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        get, word = self.words.get, self._word
        out = []
        for w in text.replace("\n", " ").split(" "):
            x = get(w)
            out.append(word(w) if x is None else x)
        return b"".join(out)


def cut_points(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    return [(s, min(length, n - s)) for s in range(0, n, length)]


def _tokenise(path: str, length: int):
    def run(batches):
        from pyspark import TaskContext

        nth = TaskContext.get().partitionId() << 40
        memo = WordMemo(path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memo.ids(text.as_py()) + end
                n = len(ids) // 4
                for start, size in cut_points(n, length):
                    for column, value in zip(out, (doc, start, size, zlib.crc32(ids[4 * start: 4 * (start + size)]), n, nth)):
                        column.append(value)
                    nth += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["id", "start", "length", "ids_crc32", "doc_tokens", "nth"])

    return run


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. The tree's leaves are bins in order of opening, each
    inner node the larger free capacity below it; a walk from the root finds the first fit."""
    n = len(sizes)
    leaves = 1
    while leaves < max(n, 1):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[i])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= need
        node //= 2
        while node:
            most = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
    return bins, offsets


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         length: int = LENGTH, group: int = GROUP, seed: int = 7) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = tokenizer or default_tokenizer()
    pieces = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(
        _tokenise(path, length), NUMBERED)
    with small_batches(docs.sparkSession):
        pieces = materialise(pieces, "pieces")
    groups = F.greatest(F.lit(1), F.ceil(pieces.agg(F.count(F.lit(1))).scalar() / group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "nth"), groups))

    def place(pdf):
        pdf = pdf.sort_values(["length", "id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), length)
        return pdf.assign(sequence_id=pdf["group"].to_numpy() * (1 << 24) + bins, offset=offsets)[
            ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    placed = dealt.groupBy("group").applyInPandas(place, PIECES + ", sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
