"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary is that of a `tokenizers` file with word ends: text is put in
NFC and lower case, split into letter runs, single digits and runs of other
signs, and each piece is merged by itself. Pieces are merged many at a time:
every piece has a segment tree whose leaves hold the rank of the pair that
starts at a symbol, the root names the leftmost lowest-rank pair, and a merge
changes three leaves and their ancestors. Where only a few pieces are of a length, each
has a tree of plain numbers instead, which costs less for each merge.

Letters, digits, lower case and NFC are those of the `tokenizers` library; the
tables of Python 3.13 (Unicode 15.1) are completed by what differs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlode.shared import arrow_schema, slices


NONE = np.int64(1) << 62
#: Fixed values of the byte alphabet: bytes that stand for the character of the same number.
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Fixed values of Unicode: white space, and the letters and digits that version 16 has beyond 15.1, as first and last of each run.
WHITE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_DIGITS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Fixed values of Unicode 17: (first, last, first of their lower case) of capitals that 15.1 lacks.
NEW_CAPITALS = [(0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB)]
#: Single characters are lower-cased, without the rule for a sigma that ends a word.
LOWER = {ord("Σ"): ord("σ")} | {a + i: to + i for a, b, to in NEW_CAPITALS for i in range(b - a + 1)}
HAS_LOWER = re.compile("[" + "".join(map(chr, LOWER)) + "]")
BEYOND = re.compile("[\U00010000-\U0010ffff]")


def _runs(kind: str, more: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of the code points of a general category and of `more`."""
    held = np.zeros(0x110001, bool)
    held[[c for c in range(0x110000) if unicodedata.category(chr(c)).startswith(kind)]] = True
    for a, b in more:
        held[a : b + 1] = True
    turns = np.flatnonzero(np.diff(held.astype(np.int8), prepend=0)).tolist()
    return [(a, b - 1) for a, b in zip(turns[::2], turns[1::2], strict=True)]


@lru_cache(1)
def piece_patterns() -> tuple[re.Pattern, re.Pattern]:
    """Pieces of texts of characters up to U+FFFF, and of any: a short class is quicker."""
    letters, digits = _runs("L", NEW_LETTERS), _runs("N", NEW_DIGITS)

    def pattern(last: int) -> re.Pattern:
        of = lambda runs: "".join(rf"\U{a:08x}-\U{min(b, last):08x}" for a, b in runs if a <= last)
        return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{of(letters)}]+|[{of(digits)}]|[^{of(WHITE)}{of(letters)}{of(digits)}]+")

    return pattern(0xFFFF), pattern(0x10FFFF)


class PairRanks:
    """(left id, right id) -> rank of the merge, by open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bits = max(4, int(len(left) * 5).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.zeros(1 << self.bits, np.int64)
        keys, rank = self._key(left, right), np.arange(len(left))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.ranks[slot[placed]] = rank[placed]
            keys, rank, slot = keys[~placed], rank[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank, or -1."""
        keys = self._key(left, right)
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        while len(at):
            held = self.keys[slot]
            same = held == keys[at]
            out[at[same]] = self.ranks[slot[same]]
            on = ~same & (held >= 0)
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


def merge_pieces(symbols: np.ndarray, lengths: np.ndarray, pairs: PairRanks, merged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges pieces of symbols.shape[1] symbols at most: (piece by place, which places are left).

    symbols: one piece a row, filled up at will after its length. The number of
    columns is a power of two. merged: rank -> id of the merged symbol.
    """
    rows, n = symbols.shape
    sym, place = symbols.copy(), np.arange(n)
    alive = place < lengths[:, None]
    tree = np.full((rows, 2 * n), NONE)
    here = place[:-1] < lengths[:, None] - 1
    rank = pairs.find(sym[:, :-1][here], sym[:, 1:][here])
    leaves = np.full((rows, n), NONE)
    leaves[:, :-1][here] = np.where(rank >= 0, rank * n, NONE)
    tree[:, n:] = np.where(leaves < NONE, leaves + place, NONE)
    level = n
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    after, before = np.tile(place + 1, (rows, 1)), np.tile(place - 1, (rows, 1))
    after[after >= lengths[:, None]] = n
    flat, size = tree.reshape(-1), 2 * n
    a = np.flatnonzero(tree[:, 1] < NONE)
    while len(a):
        root = tree[a, 1]
        at = root % n
        gone = after[a, at]
        then = after[a, gone]
        sym[a, at] = merged[root // n]
        alive[a, gone] = False
        after[a, at] = then
        has = then < n
        before[a[has], then[has]] = at[has]
        prior = before[a, at]
        lead = prior >= 0
        new = np.full((2, len(a)), NONE)
        rank = pairs.find(sym[a[has], at[has]], sym[a[has], then[has]])
        new[0, has] = np.where(rank >= 0, rank * n + at[has], NONE)
        rank = pairs.find(sym[a[lead], prior[lead]], sym[a[lead], at[lead]])
        new[1, lead] = np.where(rank >= 0, rank * n + prior[lead], NONE)
        base = a * size
        flat[base + n + at], flat[base + n + gone] = new[0], NONE
        flat[base[lead] + n + prior[lead]] = new[1, lead]
        nodes = np.stack([n + at, n + gone, n + np.where(lead, prior, at)])
        while nodes[0, 0] > 1:
            nodes >>= 1
            below = base + 2 * nodes
            flat[base + nodes] = np.minimum(flat[below], flat[below + 1])
        a = a[tree[a, 1] < NONE]
    return sym, alive


def merge_piece(symbols: list[int], pairs: dict[int, int], merged: list[int]) -> list[int]:
    """Merges one piece by its own segment tree. pairs: left << 32 | right -> rank."""
    n = len(symbols)
    size = 1 << max(1, (n - 1).bit_length())
    none = (len(merged) + 1) * size
    rank = lambda i, j: r * size + i if (r := pairs.get(symbols[i] << 32 | symbols[j])) is not None else none
    tree = [none] * size + [rank(i, i + 1) for i in range(n - 1)] + [none] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a < b else b
            if tree[i] == least:
                return
            tree[i] = least

    while (root := tree[1]) < none:
        at = root % size
        gone = after[at]
        then, prior = after[gone], before[at]
        symbols[at], alive[gone], after[at] = merged[root // size], False, then
        put(gone, none)
        if then < n:
            before[then] = at
        put(at, rank(at, then) if then < n else none)
        if prior >= 0:
            put(prior, rank(prior, at))
    return [x for x, left in zip(symbols, alive, strict=True) if left]


class Bpe:
    """A `tokenizers` file of kind BPE with a word-end suffix, encoded as that library does with added special tokens off."""

    #: Pieces of one length from which they are merged together; longer pieces than these are not kept.
    TOGETHER, LONG = 24, 64

    def __init__(self, path: str, most_cached: int = 48 << 20):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (max(*vocab.values(), *self.special.values()) + 1)
        for token, i in (vocab | self.special).items():
            self.tokens[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairRanks(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]))
        self.merged_list = [vocab[a + b] for a, b in pairs]
        self.merged = np.array(self.merged_list)
        letters = {b: chr(b) for b in PLAIN}
        letters |= {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
        self.inner = np.array([vocab[letters[b]] for b in range(256)])
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)])
        self.pair_ranks = {int(k): int(r) for k, r in zip(self.pairs.keys, self.pairs.ranks, strict=True) if k >= 0}
        self.split = re.compile("|".join(map(re.escape, self.special)))
        self.piece, self.any_piece = piece_patterns()
        self.cache: dict[str, bytes] = {}
        self.most_cached, self.cached = most_cached, 0

    def pieces(self, text: str) -> list[str]:
        """Pieces and special tokens of a text in order."""
        out, start = [], 0
        for found in self.split.finditer(text) if "<|" in text else ():
            out += self._plain(text[start : found.start()])
            out.append(found[0])
            start = found.end()
        return out + self._plain(text[start:]) if start else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.piece.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if HAS_LOWER.search(text):
            text = text.translate(LOWER)
        text = text.lower()
        return (self.any_piece if BEYOND.search(text) else self.piece).findall(text)

    def merge(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit numbers."""
        encoded = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lengths = np.array([len(p) for p in encoded])
        widths = np.left_shift(1, np.ceil(np.log2(np.maximum(lengths, 2))).astype(int))
        out: list[bytes] = [b""] * len(pieces)
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            for some in np.array_split(own, max(1, len(own) * int(width) // (1 << 18))):
                n = lengths[some]
                if len(some) < self.TOGETHER:
                    for i in some.tolist():
                        symbols = [*self.inner[np.frombuffer(encoded[i][:-1], np.uint8)].tolist(), int(self.last[encoded[i][-1]])]
                        out[i] = np.array(merge_piece(symbols, self.pair_ranks, self.merged_list), "<u4").tobytes()
                    continue
                here = np.arange(width) < n[:, None]
                symbols = np.zeros((len(some), width), np.int64)
                symbols[here] = self.inner[np.frombuffer(b"".join(encoded[i] for i in some), np.uint8)]
                symbols[np.arange(len(some)), n - 1] = self.last[np.frombuffer(bytes(encoded[i][-1] for i in some), np.uint8)]
                symbols, left = merge_pieces(symbols, n, self.pairs, self.merged)
                ids, ends = symbols[left].astype("<u4").tobytes(), np.cumsum(left.sum(1)) * 4
                for i, a, b in zip(some.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[i] = ids[a:b]
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, packed as by merge()."""
        cut = [self.pieces(t) for t in texts]
        if self.cached > self.most_cached:
            self.cache.clear()
            self.cached = 0
        new = list({p for pieces in cut for p in pieces if p not in self.cache and p not in self.special})
        found = dict(zip(new, self.merge(new), strict=True)) | {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        short = {p: ids for p, ids in found.items() if len(p) <= self.LONG}
        # a piece and its ids cost about 200 bytes besides their own
        self.cached += sum(200 + 2 * len(p) + len(ids) for p, ids in short.items())
        self.cache |= short
        long = {p: ids for p, ids in found.items() if len(p) > self.LONG}
        return [b"".join([self.cache[p] if p in self.cache else long[p] for p in pieces]) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        """Token strings joined by a space, special tokens included: what a file without a decoder gives."""
        return b" ".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(2)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., ids): one row for each row of docs; ids are packed little-endian unsigned 32-bit numbers.

    path is the tokenizer's file, which every executor can open. Null and
    empty texts have no ids; repeated rows stay; texts are encoded whole.
    """
    named = docs.select(F.col(id_col).alias("_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    fields = [f for f in named.schema if f.name != "_text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "ids binary"])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in slices(batches, "_text", 2 << 20):
            ids = bpe.encode(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).cast(out.field(f.name).type) for f in fields), pa.array(ids, pa.binary())], schema=out)

    return named.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the text of packed ids as `encode` gives them; null ids decode to an empty text."""
    named = encoded.select(F.col(id_col).alias("_id"), F.col("ids").alias("_ids"))
    schema = f"_id {named.schema['_id'].dataType.simpleString()}, _ids binary, decoded string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in slices(batches, "_ids", 2 << 20):
            texts = [bpe.decode(x or b"") for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), batch.column(1).cast(pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())], schema=out)

    return named.mapInArrow(run, schema).withColumnsRenamed({"_id": id_col, "_ids": "ids"})
