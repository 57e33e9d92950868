"""Byte-level BPE encoding and decoding with a fixed public vocabulary.

Encoding merges the adjacent pair of lowest rank, leftmost first, until no pair can merge. A segment tree over the
ranks of adjacent pairs holds the next merge at its root; each merge updates three leaves in logarithmic time, so a
pre-token of n bytes takes O(n log n), however long it is. The trees of a batch's new pre-tokens stand side by side in
arrays, and each step merges one pair of every pre-token. Documents are independent, so Spark streams them through
mapInArrow with no shuffle; each Python worker keeps the pre-tokens it has encoded lately, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from showbill.llm.common import kept, slices

#: The pre-token pattern that belongs to the vocabulary.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A word with the space before it, or white space; no pre-token crosses the ends of these. The class is Unicode's White_Space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
#: Letters with the space before them, and the ASCII signs after them but apostrophes: two pre-tokens. The letters are those of Unicode's first blocks.
PLAIN = r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)"
#: Two ids share one integer. So do a pair's rank and its place, so that the smaller number is the smaller rank and, of equal ranks, the pair farther left: the least one says where it is.
ID_BITS = 20
PLACE_BITS = 32
PLACE = (1 << PLACE_BITS) - 1
NO_PAIR = 1 << (PLACE_BITS + ID_BITS)
#: The same for trees side by side, in 32 bits: pre-tokens of up to 2^LEVELS - 2 bytes, LEAVES leaves at a time; for fewer than FEW of a width, arrays don't pay. NO_ID is no id.
LEVELS = 8
LEAVES = 1 << 18
FEW = 32
NO_LEAF = 1 << (ID_BITS + LEVELS)
NO_ID = (1 << ID_BITS) - 1
#: Characters of texts that are cut, and ids that are spelled out, at a time.
CHARACTERS = 1 << 20
IDS = 1 << 20


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class Pairs:
    """Ranks of pairs of ids by an open-addressing table in arrays: a pair lies in the first free slot from its own on."""

    BITS = 18

    def __init__(self, pairs: Sequence[int], ranks: Sequence[int]):
        keys, values = np.array(pairs, np.int64), np.array(ranks, np.int32) << LEVELS
        self.bits = max(self.BITS, (4 * len(keys)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NO_LEAF, np.int32)
        slot = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.ranks[taken] = keys[free[first]], values[free[first]]
            keys, values, slot = (np.delete(x, free[first]) for x in (keys, values, slot))
            slot = self.next(slot)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(64 - self.bits)).view(np.int64)

    def next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs, above the bits for places; NO_LEAF for pairs that don't merge."""
        keys = a.astype(np.int64) << ID_BITS | b
        slot = self.slot(keys)
        found = self.keys.take(slot)
        ranks = np.where(found == keys, self.ranks.take(slot), np.int32(NO_LEAF))
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            slot[left] = at = self.next(slot.take(left))
            found, sought = self.keys.take(at), keys.take(left)
            ranks[left] = np.where(found == sought, self.ranks.take(at), np.int32(NO_LEAF))
            left = left[(found != sought) & (found >= 0)]
        return ranks


class Codec:
    """Encodes and decodes with one vocabulary file in the tokenizers library's JSON format.

    The ids of short chunks and pre-tokens are remembered as packed 32-bit integers, in two generations of at most
    `remembered` entries each: where the young one is full it becomes the old one, so what is still in use stays. At 200
    bytes an entry, this is at most 60 MB a worker.
    """

    def __init__(self, path: str, remembered: int = 150_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        of_letter = {c: b for b, c in enumerate(letters)}
        self.byte_id = [vocab[c] for c in letters]
        self.merges, self.made = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << ID_BITS | vocab[b]] = rank << PLACE_BITS
            self.made.append(vocab[a + b])
        self.pairs = Pairs(list(self.merges), [r >> PLACE_BITS for r in self.merges.values()])
        self.byte_ids, self.made_ids = np.array(self.byte_id, np.int32), np.array(self.made, np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bytes_of = {i: bytes(of_letter[c] for c in word) for word, i in vocab.items()}
        bytes_of |= {i: s.encode() for s, i in self.special.items()}
        words = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.length = np.array(list(map(len, words)))
        self.start = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.digits = np.array([f"{i},".encode() for i in range(len(words))], "S8").view(np.int64)
        self.known = {"": b""} | {s: np.int32(i).tobytes() for s, i in self.special.items()}
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.chunks, self.pieces = re.compile(CHUNK), regex.compile(PRETOKEN)
        self.plain, self.double = re.compile(PLAIN), re.compile(f"[{_WHITE}]{{2}}|\0")
        self.remembered = remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token. low is a segment tree of minima over the adjacent pairs; its root is the next merge. Leaves that stay as they are climb nowhere."""
        ids = list(map(self.byte_id.__getitem__, piece))
        n, pair, made = len(ids), self.merges.get, self.made
        if n < 2:
            return ids
        width = 1 << (n - 2).bit_length()
        low = [NO_PAIR] * (2 * width)
        at, a = width, ids[0]
        for b in ids[1:]:
            if (rank := pair(a << ID_BITS | b)) is not None:
                low[at] = rank + at
            at, a = at + 1, b
        for i in range(width - 1, 0, -1):
            a, b = low[2 * i], low[2 * i + 1]
            low[i] = a if a <= b else b

        def put(at: int, a: int):
            low[at] = a
            while at > 1:
                b = low[at ^ 1]
                at >>= 1
                if b < a:
                    a = b
                if low[at] == a:
                    break
                low[at] = a

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := low[1]) < NO_PAIR:
            at = least & PLACE
            i = at - width
            j = after[i]
            ids[i] = one = made[least >> PLACE_BITS]
            ids[j] = -1
            after[i] = k = after[j]
            found = NO_PAIR
            if k < n:
                before[k] = i
                if low[width + j] != NO_PAIR:
                    put(width + j, NO_PAIR)
                if (rank := pair(one << ID_BITS | ids[k])) is not None:
                    found = rank + at
            put(at, found)
            if (h := before[i]) >= 0:
                rank = pair(ids[h] << ID_BITS | one)
                found = NO_PAIR if rank is None else rank + width + h
                if low[width + h] != found:
                    put(width + h, found)
        return [i for i in ids if i >= 0]

    def merge_many(self, pieces: list[bytes], levels: int) -> list[bytes]:
        """The ids of pre-tokens of up to 2^levels - 2 bytes, packed. A tree has 2^levels leaves and lies beside the next one in each level's array; what stands before and after a pre-token merges with nothing."""
        width = 1 << levels
        column = np.arange(width, dtype=np.int32)
        raw = np.frombuffer(b"".join([b"\0" + p.ljust(width - 1, b"\0") for p in pieces]), np.uint8)
        ids = self.byte_ids.take(raw).reshape(-1, width)
        ids[(column < 1) | (column > np.fromiter(map(len, pieces), np.int64, len(pieces))[:, None])] = NO_ID
        ids = ids.ravel()
        low = [np.append(self.pairs.get(ids[:-1], ids[1:]), np.int32(NO_LEAF)) | np.tile(column, len(pieces))]
        for _ in range(levels):
            low.append(np.minimum(low[-1][::2], low[-1][1::2]))
        after, before, tree = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1), np.arange(len(pieces))
        while len(tree):
            least = low[levels].take(tree)
            open_ = np.flatnonzero(least < NO_LEAF)
            tree, least = tree.take(open_), least.take(open_)
            at, one = (tree << levels) + (least & (width - 1)), self.made_ids.take(least >> LEVELS)
            j, h = after.take(at), before.take(at)
            k = after.take(j)
            ids[at], ids[j] = one, NO_ID
            after[at], before[k] = k, at
            leaf = np.concatenate([at, h])
            low[0][j] = NO_LEAF
            low[0][leaf] = self.pairs.get(np.concatenate([one, ids.take(h)]), np.concatenate([ids.take(k), one])) | (leaf & (width - 1))
            node = np.concatenate([leaf, j])
            for below, above in zip(low, low[1:]):
                right, node = node | 1, node >> 1
                above[node] = np.minimum(below.take(right - 1), below.take(right))
        left = ids.reshape(-1, width) != NO_ID
        ends = np.cumsum(left.sum(1) * 4).tolist()
        packed = ids[left.ravel()].tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, packed."""
        sized: dict[int, list[int]] = defaultdict(list)
        for i, piece in enumerate(pieces):
            sized[(len(piece) + 1).bit_length()].append(i)
        packed = [b""] * len(pieces)
        for levels, those in sized.items():
            if levels > LEVELS or len(those) < FEW:
                for i in those:
                    packed[i] = np.array(self.merge(pieces[i]), np.int32).tobytes()
                continue
            for n in range(0, len(those), LEAVES >> levels):
                some = those[n : n + (LEAVES >> levels)]
                for i, ids in zip(some, self.merge_many([pieces[i] for i in some], levels)):
                    packed[i] = ids
        return packed

    def keep(self, parts: dict[str, bytes]):
        """Remembers the ids of short parts."""
        short = iter([x for x in parts.items() if len(x[0]) <= 64])
        while some := dict(islice(short, self.remembered - len(self.young))):
            self.young.update(some)
            if len(self.young) >= self.remembered:
                self.old, self.young = self.young, {}

    def recall(self, parts: Iterable[str]) -> tuple[dict[str, bytes], list[str]]:
        """The ids of parts that are remembered, and the parts that aren't."""
        found = {p: self.young.get(p) for p in parts}
        missing = [p for p, ids in found.items() if ids is None]
        again = {p: ids for p in missing if (ids := self.old.get(p)) is not None}
        self.keep(again)
        found.update(again)
        return found, [p for p in missing if p not in again]

    def pieces_of(self, chunk: str) -> Sequence[str]:
        """The pre-tokens of a chunk."""
        if plain := self.plain.fullmatch(chunk):
            return plain.groups() if plain[2] else (chunk,)
        return self.pieces.findall(chunk)

    def chunks_of(self, text: str) -> list[str]:
        """The chunks of a text without special tokens. Where no white space stands beside other, a chunk begins at each space, and a line's end is one."""
        if self.double.search(text):
            return self.chunks.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def parts(self, text: str) -> list[str]:
        """The chunks and special tokens of a text."""
        found, at = [], 0
        for special in self.split_special.finditer(text) if any(s in text for s in self.special) else ():
            found += [*self.chunks_of(text[at : special.start()]), special.group()]
            at = special.end()
        return found + self.chunks_of(text[at:])

    def packed(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, as packed 32-bit integers. What isn't remembered is merged together."""
        cut = [self.parts(t) for t in texts]
        known, new = self.recall(set().union(*cut) - self.known.keys())
        words, longer = [], {}
        for chunk in new:
            pieces = self.pieces_of(chunk)
            if len(pieces) == 1:
                words.append(chunk)
            else:
                longer[chunk] = pieces
        more = {p for pieces in longer.values() for p in pieces}
        fresh, unknown = self.recall(more.difference(words))
        unknown += words
        merged = dict(zip(unknown, self.merge_all([p.encode() for p in unknown])))
        fresh |= merged
        merged |= {chunk: b"".join(map(fresh.__getitem__, pieces)) for chunk, pieces in longer.items()}
        self.keep(merged)
        known |= self.known | merged
        return [b"".join(map(known.__getitem__, parts)) for parts in cut]

    def encode_all(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, of few texts at a time."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > CHARACTERS:
                yield from (np.frombuffer(ids, np.int32) for ids in self.packed(some))
                some, size = [], 0
            some.append(text)
            size += len(text)
        yield from (np.frombuffer(ids, np.int32) for ids in self.packed(some))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers, joined by commas."""
        return b"".join([self.digits.take(ids[i : i + IDS]).tobytes().translate(None, b"\0") for i in range(0, len(ids), IDS)])[:-1]

    def decode_bytes(self, ids: Sequence[int]) -> bytes:
        ids, found = np.asarray(ids, np.int32).view(np.uint32), []
        for i in range(0, len(ids), IDS):
            some = ids[i : i + IDS]
            length = self.length[some]
            found.append(self.letters.take(np.repeat(self.start[some] - np.cumsum(length) + length, length) + np.arange(length.sum())).tobytes())
        return b"".join(found)

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


def codec(path: str) -> Codec:
    """The worker's codec for a vocabulary, kept between tasks."""
    return kept(("codec", path), lambda: Codec(path))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of each whole text. Null and empty texts have no ids; rows may repeat; extra columns are dropped."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(own.encode_all(_texts(b))), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of encoded rows; ids that are null decode to null, invalid UTF-8 to replacement characters."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in slices(batches):
            texts = [None if ids is None else own.decode(ids) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, of an encoding and its decoding.

    A null or empty text has no tokens and the digests of the empty string. Special tokens that occur in a text are
    recognised, as the tokenizers library does by default. Repeated rows give repeated results.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in slices(batches):
            count, ids_sha, text_sha = [], [], []
            for ids in own.encode_all(_texts(b)):
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(own.decimal(ids)).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
