"""Language identification by unigrams over pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public byte vocabulary. A word's probability is the sum,
over all ways to cut it into pieces, of the product of their probabilities, which a forward pass computes; a text's is
the product over its words. Words are as long as they are, and all sums are taken in logarithms; many words go through
the pass together, place by place. Training runs on a bounded sample of rows per language: its distinct words are counted by
Spark, and expectation-maximisation spreads each word's count over its segmentations, in tasks by word. The model has
one row per piece and language at most, so its size is fixed by the vocabulary; every document is then scored in one
pass without a shuffle.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import kept, settle, slices

LETTER = re.compile(r"[^\W\d_]")
#: Bytes of words that go through one forward pass together; a longer word is a pass of its own.
TOGETHER = 400_000


class Pieces:
    """The fixed vocabulary as a trie over bytes, in arrays: the pieces at every place of many words are found together."""

    def __init__(self, path: str | None = None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        with open(path, "rb") as f:
            pieces = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(pieces.values(), default=-1) + 1
        node, arcs, piece_at = {b"": 0}, {}, {}
        for word, number in sorted(pieces.items()):
            for i in range(1, len(word) + 1):
                if word[:i] not in node:
                    node[word[:i]] = len(node)
                    arcs[node[word[: i - 1]] << 8 | word[i - 1]] = node[word[:i]]
            piece_at[node[word]] = number
        keys = np.array(sorted(arcs), np.int64)
        self.piece = np.full(len(node), -1, np.int32)
        self.piece[list(piece_at)] = list(piece_at.values())
        # Arcs in an open hash table of twice their number at least; a place that is free holds -1.
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys, self.ends = np.full((1 << self.bits) + 64, -1, np.int64), np.zeros((1 << self.bits) + 64, np.int32)
        for key in keys.tolist():
            at = self.place(np.array([key]))[0]
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.ends[at] = key, arcs[key]
        self.probes = 1
        at = self.place(keys)
        while (self.keys[at] != keys).any():
            at += self.keys[at] != keys
            self.probes += 1

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The node that each node's arc for a symbol leads to; -1 where there is none."""
        keys = nodes.astype(np.int64) << 8 | symbols
        at = self.place(keys)
        found = np.where(self.keys[at] == keys, self.ends[at], -1)
        missing = np.flatnonzero((found < 0) & (self.keys[at] >= 0))
        for probe in range(1, self.probes):
            if not len(missing):
                break
            key = self.keys[at[missing] + probe]
            hit = key == keys[missing]
            found[missing[hit]] = self.ends[at[missing[hit]] + probe]
            missing = missing[~hit & (key >= 0)]
        return found

    def cuts(self, words: list[bytes]) -> Cuts:
        """Every piece at every place of the words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        left = np.repeat(starts + lengths, lengths) - np.arange(len(symbols))
        at, nodes = np.arange(len(symbols)), np.zeros(len(symbols), np.int32)
        found, long = [], 0
        while len(at):
            nodes = self.step(nodes, symbols[at + long])
            on = nodes >= 0
            at, nodes, long = at[on], nodes[on], long + 1
            number = self.piece[nodes]
            is_piece = number >= 0
            found.append((at[is_piece], np.full(int(is_piece.sum()), long), number[is_piece]))
            on = left[at] > long
            at, nodes = at[on], nodes[on]
        place, size, number = (np.concatenate([f[i] for f in found]) for i in range(3))
        owner = np.repeat(np.arange(len(words)), lengths)[place]
        return Cuts(lengths, owner, place - starts[owner], size, number)


@dataclass
class Cuts:
    """lengths: of the words in bytes; then for every piece found its word, where it begins there, its length and its number."""

    lengths: np.ndarray
    owner: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    piece: np.ndarray

    def forward(self, logs: np.ndarray, backward: bool = False, chances: np.ndarray | None = None) -> np.ndarray:
        """The logarithm of the sum over all segmentations of each beginning of each word (or end, if backward).

        logs: one row per piece of the vocabulary, one column per language; chances: their exponentials, if at hand. The
        result has a row for each of a word's length + 1 places, word after word.
        """
        firsts = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        sums = np.full((int((self.lengths + 1).sum()), logs.shape[1]), -np.inf)
        begin, end = self.begin, self.begin + self.size
        if backward:
            begin, end = self.lengths[self.owner] - end, self.lengths[self.owner] - begin
        sums[firsts] = 0.0
        # Pieces by where they begin, then by length, as they were found: those of one length that begin at one distance
        # add to different places.
        longest = int(self.lengths.max(initial=0))
        order = np.argsort(begin.astype(np.uint16) if longest < 1 << 16 else begin, kind="stable")
        begin, owner = begin[order], firsts[self.owner[order]]
        step = begin * (int(self.size.max(initial=0)) + 1) + self.size[order]
        edges = np.flatnonzero(np.concatenate([[True], np.diff(step) != 0, [True]])) if len(step) else []
        source, target, piece = owner + begin, owner + end[order], self.piece[order]
        if len(piece) and longest * logs.min() > -650:  # no product of pieces leaves the range of a double
            sums = np.exp(sums)
            chances = np.exp(logs) if chances is None else chances
            for a, b in zip(edges[:-1], edges[1:]):
                sums[target[a:b]] += sums[source[a:b]] * chances[piece[a:b]]
            with np.errstate(divide="ignore"):
                return np.log(sums)
        for a, b in zip(edges[:-1], edges[1:]):
            to = target[a:b]
            sums[to] = np.logaddexp(sums[to], sums[source[a:b]] + logs[piece[a:b]])
        return sums


_pieces: dict[str | None, Pieces] = {}


def shared_pieces(path: str | None) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def words_of(text: str) -> list[bytes]:
    """The text's words, each after a space."""
    return [b" " + w for w in text.encode("utf-8", "surrogatepass").split()]


def groups(words: list[bytes]) -> Iterator[list[int]]:
    """Places of words of like length, with at most TOGETHER bytes in sum."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    sums, at = np.cumsum(lengths[order]), 0
    while at < len(order):
        before = sums[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sums, before + TOGETHER, "right")))
        yield order[at:end].tolist()
        at = end


@dataclass
class Model:
    langs: list[str]
    #: Log-probabilities: one row per piece, one column per language.
    logs: np.ndarray


def sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """lang and text of about per_lang rows of each language, chosen by a hash of doc_id and text length; all rows of smaller languages."""
    known = docs.where("lang is not null and text is not null")
    rates = known.groupBy("lang").count().select("lang", F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("count")).alias("_rate"))
    point = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.select("lang", "text", point.alias("_point")).join(rates, "lang").where("_point < _rate").select("lang", "text")


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word and n over lang and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            tally: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                tally.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, w, n) for lang, c in tally.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])

    return texts.mapInArrow(run, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected(words: list[bytes], times: np.ndarray, pieces: Pieces, logs: np.ndarray | None) -> np.ndarray:
    """How often each piece is expected in the words, over all segmentations; without logs, how often it is found at all."""
    use = np.zeros(pieces.size)
    for at in groups(words):
        cuts = pieces.cuts([words[i] for i in at])
        weight = times[at][cuts.owner]
        if logs is not None:
            own, chances = logs[cuts.piece], np.exp(logs)[:, None]
            ahead, back = (cuts.forward(logs[:, None], turned, chances)[:, 0] for turned in (False, True))
            firsts = np.cumsum(cuts.lengths + 1) - (cuts.lengths + 1)
            whole, left = ahead[firsts + cuts.lengths], cuts.lengths[cuts.owner] - cuts.begin - cuts.size
            with np.errstate(invalid="ignore"):
                share = np.exp(ahead[firsts[cuts.owner] + cuts.begin] + own + back[firsts[cuts.owner] + left] - whole[cuts.owner])
            weight = weight * np.nan_to_num(share)
        use += np.bincount(cuts.piece, weight, pieces.size)
    return use


def _expectations(model: Broadcast | None, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path)
        use: dict[str, np.ndarray] = {}
        for b in batches:
            langs, words, times = np.array(b.column("lang").to_pylist(), object), b.column("word").to_pylist(), b.column("n").to_numpy().astype(float)
            for lang in dict.fromkeys(langs.tolist()):
                on = np.flatnonzero(langs == lang)
                logs = model.value.logs[:, model.value.langs.index(lang)] if model else None
                use[lang] = use.get(lang, 0) + expected([words[i] for i in on], times[on], pieces, logs)
        for lang, n in use.items():
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(n[found])], ["lang", "piece", "n"])

    return run


def learn(docs: DataFrame, per_lang: int = 4_000, rounds: int = 2, path: str | None = None, smooth: float = 0.01) -> Model:
    """Piece probabilities per language from about per_lang rows of each. Rows without lang or text teach nothing; without rows the model has no language."""
    words = settle(word_counts(sample(docs, per_lang)))
    size, model = shared_pieces(path).size, None
    for _ in range(rounds + 1):
        shared = docs.sparkSession.sparkContext.broadcast(model) if model else None
        found = words.mapInArrow(_expectations(shared, path), "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        langs = sorted(set(found["lang"].to_pylist()))
        use = np.full((size, len(langs)), smooth)
        place = {lang: k for k, lang in enumerate(langs)}
        column = np.fromiter(map(place.__getitem__, found["lang"].to_pylist()), np.int64, found.num_rows)
        use[found["piece"].to_numpy(), column] += found["n"].to_numpy()
        model = Model(langs, np.log(use / use.sum(0, keepdims=True)) if langs else use)
    return model


class Scorer:
    """Log-probabilities of texts; those of words of at most 64 bytes are remembered, in two generations of up to `most` words."""

    def __init__(self, model: Model, path: str | None, most: int = 200_000):
        self.pieces, self.model, self.most = shared_pieces(path), model, most
        # Places below `most` are the younger generation's, or from there on; the older one's are the other half.
        self.place: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.logs, self.half = np.zeros((2 * most, len(model.langs))), 0
        self.chances = np.exp(model.logs)

    def log_words(self, words: list[bytes]) -> np.ndarray:
        """The logarithm of each word's sum over all its segmentations (rows), under each language (columns)."""
        out = np.empty((len(words), len(self.model.langs)))
        for at in groups(words):
            cuts = self.pieces.cuts([words[i] for i in at])
            out[at] = cuts.forward(self.model.logs, chances=self.chances)[np.cumsum(cuts.lengths + 1) - 1]
        return out

    def logs_of(self, texts: list[str]) -> np.ndarray:
        """The log-probability of each text (rows) under each language (columns)."""
        words, owner = [], []
        for i, text in enumerate(texts):
            found = Counter(words_of(text))
            words += found.items()
            owner += [i] * len(found)
        total = np.zeros((len(texts), len(self.model.langs)))
        for at in range(0, len(words), 100_000):
            part = [w for w, _ in words[at : at + 100_000]]
            known = np.fromiter(map(self.place.get, part, repeat(-1)), np.int64, len(part))
            missing = np.flatnonzero(known < 0)
            unknown = [part[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            once = np.fromiter(map(self.older.get, new, repeat(-1)), np.int64, len(new))
            values, unseen = self.logs[once], np.flatnonzero(once < 0)
            values[unseen] = self.log_words([new[i] for i in unseen.tolist()])
            extra = dict(zip(new, range(len(new))))
            logs = self.logs[known]
            logs[missing] = values[np.fromiter(map(extra.__getitem__, unknown), np.int64, len(unknown))]
            np.add.at(total, owner[at : at + 100_000], logs * np.fromiter((n for _, n in words[at : at + 100_000]), float, len(part))[:, None])
            short = [w for w in new if len(w) <= 64]
            if len(self.place) + len(short) > self.most:
                self.older, self.place, self.half = self.place, {}, self.most - self.half
            short = short[: self.most]
            at_first = self.half + len(self.place)
            self.logs[at_first : at_first + len(short)] = values[[extra[w] for w in short]] if short else 0
            self.place.update(zip(short, range(at_first, at_first + len(short))))
        return total


def predict(docs: DataFrame, model: Model, path: str | None = None) -> DataFrame:
    """doc_id, lang_pred and score (the predicted language's share of the posterior, languages alike before) of each row.

    Texts that are null or without a letter, and all texts where the model has no language, are `und` with score 0.
    Rows may repeat; extra columns are dropped.
    """

    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.langs
        own = kept(name, lambda: Scorer(shared.value, path))
        for b in slices(batches, 2_000):
            texts = b.column("text").to_pylist()
            told = [i for i, t in enumerate(texts) if t and known and LETTER.search(t)]
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            if told:
                logs = own.logs_of([texts[i] for i in told])
                best = logs.argmax(1)
                scores[told] = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                for i, k in zip(told, best.tolist(), strict=True):
                    langs[i] = known[k]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    model = learn(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
