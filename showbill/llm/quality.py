"""Quality rules: counts of each document, and its divergence from language references.

References are the histograms of character classes and of common words of each language, over all documents. A
document's own histograms are compared with each reference by the Jensen-Shannon distance (base 2, from 0 to 1), and
the nearest language counts; too short documents aren't judged by it. Two passes over the documents: the first sends
partial counts to a shuffle, the second needs only the references, whose size is the number of languages times the
number of classes and common words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showbill.llm.common import SPACE_BYTES, slices

SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """The class of each byte of UTF-8: 26 lower-case letters, then upper case, digits, space, sentence marks, symbols, other ASCII, non-ASCII characters (by first byte); -1 for their later bytes."""
    of = np.full(256, 31, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            of[b] = 32 if b >= 0xC0 else -1
        elif c.islower():
            of[b] = b - ord("a")
        elif c.isupper():
            of[b] = 26
        elif c.isdigit():
            of[b] = 27
        elif b in SPACE_BYTES:
            of[b] = 28
        elif c in ".,;:!?'\"()-":
            of[b] = 29
        elif b in SYMBOLS:
            of[b] = 30
    return of + 1


CLASS_OF = _classes()
CLASSES = 33


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=CLASSES + 1)[1:]


def base_counts(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text, its UTF-8 bytes and its words."""
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACE_BYTES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line.strip(SPACE_BYTES):
            dup += line in seen
            seen.add(line)
    return len(words), chars, symbols, dup, repeated(words)


def repeated(words: list[bytes], wide: int = 5) -> int:
    """How many words lie in windows of `wide` words that are found twice or more."""
    n = len(words) - wide + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    acc = np.zeros(n, np.uint64)
    for i in range(wide):
        acc = (acc ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    order = np.argsort(acc, kind="stable")
    s = acc[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.add.at(edge, at + wide, -1)
    return int((np.cumsum(edge) > 0).sum())


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if either is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda a: float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum())
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


@dataclass
class References:
    """Per language: the histogram of character classes, and the common words with their histogram; its last bin is all other words."""

    classes: dict[str, np.ndarray]
    words: dict[str, dict[bytes, int]]
    shares: dict[str, np.ndarray]


def count_partials(docs: DataFrame, flush: int = 200_000) -> DataFrame:
    """lang, kind ("class", "word" or "total"), item and n: partial counts; a task's memory holds `flush` counts at most, and one text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(tally)
            b = pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], t) for i, t in ((0, pa.string()), (1, pa.string()), (2, pa.binary()))] + [pa.array([tally[k] for k in keys], pa.int64())], ["lang", "kind", "item", "n"])
            tally.clear()
            return b

        for b in slices(batches):
            per: dict[str, tuple[Counter, np.ndarray]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                if lang is None or not text:
                    continue
                words, classes = per.setdefault(lang, (Counter(), np.zeros(CLASSES, np.int64)))
                raw = text.encode("utf-8", "surrogatepass")
                words.update(raw.lower().split())
                classes += class_counts(raw)
                if len(words) > flush:
                    tally[lang, "total", b""] += words.total()
                    tally.update({(lang, "word", w): n for w, n in words.items()})
                    words.clear()
                    yield out()
            for lang, (words, classes) in per.items():
                tally[lang, "total", b""] += words.total()
                tally.update({(lang, "word", w): n for w, n in words.items()})
                tally.update({(lang, "class", bytes([i])): int(n) for i, n in enumerate(classes) if n})
            if len(tally) > flush:
                yield out()
        yield out()

    return docs.select("lang", "text").mapInArrow(run, "lang string, kind string, item binary, n bigint")


def learn(docs: DataFrame, common: int = 50, least_words: int = 2_000) -> References:
    """References of all languages with at least least_words words in docs. Rows with a null lang or text aren't counted."""
    counts = count_partials(docs).groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    # Two-step choice of the commonest words: per group of a word's hash first, so that no task ranks a language alone.
    parts = Window.partitionBy("lang", "kind", F.pmod(F.xxhash64("item"), F.lit(32))).orderBy(F.desc("n"), "item")
    whole = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    top = counts.withColumn("_r", F.row_number().over(parts)).where(F.col("_r") <= common).withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= common)
    found: dict[str, dict[str, dict[bytes, int]]] = {}
    for r in top.collect():
        found.setdefault(r["lang"], {}).setdefault(r["kind"], {})[bytes(r["item"])] = r["n"]
    refs = References({}, {}, {})
    for lang, kinds in sorted(found.items()):
        total = kinds["total"][b""]
        if total < least_words:
            continue
        words = dict(sorted(kinds.get("word", {}).items(), key=lambda x: (-x[1], x[0])))
        refs.classes[lang] = np.array([kinds["class"].get(bytes([i]), 0) for i in range(CLASSES)], float)
        refs.words[lang] = {w: i for i, w in enumerate(words)}
        refs.shares[lang] = np.array([*words.values(), total - sum(words.values())], float)
    return refs


def nearest(raw: bytes, words: list[bytes], refs: References) -> tuple[float | None, float | None]:
    """The distances of a text's classes and words from the references, each the least over languages; null without references."""
    if not refs.classes:
        return None, None
    own = class_counts(raw).astype(float)
    by_class = min(distance(own, q) for q in refs.classes.values())
    tally, by_word = Counter(raw.lower().split()), 1.0
    for lang, place in refs.words.items():
        p = np.zeros(len(place) + 1)
        for w in place.keys() & tally.keys():
            p[place[w]] = tally[w]
        p[-1] = len(words) - p.sum()
        by_word = min(by_word, distance(p, refs.shares[lang]))
    return by_class, by_word


def assess(docs: DataFrame, refs: References, class_most: float = 0.345, word_most: float = 0.47, class_least: int = 200, word_least: int = 50) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, the two distances (null if not judged) and kept.

    A document is dropped if it fails the base rules, or if it has at least class_least letters and other characters in
    words and its class distance is over class_most, or at least word_least words and its word distance is over
    word_most. A document whose lang has no reference isn't judged by other languages. A null text has no words and fails the base rules. Rows may repeat; extra columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                text = text or ""
                raw = text.encode("utf-8", "surrogatepass")
                words = raw.split()
                counts = base_counts(text, raw, words)
                failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
                by_class = by_word = None
                if (lang is None or lang in refs.classes) and (counts[1] >= class_least or counts[0] >= word_least):
                    by_class, by_word = nearest(raw, words, refs)
                    by_class = by_class if counts[1] >= class_least else None
                    by_word = by_word if counts[0] >= word_least else None
                far = (by_class is not None and by_class > class_most) or (by_word is not None and by_word > word_most)
                rows.append((*counts, failed, not failed and not far, by_class, by_word))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], NAMES)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t in zip(NAMES[1:], ["bigint"] * 5 + ["boolean"] * 2 + ["double"] * 2, strict=True)))


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]


def report(docs: DataFrame) -> DataFrame:
    return assess(docs, learn(docs))
