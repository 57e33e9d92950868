"""Language-model scores by prediction by partial matching over bytes.

A byte-context trie is trained on the words of the training documents: contexts are the whole beginning of a word
(counted by tokens) and, below it, the last 4 to 0 bytes (counted once per distinct word, since they speak for words
that were not seen). A byte is predicted from its longest known context; the probability to escape to the next shorter
one is estimated from how often a symbol of such a context (same order and size) was seen once only, and symbols that
the longer context could have predicted are excluded from the shorter. Under one trie, a text's code length is the sum
over its words, each spelled out with an end mark, and over the end of the text.

Every large part of the training documents (`lang` names the parts) has contexts of its own, and a text's probability is
the mixture of those under the parts, weighed by their numbers of documents. That is the adaptive side: word by word,
the mixture turns to the part that has told the text best so far. Only the text is read when it is scored.

Every distinct word is counted and spelled out once, in tables that stay distributed; a document's words meet their
values in a shuffle join. The trie keeps every entry and stays distributed too: words are spelled in buckets of
neighbours, each with the contexts that it needs (`spelled`). The values of the commonest words, whose join would be
skewed, go to every task. Contexts are named by 64-bit
codes: short ones by their bytes, whole beginnings by a hash.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from showbill.llm.common import kept, settle, slices

#: After a word's last byte, and instead of a word; neither byte can occur in a word. The end mark is also the end token.
STOP, END = b"\x20", b"\x0a"
SHORT = 4
LONGEST = 24
#: Escapes from whole beginnings are estimated by their length, up to this.
DEEPEST = 16
CLASSES = 30

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
WHOLE = np.uint64(1 << 63)
#: Where a part's number is in the codes.
PART_BIT = 44


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, parts: int, flush: int = 300_000) -> DataFrame:
    """word, n and by_part (an array) of every word of docs (text, part): n counts the rows whose part isn't null, and is 0 for words of others only.

    The end token is the word of one line feed. A task holds `flush` counts and one text's at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[int | None, Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(w, k, n) for k, words in tally.items() for w, n in words.items()]
            b = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.int64()))], ["word", "part", "n"])
            tally.clear()
            return b

        for b in slices(batches):
            for text, part in zip(b.column("text").to_pylist(), b.column("part").to_pylist(), strict=True):
                words = words_of(text)
                own = tally.setdefault(part, Counter())
                if part is not None:
                    own.update(words)
                    own[END] += 1
                else:
                    own.update(dict.fromkeys([*words, END], 0))
                if sum(map(len, tally.values())) > flush:
                    yield out()
        yield out()

    of_part = [F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(0)) for k in range(parts)]
    return docs.select("text", "part").mapInArrow(run, "word binary, part int, n bigint").groupBy("word").agg(F.sum("n").alias("n"), F.array(*of_part).alias("by_part"))


@dataclass
class Spots:
    """The bytes of many words, each word followed by its end mark, with the code of every context; 0 where there is none."""

    symbol: np.ndarray
    depth: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    #: Codes of the whole beginning (if at most LONGEST bytes), then of the last SHORT to 0 bytes.
    codes: list[np.ndarray]

    def of(self, part: int) -> list[np.ndarray]:
        """The codes of the contexts of one part of the training documents."""
        return [np.where(c == 0, c, c ^ np.uint64(part << PART_BIT)) for c in self.codes] if part else self.codes

    def shorter(self, level: int) -> np.ndarray:
        """The codes of the contexts that an escape from `codes[level]` leads to."""
        if level > 0:
            return self.codes[level + 1] if level <= SHORT else np.zeros_like(self.symbol)
        tail = self.codes[1]
        for code in self.codes[2:]:
            tail = np.where(tail == 0, code, tail)
        return tail


def spots(words: list[bytes]) -> Spots:
    parts = [w if w == END else w + STOP for w in words]
    symbol = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths) - lengths
    depth = np.arange(len(symbol)) - np.repeat(starts, lengths)
    whole = np.zeros(len(symbol), np.uint64)
    at, left, h = starts, lengths, np.full(len(starts), M1)
    whole[at] = h | WHOLE
    for d in range(1, LONGEST + 1):
        on = left > d
        at, left, h = at[on], left[on], h[on]
        h = mixed((h + symbol[at + d - 1] + np.uint64(1)) * M1)
        whole[at + d] = h | WHOLE
    short, packed = [], np.zeros(len(symbol), np.uint64)
    for k in range(SHORT + 1):
        short.append(np.where(depth >= k, np.uint64((k + 1) << 40) | packed, np.uint64(0)))
        before = np.concatenate([np.zeros(k + 1, np.uint64), symbol])[: len(symbol)]
        packed = packed | before << np.uint64(8 * k)
    return Spots(symbol, depth, starts, lengths, [whole, *short[::-1]])


def entry_key(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mixed(context + (symbol + np.uint64(1)) * M1)


def tallied(words: list[bytes], times: list[int], part: int, levels: int = SHORT + 2) -> Iterator[pa.RecordBatch]:
    """The trie entries of words under one part; levels: 1 for whole beginnings only."""
    s = spots(words)
    s.codes = s.of(part)
    token = np.repeat(np.array(times, np.int64), s.lengths)
    for level, code in enumerate(s.codes[:levels]):
        at = np.flatnonzero(code)
        key = entry_key(code[at], s.symbol[at])
        by_key = np.argsort(key)
        first = np.flatnonzero(np.concatenate([[True], np.diff(key[by_key]) != 0])) if len(at) else np.empty(0, np.int64)
        one = at[by_key[first]]
        n = np.add.reduceat(token[at][by_key], first) if level == 0 and len(at) else np.diff(np.append(first, len(at)))
        order = SHORT + np.minimum(DEEPEST, s.depth[one] + 1) if level == 0 else np.full(len(one), SHORT + 1 - level)
        columns = code[one].view(np.int64), s.shorter(level)[one].view(np.int64), (order * 256 + s.symbol[one].astype(np.int64)).astype(np.int32), n
        for start in range(0, len(one), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 200_000]) for c in columns], ["context", "tail", "spot", "n"])


def trie_counts(counts: DataFrame, flush: int = 100_000) -> DataFrame:
    """context, tail (the context that an escape leads to), spot (256 * order + symbol) and n. Whole beginnings have negative codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[bytes], list[int]]] = {}
        for b in batches:
            for word, by_part in zip(b.column("word").to_pylist(), b.column("by_part").to_pylist(), strict=True):
                for part, n in enumerate(by_part):
                    if n:
                        words, times = held.setdefault(part, ([], []))
                        words.append(word)
                        times.append(n)
            for part in [k for k, v in held.items() if len(v[0]) >= flush]:
                yield from tallied(*held.pop(part), part)
        for part, (words, times) in held.items():
            yield from tallied(words, times, part)

    return counts.mapInArrow(run, "context bigint, tail bigint, spot int, n bigint").groupBy("context", "tail", "spot").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    #: context, tail, spot, n: every entry, distributed
    trie: DataFrame | None
    #: By order and size class, the probability of an escape; for whole beginnings the order is SHORT and their length.
    escapes: np.ndarray
    tokens: int
    distinct: int
    #: The weight of each part of the training documents.
    weights: list[float]
    #: So many entries of short contexts go to every task, which saves their join.
    hot: int

    @property
    def entries(self) -> pa.Table:
        """The whole trie on the driver, for small models."""
        return self.trie.toArrow()


def size_class(n: np.ndarray) -> np.ndarray:
    """Sizes to 8 are classes of their own, then powers of two."""
    return np.where(n <= 8, n, 5 + np.minimum(np.frexp(n)[1], 24)).astype(np.int64)


def commonest(counted: DataFrame, most: int) -> pa.Table:
    """The rows whose n is at least the smallest one (on a logarithmic grid) that at most `most` rows reach."""
    level = F.floor(F.log("n") * 50)
    bar, total = None, 0
    for r in sorted(counted.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        bar = r["level"]
    return counted.where(level >= bar if bar is not None else F.lit(False)).toArrow()


def learn(counts: DataFrame, weights: list[float], capacity: int = 1_600_000) -> Model:
    """The model of word counts (a settled frame of word, n and by_part; words with n = 0 teach nothing) and of the parts' weights.

    The trie keeps every entry and stays distributed. capacity: a quarter of it bounds the entries of short contexts that
    go to every task; it moves no score.
    """
    counts = counts.where("n > 0")
    sums = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    trie = settle(trie_counts(counts))
    context = trie.groupBy("context", F.expr("int(spot div 256)").alias("order")).agg(F.sum("n").alias("size"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"))
    # Left out of its own context, a symbol seen once would have been an escape from a context that is smaller by one.
    rest = F.col("size") - 1
    size_of = F.when(rest <= 8, rest).otherwise(5 + F.least(F.lit(24), F.floor(F.log2(rest.cast("double"))) + 1)).cast("int")
    escapes = np.full((SHORT + DEEPEST + 1, CLASSES), 0.5)
    for r in context.where("size > 1").groupBy("order", size_of.alias("bits")).agg(F.sum("once").alias("once"), F.sum("size").alias("size")).collect():
        escapes[r["order"], r["bits"]] = min(0.95, max((r["once"] + 0.5) / (r["size"] + 1), 1e-7))
    return Model(trie, escapes, sums["tokens"] or 0, sums["distinct"], weights, capacity // 4)


def found(among: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each x in a sorted array, or -1."""
    if not len(among):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(among, x), len(among) - 1)
    return np.where(among[at] == x, at, -1)


class Speller:
    """log10 probabilities of words under a model."""

    def __init__(self, model: Model, entries: pa.Table | None = None):
        entries = model.entries if entries is None else entries
        context, tail, spot, n = (entries.column(c).to_numpy() for c in ("context", "tail", "spot", "n"))
        context, tail, symbol, n = context.astype(np.int64).view(np.uint64), tail.astype(np.int64).view(np.uint64), (spot & 255).astype(np.uint64), n.astype(float)
        key = entry_key(context, symbol)
        by_key = np.argsort(key)
        self.key, self.n = key[by_key], n[by_key]
        self.context, first, own = np.unique(context, return_index=True, return_inverse=True)
        self.size, self.kinds = np.bincount(own, n), np.bincount(own)
        self.parent = found(self.context, tail[first])
        # What a context's parent has left after an escape: its counts without the symbols that the context has.
        excluded = np.bincount(own, self.counts(tail, symbol))
        self.left = np.where(self.parent >= 0, self.size[self.parent] - excluded if len(first) else 0, 0)
        escape = model.escapes[(spot[first] >> 8).astype(np.int64), size_class(self.size)]
        self.escape, self.stay = np.log10(escape), np.log10(1 - escape)

    def counts(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = found(self.key, entry_key(context, symbol))
        return np.where(at >= 0, self.n[at] if len(self.n) else 0.0, 0.0)

    def spell(self, words: list[bytes], parts: int) -> np.ndarray:
        """The log10 probability of each word (rows) under each part (columns)."""
        if not words:
            return np.empty((0, parts))
        s = spots(words)
        # Where no whole beginning is known, a byte depends on the few before it alone: such values are found once.
        key = s.shorter(0) << np.uint64(8) | s.symbol
        _, one, again = np.unique(key, return_index=True, return_inverse=True)
        return np.stack([np.add.reduceat(self.values(s, k, one, again), s.starts) for k in range(parts)], 1)

    def values(self, s: Spots, part: int, one: np.ndarray, again: np.ndarray) -> np.ndarray:
        """The log10 probability of each byte. one: a byte of each kind of short context and symbol; again: each byte's kind."""
        codes = s.of(part)
        total = self.descend([c[one] for c in codes[1:]], s.symbol[one], np.full(len(one), -1))[again]
        place = found(self.context, codes[0])
        at = np.flatnonzero(place >= 0)
        c = place[at]
        n = self.counts(codes[0][at], s.symbol[at])
        hit = n > 0
        total[at[hit]] = self.stay[c[hit]] + np.log10(n[hit] / self.size[c[hit]])
        at, c = at[~hit], c[~hit]
        total[at] = self.escape[c] + self.descend([x[at] for x in codes[1:]], s.symbol[at], c)
        return total

    def descend(self, levels: list[np.ndarray], symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 probabilities of symbols under contexts of falling order. before: the longer context that was escaped from, or -1. All go down together."""
        total, before, active = np.zeros(len(symbol)), before.copy(), np.arange(len(symbol))
        for codes in levels if len(self.context) else ():
            place = found(self.context, codes[active])
            at, c = active[place >= 0], place[place >= 0]
            last = before[at]
            left = np.where((last >= 0) & (self.parent[last] == c), self.left[last], self.size[c])
            n = self.counts(codes[at], symbol[at])
            hit = (n > 0) & (left > 0)
            missed = ~hit & (left > 0)
            total[at[hit]] += self.stay[c[hit]] + np.log10(n[hit] / left[hit])
            total[at[missed]] += self.escape[c[missed]]
            before[at[~hit]] = c[~hit]
            done = np.zeros(len(active), bool)
            done[np.flatnonzero(place >= 0)[hit]] = True
            active = active[~done]
        if len(active):
            last = before[active]
            kinds = np.where(last >= 0, self.kinds[last], 0) if len(self.kinds) else np.zeros(len(active))
            total[active] -= np.log10(np.maximum(1, 256 - kinds))
        return total


def hot_contexts(short: DataFrame, most: int) -> DataFrame:
    """base (a short context, whatever the part) of the largest contexts, with at most `most` entries in sum.

    A context is never larger than its tail, so the tails of hot contexts are hot.
    """
    sizes = short.groupBy("base").agg(F.sum("n").alias("size"), F.count("*").alias("entries"))
    level = F.floor(F.log("size") * 50)
    sizes = settle(sizes.withColumn("level", level))
    bar, total = None, 0
    for r in sorted(sizes.groupBy("level").agg(F.sum("entries").alias("entries")).collect(), key=lambda r: -r["level"]):
        total += r["entries"]
        if total > most:
            break
        bar = r["level"]
    return sizes.where(F.col("level") >= bar if bar is not None else F.lit(False)).select("base")


def spelled(counts: DataFrame, model: Model, per: int = 20_000) -> DataFrame:
    """word, n and spelling (log10 probabilities under the parts: s0, s1, ...) of each word of counts.

    Words are dealt in their order into buckets of about `per`. So a bucket counts whole beginnings itself, but for the
    beginnings of the buckets' first words, which may go on before them: those are read from the trie. Short contexts
    meet the buckets that need them in a join; the hot ones go to every task.
    """
    spark, parts = counts.sparkSession, len(model.weights)
    buckets = -(-counts.count() // per)
    drawn = [bytes(r["word"]) for r in counts.select("word").sample(min(1.0, 30 / per), 7).collect()]
    drawn.sort()
    bounds = sorted({drawn[i * len(drawn) // buckets] for i in range(1, buckets)}) if drawn else []
    short = model.trie.where("context > 0").withColumn("base", F.col("context").bitwiseAND(F.lit((1 << PART_BIT) - 1)))
    hot = settle(hot_contexts(short, model.hot))
    hot_entries = short.join(F.broadcast(hot), "base").select("context", "tail", "spot", "n").toArrow()
    edge = spots(bounds) if bounds else None
    edges = np.unique(np.concatenate([edge.of(k)[0] for k in range(parts)])) if edge else np.empty(0, np.uint64)
    edges = edges[edges != 0].view(np.int64)
    edge_rows = spark.createDataFrame([(int(x),) for x in edges], "context bigint")
    edge_entries = model.trie.where("context < 0").join(F.broadcast(edge_rows), "context").select("context", "tail", "spot", "n").toArrow()
    light = replace(model, trie=None)
    shared = spark.sparkContext.broadcast((bounds, light, pa.concat_tables([hot_entries, edge_entries]), edges, np.sort(hot.toArrow().column("base").to_numpy())))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = shared.value[0]
        for b in batches:
            at = pa.array([bisect_right(ends, w) for w in b.column("word").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, at], ["word", "n", "by_part", "bucket"])

    def need(t: pa.Table) -> pa.Table:
        base = np.unique(np.concatenate(spots(t.column("word").to_pylist()).codes[1:])).view(np.int64)
        base = base[(base != 0) & (found(shared.value[4], base) < 0)]
        return pa.table({"bucket": pa.array(np.full(len(base), t.column("bucket")[0].as_py()), pa.int32()), "base": pa.array(base)})

    def spell(t: pa.Table, rare: pa.Table) -> pa.Table:
        _, model, common, edges, _ = shared.value
        words = t.column("word").to_pylist()
        by_part = np.array(t.column("by_part").to_pylist(), np.int64).reshape(-1, parts)
        tables = [common, rare.select(["context", "tail", "spot", "n"]).cast(common.schema)]
        for k in range(parts):
            on = np.flatnonzero(by_part[:, k])
            if len(on):
                own = pa.Table.from_batches(list(tallied([words[i] for i in on], by_part[on, k].tolist(), k, 1)))
                tables.append(own.filter(pa.array(found(edges, own.column("context").to_numpy()) < 0)).cast(common.schema))
        values = Speller(model, pa.concat_tables(tables)).spell(words, parts)
        return pa.table([t.column("word"), t.column("n"), *(pa.array(values[:, k]) for k in range(parts))], ["word", "n", *spellings(parts)])

    dealt = settle(counts.select("word", "n", "by_part").mapInArrow(deal, "word binary, n bigint, by_part array<bigint>, bucket int"))
    needs = dealt.select("word", "bucket").groupBy("bucket").applyInArrow(need, "bucket int, base bigint")
    rare = settle(needs.join(short.join(F.broadcast(hot), "base", "left_anti"), "base").select("bucket", "context", "tail", "spot", "n"))
    schema = "word binary, n bigint, " + ", ".join(f"{c} double" for c in spellings(parts))
    return dealt.groupBy("bucket").cogroup(rare.groupBy("bucket")).applyInArrow(spell, schema)


def spellings(parts: int) -> list[str]:
    return [f"s{k}" for k in range(parts)]


class Common:
    """The values of the commonest words."""

    def __init__(self, table: pa.Table):
        self.place = {w: i for i, w in enumerate(table.column("word").to_pylist())}
        #: Under each part, and last the base.
        self.values = np.stack([table.column(c).to_numpy() for c in [*(c for c in table.column_names if c not in ("word", "n", "base")), "base"]], 1)


def partial_scores(docs: DataFrame, common: pa.Table, parts: int) -> DataFrame:
    """Rows of docs' row (a digest): with word null, doc_id, the number of words, and of the common ones their number and sums; else another word and its count there."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().int, common))
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(shared.value[0], lambda: Common(shared.value[1]))
        get = own.place.get
        for b in slices(batches, 1_000):
            sums: list[tuple] = []
            rows, rare_words, times = [], [], []
            for row, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                words = [*words_of(text), END]
                at = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
                rare = Counter([words[i] for i in np.flatnonzero(at < 0)])
                at = at[at >= 0]
                sums.append((row, doc_id, len(words), len(at), *own.values[at].sum(0).tolist()))
                rows.append((row, len(rare)))
                rare_words += rare.keys()
                times += rare.values()
                if len(rare_words) > 100_000:
                    yield from batch(sums, rows, rare_words, times, parts, id_type)
                    sums, rows, rare_words, times = [], [], [], []
            yield from batch(sums, rows, rare_words, times, parts, id_type)

    return docs.select("row", "doc_id", "text").mapInArrow(run, f"row binary, doc_id {dict(docs.dtypes)['doc_id']}, word binary, times bigint, n_tokens bigint, n_known bigint, " + ", ".join(f"{c} double" for c in [*spellings(parts), "base_score"]))


def batch(sums: list[tuple], rows: list[tuple], words: list[bytes], times: list[int], parts: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Record batches of partial_scores, of bounded numbers of rows."""
    names = ["row", "doc_id", "word", "times", "n_tokens", "n_known", *spellings(parts), "base_score"]
    if sums:
        row, doc_id, tokens, known, *values = zip(*sums, strict=True)
        counted = [pa.array(c, pa.int64()) for c in ([0] * len(row), tokens, known)]
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.binary()), pa.array(doc_id, id_type), pa.nulls(len(row), pa.binary()), *counted, *(pa.array(v, pa.float64()) for v in values)], names)
    owner = pa.array(np.repeat(np.arange(len(rows)), [r[1] for r in rows]).astype(np.int64))
    row = pa.array([r[0] for r in rows], pa.binary()).take(owner) if len(words) else None
    for i in range(0, len(words), 200_000):
        n = min(200_000, len(words) - i)
        none, nought = pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n))
        yield pa.RecordBatch.from_arrays([row.slice(i, n), pa.nulls(n, id_type), pa.array(words[i : i + n], pa.binary()), pa.array(times[i : i + n], pa.int64()), none, none, *[nought] * (parts + 1)], names)


def score(docs: DataFrame, counts: DataFrame, model: Model, common: int = 200_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every whole text of docs (doc_id, text); counts has all their words.

    common: words of at most 40 bytes whose values go to every task; the others' meet them by a join. Null and empty
    texts consist of the end token. A row is known by a digest of its doc_id and text; rows that repeat both are summed
    together, and their sums shared out to as many rows again.
    """
    base = F.log10((F.col("n") + 1) / F.lit(float(model.tokens + model.distinct + 1)))
    parts = len(model.weights)
    values = settle(spelled(counts, model)).withColumn("base", base)
    hot = commonest(values.where("n > 0").where(F.length("word") <= 40), common)
    row = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))))
    found_in = partial_scores(docs.select("doc_id", "text", row.alias("row")), hot, parts)
    rare = found_in.where("word is not null").select("row", "word", "times").join(values, "word")
    of = lambda c: F.col("times") * F.col(c)
    none = F.lit(0).cast("long")
    met = rare.select("row", F.lit(None).cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), none.alias("copies"), none.alias("n_tokens"), F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"), *[of(c).alias(c) for c in spellings(parts)], of("base").alias("base_score"))
    both = found_in.where("word is null").withColumn("copies", F.lit(1).cast("long")).select(met.columns).unionByName(met)
    copies = F.sum("copies")
    sums = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), copies.alias("copies"), *[F.expr(f"sum({c}) div sum(copies)").alias(c) for c in ("n_tokens", "n_known")], *[(F.sum(c) / copies).alias(c) for c in (*spellings(parts), "base_score")])
    best = F.array_max(F.array(*spellings(parts)))
    mixture = sum((F.lit(w) * F.pow(F.lit(10.0), F.col(c) - best) for w, c in zip(model.weights, spellings(parts), strict=True)), F.lit(0.0))
    one = sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return one.select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", (best + F.log10(mixture)).alias("score"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def parted(docs: DataFrame, most: int = 6) -> tuple[DataFrame, list[float]]:
    """docs with `part`, and the parts' weights. Rows that are learned from belong to the part of their lang; part is null for the others.

    The most - 1 langs with most rows are parts of their own; all other rows, null langs too, are one more.
    """
    learned = docs.where(~held_out())
    sizes = learned.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most - 1).collect()
    langs = [(r["lang"], r["n"]) for r in sizes if r["lang"] is not None]
    rest = learned.count() - sum(n for _, n in langs)
    part = F.lit(len(langs))
    for k, (lang, _) in enumerate(langs):
        part = F.when(F.col("lang").eqNullSafe(F.lit(lang)), k).otherwise(part)
    # A part without rows would take weight for nothing; without any row there is one part that knows nothing.
    numbers = [n for _, n in langs] + ([rest] if rest or not langs else [])
    return docs.withColumn("part", F.when(~held_out(), part)), [n / max(1, sum(numbers)) if sum(numbers) else 1.0 for n in numbers]


def report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from documents that aren't held out.

    An empty table gives an empty result.
    """
    marked, weights = parted(docs.select("doc_id", "text", "lang"))
    counts = settle(word_counts(marked, len(weights)))
    scored = score(docs, counts, learn(counts, weights))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
