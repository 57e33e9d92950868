"""Near-duplicate detection by SetSketch registers, banding, joint likelihood and a check on full sets.

A document's set holds the 64-bit hashes of its distinct word shingles. Its SetSketch is `bands * rows` registers;
register i is floor(1 - log_b(h_i)), truncated to a byte, of the minimum h_i of exponentially distributed hashes, so
registers of unions are maxima (mergeable) and equal registers are as likely as the sets are similar.

1. Documents with the same set are one node with a number of its own; a group's name is the smallest doc_id of its nodes.
2. Nodes are dealt into buckets by each band of registers. Two sets with a Jaccard similarity of 0.8 share none of
   the 40 bands of 6 registers with probability below 3e-6.
3. In each bucket one pivot is compared with all other members, so a bucket of n members gives n - 1 pairs, never
   all pairs. A maximum-likelihood estimate of the similarity from all registers together and the exact set sizes drops
   pairs that lie over five standard errors below the threshold; the others are confirmed on full sets.
4. Confirmed links are joined to components. In buckets whose members still lie in more than one component, a bound on
   the shingles that a member shares with other components drops those that can't be linked to one; the rest are
   compared in blocks, and new links joined to the components. So no pair of a bucket that could join two components
   goes untested, and a large group of copies costs one comparison per member.

Joins on hot keys have plain scans on both sides, whose partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import kept, settle, slices

BASE = 1.1
RATE = 20.0
TOP = 255
#: Shingles on the longer side of a block of sets that are compared in one group of rows.
BLOCK = 300_000

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import hashlib

        if len(self) > 200_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of all words as one shingle where there are fewer; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(kept("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))
    wide = min(width, len(h))
    n = len(h) - wide + 1
    acc = np.full(n, wide, np.uint64)
    for i in range(wide):
        acc = mixed(acc + h[i : i + n] + M1)
    return np.unique(acc)


def multipliers(registers: int) -> np.ndarray:
    return (mixed(np.arange(1, registers + 1, dtype=np.uint64) * M1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sketch(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The registers of one set, a byte each. Register i uses the elements' 32-bit hashes times the i-th odd factor."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(low, (factors[:, None] * short[None, at : at + 1024]).min(1), out=low)
    uniform = (low.astype(np.float64) + 0.5) / 2.0**32
    level = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint8)


def sketches(docs: DataFrame, width: int, registers: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (16-byte digest of the set; null if empty) and registers of each row of doc_id, text_key and text."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(registers)
        for b in slices(batches):
            sizes, keys, regs = [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, width)
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                regs.append(sketch(s, factors).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "text_key", "n_shingles", "set_key", "registers"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key binary, n_shingles bigint, set_key binary, registers binary")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """node and its set, as a sorted array of longs, of each row of node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [np.sort(shingle_set(t, width).view(np.int64)) for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))], ["node", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, hashes array<bigint>")


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches (rows), given the sizes of the sets, on a grid of 0.01."""
    above, below = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - above - below
    grid = np.arange(0, 1.005, 0.01)[None, :]
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    limit = np.minimum(u / v, v / u)
    j = np.minimum(grid, limit * 0.999999)

    def more(x: np.ndarray) -> np.ndarray:  # probability that the first register is the larger
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = more(u - v * j), more(v - u * j)
    fit = above * np.log(np.clip(p, 1e-12, 1)) + below * np.log(np.clip(q, 1e-12, 1)) + same * np.log(np.clip(1 - p - q, 1e-12, 1))
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def plausible(pairs: DataFrame, nodes: DataFrame, threshold: int, registers: int) -> DataFrame:
    """Of the pairs (a, b), those whose set sizes allow the threshold and whose likely similarity isn't far below it."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    sized = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    t = threshold / 100
    bar = t - 5.5 * max(0.01, (t * (1 - t) / registers) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            stack = lambda c: np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            likely = likely_similarity(stack("ra"), stack("rb"), b.column("na").to_numpy().astype(float), b.column("nb").to_numpy().astype(float))
            keep = pa.array(likely >= bar)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return sized.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= threshold * union on the full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(a, "a").join(b, "b").where(100 * shared >= threshold * (F.size("ha") + F.size("hb") - shared)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node and component (smallest reachable node) of every node with a link (a, b).

    Each round takes the smallest label among a node and its neighbours, then the label of that label; rounds go on
    until no label changes. Every round is settled, so a lost executor repeats no earlier round.
    """
    both = settle(links.union(links.select("b", "a")).toDF("node", "other"))
    labels = settle(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("component")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "component")
        lower = settle(heard.union(labels).groupBy("node").agg(F.min("component").alias("component")))
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("root"))
        after = settle(lower.join(jump, "component", "left").select("node", F.least("component", F.coalesce("root", "component")).alias("component")))
        changed = after.join(labels.withColumnRenamed("component", "was"), "node").where("component < was")
        if changed.isEmpty():
            return after
        labels = after


def in_mixed_buckets(placed: DataFrame) -> DataFrame:
    """The rows (bucket, node, component) of buckets that lie in more than one component."""
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    return placed.join(settle(mixed), "bucket", "left_semi")


def linkable(placed: DataFrame, sets: DataFrame, measured: DataFrame, threshold: int) -> DataFrame:
    """The rows of placed whose node could be linked to another component, with n_shingles and shared.

    shared counts the node's shingles that some other component of these buckets holds too: no link to another
    component can share more. With t the threshold, a link needs an intersection of t / (1 + t) of both sizes together,
    and the other set is no smaller than t of this one. This drops heavily edited copies without comparing them: first
    by their own size, once per node, then by the smallest set of each of their buckets.
    """
    own = settle(placed.select("node", "component").distinct())
    held = own.join(sets, "node").select("node", "component", F.explode("hashes").alias("hash"))
    common = settle(held.groupBy("hash").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("hash"))
    shared = held.join(common, "hash", "left_semi").groupBy("node").agg(F.count("*").alias("shared"))
    needed = lambda other: 100 * F.col("shared") * (100 + threshold) >= threshold * (100 * F.col("n_shingles") + other)
    fit = settle(shared.join(measured, "node").where(needed(threshold * F.col("n_shingles"))))
    sized = settle(placed.join(fit, "node"))
    smallest = sized.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
    return sized.join(smallest, "bucket").where(needed(F.greatest(100 * F.col("least"), threshold * F.col("n_shingles")))).drop("least")


def links_in_blocks(able: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The links (a, b) between components of each bucket.

    In a bucket, the nodes outside the largest component are compared with all nodes of other components, in blocks of
    a bounded number of shingles on either side; a block is one group of rows, and gives out nothing but links.
    """
    sizes = able.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    shape = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component", "weight")).alias("main"), F.sum("weight").alias("weight"))
    shape = settle(shape.select(
        "bucket",
        F.col("main.component").alias("main"),
        F.ceil(F.col("weight") / BLOCK).cast("int").alias("columns"),
        F.ceil((F.col("weight") - F.col("main.weight")) / (BLOCK / 4)).cast("int").alias("lines"),
    ))
    rows = able.join(shape, "bucket")
    line, column = F.pmod(F.xxhash64("node"), "lines").cast("int"), F.pmod(F.xxhash64("node"), "columns").cast("int")
    keep = ["bucket", "node", "component", "n_shingles", "shared"]
    tested = rows.where("component <> main").select(*keep, F.lit(True).alias("outside"), line.alias("line"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"))
    against = rows.select(*keep, F.lit(False).alias("outside"), F.explode(F.sequence(F.lit(0), F.col("lines") - 1)).alias("line"), column.alias("column"))
    part = settle(tested.unionByName(against))

    def test(t: pa.Table) -> pa.Table:
        outside = t.column("outside").to_numpy(zero_copy_only=False)
        node, part_of, size, shared = (t.column(c).to_numpy() for c in ("node", "component", "n_shingles", "shared"))
        sets = t.column("hashes").combine_chunks()
        sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
        flat, ends = sets.flatten().to_numpy(), sets.offsets.to_numpy() - sets.offsets[0].as_py()
        inside = np.flatnonzero(~outside)
        found: set[tuple[int, int]] = set()
        for x in np.flatnonzero(outside):
            own = flat[ends[x] : ends[x + 1]]
            both = size[inside] + size[x]
            fit = inside[(part_of[inside] != part_of[x]) & ((100 + threshold) * np.minimum(shared[inside], shared[x]) >= threshold * both) & (100 * np.minimum(size[inside], size[x]) >= threshold * np.maximum(size[inside], size[x]))]
            if not len(fit):
                continue
            theirs = np.concatenate([flat[ends[y] : ends[y + 1]] for y in fit])
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            common = np.add.reduceat((own[at] == theirs).astype(np.int64), np.concatenate([[0], np.cumsum(size[fit])[:-1]]))
            for y in fit[100 * common >= threshold * (size[fit] + size[x] - common)]:
                found.add((min(int(node[x]), int(node[y])), max(int(node[x]), int(node[y]))))
        links = sorted(found)
        return pa.table({"a": pa.array([k[0] for k in links], pa.int64()), "b": pa.array([k[1] for k in links], pa.int64())})

    return part.join(sets, "node").groupBy("bucket", "line", "column").applyInArrow(test, "a bigint, b bigint")


def near_groups(docs: DataFrame, width: int = 5, threshold: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """doc_id, text_key (digest of the text), n_shingles and component_id of each row of docs (doc_id, text); threshold in per cent.

    component_id is the smallest doc_id of the row's group, of whatever type doc_id is. A document without words or with
    a null text has no shingles and stays alone. Rows that repeat a doc_id with another text belong to the group of their
    own text. A row with a null doc_id gets the component_id of its group, null if no row there has a doc_id. An empty
    table gives an empty result.
    """
    registers = bands * rows
    keyed = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))
    sketched = settle(sketches(keyed.select("doc_id", "text_key", "text"), width, registers))
    by_set = sketched.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("named"), F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    nodes = settle(by_set.withColumn("node", F.monotonically_increasing_id()))
    key = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("registers", i * rows + 1, F.lit(rows))))
    dealt = nodes.select("node", F.explode(key).alias("bucket"))
    buckets = settle(dealt.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1"))
    members = settle(dealt.join(buckets.select("bucket", "pivot"), "bucket"))
    wanted = members.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    # Copies of a text are combined in each task before they meet their node, so no text is hot.
    texts = keyed.groupBy("text_key").agg(F.first("text").alias("text"))
    sets = settle(full_sets(texts.join(wanted, "text_key"), width))

    def linked(pairs: DataFrame) -> DataFrame:
        return settle(confirmed(settle(plausible(pairs.distinct(), nodes, threshold, registers)), sets, threshold))

    links = linked(members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    parts = components(links)
    placed = members.where("node <> pivot").select("bucket", "node").join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    able = settle(linkable(settle(in_mixed_buckets(placed)), sets, nodes.select("node", "n_shingles"), threshold))
    found = settle(links_in_blocks(settle(in_mixed_buckets(able)), sets, threshold).distinct())
    if not found.isEmpty():
        parts = components(links.union(found))
    grouped = settle(nodes.select("set_key", "node", "named").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    names = grouped.groupBy("component").agg(F.min("named").alias("component_id"))
    of_set = settle(grouped.join(names, "component").select("set_key", "component_id"))
    alone = F.when(F.col("set_key").isNull(), F.col("doc_id"))
    return sketched.join(of_set, "set_key", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", alone).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, on 4-word shingles at a similarity of 0.8.

    kept: doc_id and component_id are equal, or both null.
    """
    return near_groups(docs, width=4).drop("text_key").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of docs whose document is the smallest of its group, with the columns of docs, whatever their names.

    Rows with a null doc_id stay only in groups where no row has one. Rows that repeat a doc_id and text stay together.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))
    stays = near_groups(docs, width, threshold).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return rows.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi").select("_doc.*")
