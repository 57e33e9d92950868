"""Mixture-controlled packing: documents' tokens in full windows that hold every source in its target proportion.

Each source is a queue: its documents in a shuffled order that their ids fix, end to end on a line of tokens, in packets of
equal length. Deficit round-robin visits the queues once a round. A visit adds the source's quantum (its proportion of a window) to its deficit, sends
packets while the deficit covers one, and carries the rest on. As no queue is empty before its end, packet k (from 0) of a source with packets of
p tokens and quantum q goes in the first round r for which (r + 1) q >= (k + 1) p: the deficit at any window, and so
at the start of any task's windows, follows from sums over the queue and needs no walk from the beginning. Rounds end to
end are one line of tokens, which is cut into windows; so each window has each source's proportion to within two
packets, no window but those of the end has padding, and a queue that ends early leaves its place to the others.

Where a line lies is a running sum in two levels, by ranges of documents or rounds. Token ids are written once, beside
narrow rows that are laid out; they meet again row by row for the digests.
"""

from __future__ import annotations

import itertools
import os
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.llm.bpe import byte_letters
from showbill.llm.common import SPACE_BYTES, kept, running_sum, settle, slices


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Classes of bytes: white space, letters, digits, punctuation, and what only the library splits.
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)


def byte_classes() -> np.ndarray:
    """The class of each byte that stands alone."""
    classes = np.full(256, ODD, np.uint8)
    classes[0x21:0x7F] = SIGN
    classes[list(b"abcdefghijklmnopqrstuvwxyz")] = LETTER
    classes[list(b"0123456789")] = DIGIT
    classes[list(SPACE_BYTES)] = SPACE
    return classes


def lowered_latin() -> np.ndarray:
    """The lower case of each letter from U+0080 to U+024F whose lower case is one of them too; else 0. All of these are their own composed form."""
    lower = [chr(c).lower() if chr(c).isalpha() else "" for c in range(0x250)]
    return np.array([ord(x) if c >= 0x80 and len(x) == 1 and "\x80" <= x < "\u0250" else 0 for c, x in enumerate(lower)] + [0] * 0x30, np.uint16)


def contents(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of a whole binary array end to end, and where its values begin, with the end."""
    _, ends, data = values.buffers()
    return data.to_pybytes() if data else b"", np.frombuffer(ends, np.int32, len(values) + 1) if len(values) else np.zeros(1, np.int32)


def objects(values: pa.Array) -> list[bytes]:
    """The values of a whole binary array; to_pylist takes several times as long."""
    data, ends = contents(values)
    return [data[a:b] for a, b in itertools.pairwise(ends.tolist())]


class Pieces(dict):
    """Ids by piece: what isn't there is taken from the generation before, else encoded, and kept if it is short and there is room."""

    def __init__(self, encode: Callable[[bytes], bytes], old: dict[bytes, bytes], room: int):
        super().__init__()
        self.encode, self.old, self.room = encode, old, room

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= 64 and len(self) < self.room:
            self[piece] = ids
        return ids


class WordEncoder:
    """Token ids of whole texts by the tokenizers library, which is asked once for each word and each run of punctuation of many texts.

    Only for vocabularies whose normaliser lowers case and whose tokens cross neither white space nor the borders of letters, digits, punctuation and English contractions.
    Texts are joined and split in arrays: what is ASCII or Latin letters is what normaliser and splitter of the library leave, so its
    pieces are given to the library's merge model at once. A chunk between ASCII white space that holds anything else is a piece that goes through the library's whole encoder. Pieces
    are remembered in two generations: where the young one has `remembered` entries at the end of some texts it becomes the old one, so what is in use stays (some 160 MB a worker).
    """

    CLASSES, LATIN = byte_classes(), lowered_latin()

    def __init__(self, path: str, remembered: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.remembered = remembered
        self.known = Pieces(self.piece, {}, remembered)

    def coded(self, ids: Iterable[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def whole(self, text: bytes) -> bytes:
        return self.coded(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def piece(self, piece: bytes) -> bytes:
        """The ids of a piece as `split` gives it. In the merge model ASCII stands for itself, other bytes for letters."""
        try:
            text = piece.decode("utf-8")
        except UnicodeDecodeError:
            return self.whole(piece)
        if not piece.isascii():
            if not text.isalpha() or max(text) >= "\u0250" or text != text.lower():
                return self.whole(piece)
            text = piece.decode("latin-1").translate(self.letters)
        elif not text.isprintable():
            return self.whole(piece)
        return self.coded([t.id for t in self.model.tokenize(text)])

    def split(self, text: bytes) -> tuple[np.ndarray, pa.Array]:
        """Where the pieces of a text that ends with white space begin, and the pieces, in lower case."""
        raw = np.frombuffer(bytearray(text.lower()), np.uint8)
        kind = self.CLASSES.take(raw)
        if not text.isascii():
            at = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC9))
            after = raw[at + 1]
            low = np.where(after >> 6 == 2, self.LATIN.take((raw[at] & 31).astype(np.intp) << 6 | after & 63), 0)
            at, low = at[low > 0], low[low > 0]
            raw[at], raw[at + 1] = 0xC0 | low >> 6, 0x80 | low & 63
            kind[at] = kind[at + 1] = LETTER
        first = kind == DIGIT
        first[0] = True
        first[1:] |= kind[1:] != kind[:-1]
        # A contraction's apostrophe begins a run, and letters follow it; what follows the contraction begins anew.
        quote = np.flatnonzero((raw == ord("'")) & first)
        quote = quote[kind[quote + 1] == LETTER]
        one, two = raw[quote + 1], raw[np.minimum(quote + 2, len(raw) - 1)]
        short = quote[np.isin(one, list(b"stmd"))]
        long = quote[(two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l"))]
        first[short + 1] = first[long + 1] = False
        first[short + 2] = first[long + 3] = True
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            spaces = np.flatnonzero(kind == SPACE)
            chunk = np.unique(np.searchsorted(spaces, odd))
            turns = np.zeros(len(raw) + 1, np.int8)
            turns[np.where(chunk > 0, spaces[chunk - 1] + 1, 0) + 1] = 1
            turns[spaces[chunk]] -= 1
            first &= np.cumsum(turns[:-1], dtype=np.int8) == 0
        at = np.flatnonzero(first)
        length = np.diff(at, append=len(raw))
        dense = kind != SPACE
        own = dense[at]
        ends = np.zeros(np.count_nonzero(own) + 1, np.int32)
        np.cumsum(length[own], out=ends[1:])
        return at[own], pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw[dense])])

    def encode_all(self, texts: Sequence[bytes], end: int) -> list[bytes]:
        """The ids of each text in UTF-8, and the id `end`, as arrays' bytes. Texts that may hold a special token, which all begin with <|, are the library's alone."""
        special = {i: self.whole(t) for i, t in enumerate(texts) if b"<|" in t}
        plain = [b"" if i in special else t for i, t in enumerate(texts)]
        at, pieces = self.split(b" ".join([*plain, b""]) or b" ")
        coded = pieces.dictionary_encode()
        ids = pa.array(list(map(self.known.__getitem__, objects(coded.dictionary))), pa.binary()).take(coded.indices)
        if len(self.known) >= self.remembered:
            self.known.old = {}
            self.known = Pieces(self.piece, self.known, self.remembered)
        packed, ends = contents(ids)
        cut = ends[np.searchsorted(at, np.cumsum([0, *[len(t) + 1 for t in plain]]))].tolist()
        last = self.coded([end])
        return [special.get(i, packed[a:b]) + last for i, (a, b) in enumerate(itertools.pairwise(cut))]

    def encode(self, text: bytes, end: int) -> bytes:
        return self.encode_all([text], end)[0]


def portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of whole rows with at most `size` bytes of text, or one row."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield b.slice(at, upto - at)
            at = upto


def tokenized(docs: DataFrame, path: str, end: int) -> DataFrame:
    """_row (a number of its own for each row), doc_id, source, n (tokens with the id `end`), width (bytes a token), order (a checksum, for a stable order of equal ids), ids, written to the shared folder."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "source", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(("words", path), lambda: WordEncoder(path))
        for b in portions(batches):
            ids = own.encode_all(b.column("text").to_pylist(), end)
            n = pa.array([len(x) // own.dtype.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("doc_id"), b.column("source"), n, pa.array([own.dtype.itemsize] * len(ids), pa.int32()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["_row", "doc_id", "source", "n", "width", "order", "ids"])

    return settle(rows.mapInArrow(run, f"_row bigint, doc_id {kinds['doc_id']}, source {kinds['source']}, n bigint, width int, order bigint, ids binary"))


def quanta(lengths: DataFrame, window: int, least: int, weights: Mapping | None) -> DataFrame:
    """One row per source: source, source_no (in code-point order, null first), tokens, quantum (tokens a round, a double), packet (tokens).

    Without weights, a source's proportion is its part of all tokens, so all queues end together. A packet is the quantum, whole, and `least` tokens at least:
    a source with a smaller quantum saves its deficit until it covers one.
    """
    totals = lengths.groupBy("source").agg(F.sum("n").alias("tokens"))
    if weights is None:
        weighed = totals.withColumn("weight", F.col("tokens").cast("double"))
    else:
        named = F.create_map(*[F.lit(x) for k, w in weights.items() if k is not None for x in (k, float(w))]) if any(k is not None for k in weights) else None
        found = named[F.col("source")] if named is not None else F.lit(None).cast("double")
        weighed = totals.withColumn("weight", F.when(F.col("source").isNull(), F.lit(weights.get(None))).otherwise(found).cast("double"))
        weighed = weighed.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.raise_error(F.lit("every source needs a weight above 0")).cast("double")))
    weighed = settle(weighed)
    told = weighed.withColumn("quantum", F.col("weight") * window / weighed.agg(F.sum("weight")).scalar()).withColumn("packet", F.greatest(F.lit(least).cast("long"), F.floor("quantum").cast("long")))
    return settle(told.orderBy(F.col("source").asc_nulls_first()).select("source", F.monotonically_increasing_id().alias("source_no"), "tokens", "quantum", "packet"))


def end_cuts(total: int, window: int) -> list[int]:
    """Where the sequences after the last full window begin: what is left is cut into powers of two, the largest first, which need no padding."""
    at = total - total % window
    cuts = []
    for bit in range(window.bit_length() - 1, -1, -1):
        if (total % window) >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return cuts


def layout(lengths: DataFrame, window: int = 2048, least: int = 64, weights: Mapping | None = None, ranges: int = 16_384) -> DataFrame:
    """Pieces of rows: _row, start, length, sequence_id, offset. lengths: _row, doc_id, source, n (1 at least), order (any column that tells equal ids apart)."""
    goals = quanta(lengths, window, least, weights)
    total = goals.agg(F.sum("tokens")).first()[0] or 0
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    numbered = lengths.join(goals, lengths["source"].eqNullSafe(goals["source"])).select("_row", "doc_id", "order", "n", "source_no", "quantum", "packet")
    shuffled = [digest, F.col("doc_id"), F.col("order"), F.col("_row")]
    queued = settle(running_sum(numbered, "source_no", F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % 4096, shuffled, F.col("n"), "at"))
    packets = F.sequence(F.expr("at div packet"), F.expr("(at + n - 1) div packet"))
    cut = queued.select("_row", "source_no", "quantum", "packet", "at", "n", F.explode(packets).alias("k"))
    first = F.greatest(F.col("at"), F.col("k") * F.col("packet"))
    upto = F.least(F.col("at") + F.col("n"), (F.col("k") + 1) * F.col("packet"))
    turn = (F.ceil((F.col("k") + 1) * F.col("packet") / F.col("quantum")) - 1).cast("long")
    pieces = settle(cut.select("_row", "source_no", "k", turn.alias("round"), (first - F.col("at")).alias("start"), (upto - first).alias("length"), (first - F.col("k") * F.col("packet")).alias("within")))
    sent = settle(pieces.groupBy("round", "source_no", "k").agg(F.sum("length").alias("tokens")).withColumn("_line", F.lit(0)))
    rounds = (sent.agg(F.max("round")).first()[0] or 0) + 1
    line = running_sum(sent, "_line", F.expr(f"round div {-(-rounds // ranges)}"), [F.col("round"), F.col("source_no"), F.col("k")], F.col("tokens"), "position")
    placed = pieces.join(line.select("source_no", "k", "position"), ["source_no", "k"]).withColumn("position", F.col("position") + F.col("within"))

    full, cuts = total // window, end_cuts(total, window)
    ends = F.array(*[F.lit(c).cast("long") for c in [*cuts, total]])

    def sequence_of(position: Column) -> Column:
        after = sum(((position >= c).cast("long") for c in cuts), F.lit(full - 1).cast("long"))
        return F.when(position < full * window, F.call_function("div", position, F.lit(window))).otherwise(after)

    def begin_of(sequence: Column) -> Column:
        return F.when(sequence < full, sequence * window).otherwise(F.get(ends, (sequence - full).cast("int")))

    over = placed.withColumn("sequence_id", F.explode(F.sequence(sequence_of(F.col("position")), sequence_of(F.col("position") + F.col("length") - 1))))
    begin = F.greatest(F.col("position"), begin_of(F.col("sequence_id")))
    stop = F.least(F.col("position") + F.col("length"), begin_of(F.col("sequence_id") + 1))
    return over.select("_row", (F.col("start") + begin - F.col("position")).alias("start"), (stop - begin).alias("length"), "sequence_id", (begin - begin_of(F.col("sequence_id"))).alias("offset"))


def pack(docs: DataFrame, path: str | None = None, window: int = 2048, least: int = 64, weights: Mapping | None = None, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    docs: doc_id, text, source; other columns, whatever their names, are not read. Every row, also with null or empty text, ends with the id
    `end`, so each has a piece. window: tokens of a sequence (a power of two); weights: by source (None for null), the target proportions, all above 0; without, each source's part of all tokens.
    least: tokens of the shortest packet. Null sources are one source; rows that repeat a doc_id are documents of their own; a rerun gives the same pieces.
    An empty table gives an empty result.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    coded = tokenized(docs.select("doc_id", "source", "text"), path or vocabulary_path(), end)
    lengths = coded.select("_row", "doc_id", "source", "n", "order")
    pieces = layout(lengths, window, least, weights)
    # A row's pieces are bounded by its own length.
    of_row = pieces.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    met = coded.join(of_row, "_row")
    kinds = dict(coded.dtypes)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 128):
            flat = b.column("pieces").flatten()
            counts = b.column("pieces").value_lengths().to_numpy(zero_copy_only=False)
            place = np.repeat(np.arange(b.num_rows), counts)
            cuts = iter(zip(flat.field("start").to_numpy().tolist(), flat.field("length").to_numpy().tolist()))
            crc = []
            for ids, width, n in zip(b.column("ids").to_pylist(), b.column("width").to_pylist(), counts.tolist()):
                wide = memoryview(np.frombuffer(ids, f"<u{width}").astype("<u4")).cast("B")
                crc += [zlib.crc32(wide[4 * s : 4 * (s + k)]) for s, k in itertools.islice(cuts, n)]
            own = lambda c: b.column(c).take(pa.array(place))
            part = lambda c: flat.field(c)
            yield pa.RecordBatch.from_arrays([own("doc_id"), part("start"), part("length"), pa.array(crc, pa.int64()), own("n"), part("sequence_id"), part("offset"), own("source")], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    return met.mapInArrow(digests, f"doc_id {kinds['doc_id']}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source {kinds['source']}")


def report(docs: DataFrame) -> DataFrame:
    return pack(docs)
