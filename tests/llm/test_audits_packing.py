"""The audits and the packing against plain second implementations, on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from showbill.llm import filter_audit, packing, source_audit

TEXT = "the quick Brown fox jumps over the lazy dog and then runs far away into the deep dark forest "
LONG = " ".join(f"w{i}" for i in range(150))
ROWS = [
    (0, LONG, "en", "a"), (1, LONG, "de", "a"), (2, LONG, "en", "b"), (3, None, "en", "b"), (4, "", None, None), (5, "", "", ""), (6, TEXT * 9, "en", "a"), (7, "A" * 40 + " #", "de", None),
    (8, LONG + " $", "en", "a"), (8, LONG + " $", "en", "a"), (9, LONG.upper(), "fr", "b"), (None, LONG, "en", "a"), (None, "only here", None, "c"), (10, "x" * 200_000, "en", "c"), (11, "Été déjà ÉTÉ été it's 'tis <|endoftext|> <|StartOfText|>x 12345 …", "fr", "b"),
    (12, "a\x1cb c d́ é\n\t\x0b\x0cé ñ 漢字かな 😀😀 don't DON'T", "fr", "b"), (13, " ".join(f"v{i}" for i in range(9000)), "en", "hot"),
] + [(100 + i, f"{TEXT} n{i} {'rare' * (i % 3)}", "en" if i % 4 else "de", "hot" if i % 3 else "b") for i in range(90)]
LABELS = [(0, 1, 0), (0, 0, 1), (2, 1, None), (6, None, 1), (7, 0, 0), (8, 1, 1), (None, 1, 1), (103, 1, 1), (77777, 1, 1)]
SCHEMA = "doc_id bigint, text string, lang string, source string, part string, `term` int, ids int, good string, _row int, value int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1, 1, "clash", 1, 1) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def test_neighbour_swaps():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for p in filter_audit.neighbour_swaps(n):
            order[p], order[p + 1] = order[p + 1], order[p]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n) == 1 + sum(1 for _ in filter_audit.neighbour_swaps(n))


def audited(rows, labels):
    """The audit by its definition: every order, document by document."""
    out = {}
    parts = defaultdict(list)
    for i, text, lang, _ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(x is not None and x < i and (u or "") == t for x, u, *_ in rows)}
        said = [(q, x) for d, q, x in labels if d is not None and d == i]
        parts[lang or ""].append((fails, any(q == 1 for q, _ in said), any(x == 1 for _, x in said)))
    for part, found in parts.items():
        sums = Counter()
        for order in itertools.permutations("ABCDE"):
            left = found
            for step, f in enumerate(order, 1):
                gone, stay = [d for d in left if d[0][f]], [d for d in left if not d[0][f]]
                sums[f] += len(gone)
                out[part, "".join(order), step] = [len(stay), len(gone), sum(d[0][f] for d in found) - len(gone), sum(d[0][f] and sum(d[0].values()) == 1 for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                left = stay
        for (p, order, step), v in out.items():
            if p == part:
                v.append(sums[order[step - 1]])
    return out


def test_filter_audit(docs, labels):
    got = filter_audit.report(docs, labels).collect()
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == audited(ROWS, LABELS) and len(got) == 600 * 4


def test_filter_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", True, False, True, None), ("p", None, True, True, False), ("q", False, False, False, False)], "part string, good boolean, toxic boolean, x boolean, y boolean")
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(rows, {"X": "x", "Y": "y"}).collect()}
    assert got["p", "YX", 2] == [0, 2, 0, 2, 1, 1, 4] and got["q", "XY", 1] == [1, 0, 0, 0, 0, 0, 0] and len(got) == 8


def test_audits_of_nothing(docs, labels):
    none = docs.limit(0)
    assert filter_audit.report(none, labels).count() == source_audit.report(none).count() == packing.report(none).count() == 0
    assert filter_audit.report(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def distances(rows, least, top=50, add=5):
    """Both parts of the source audit by dense counts."""
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    df, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        g = (lang or "", source or "")
        groups.add(g)
        n[g].update(words(text))
        df[g[0]].update(set(words(text)))
    out = []
    for lang in {g[0] for g in groups}:
        vocab = sorted(t for t, k in df[lang].items() if k >= least)

        def shares(c):
            total = sum(c[t] for t in vocab)
            return {t: 1 + 10**9 * (c[t] + add) // (total + add * len(vocab)) for t in vocab}

        own = {s: shares(n[lang, s]) for l, s in groups if l == lang}
        q = shares(sum((n[lang, s] for s in own), Counter()))
        for s, p in own.items():
            pair = [(-sum(abs(p[t] - o[t]) for t in vocab), x.encode()) for x, o in own.items() if x != s]
            term = [(q[t] - p[t], t.encode()) for t in vocab if n[lang, s][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, x.decode(), -v, r) for r, (v, x) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 3, 30])
def test_source_audit(docs, least):
    assert sorted(map(tuple, source_audit.audit(docs, least).collect())) == distances(ROWS, least)


def test_source_audit_hands_on_sums(docs):
    """Tasks that keep few sums hand them on more often, with the same result."""
    kept = lambda held: sorted(map(tuple, source_audit.term_counts(docs, held).collect()))
    assert kept(1) == kept(400_000)


def test_shares_are_exact(spark):
    big = 9_000_000_000_000_000
    row = spark.range(1).select(source_audit.share(F.lit(big), F.lit(3 * big), F.lit(7), 5).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (3 * big + 35)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def checked(rows, pieces, library, window=2048):
    """Every id once, digests, gapless sequences; gives the sequences' pieces in order."""
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in rows]
    by_doc, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    want = defaultdict(Counter)
    for (i, *_), x in zip(rows, ids):
        want[i][len(x)] += len(x)
    for i, found in by_doc.items():
        assert Counter({k: sum(p["length"] for p in found if p["doc_tokens"] == k) for k in want[i]}) == want[i]
        texts = [x for (j, *_), x in zip(rows, ids) if j == i]
        for p in found:
            part = [np.array(x[p["start"] : p["start"] + p["length"]], "<u4") for x in texts if len(x) == p["doc_tokens"]]
            assert p["ids_crc32"] in {zlib.crc32(x.tobytes()) for x in part} and p["length"] > 0
        if len(texts) == 1:
            at = sorted((p["start"], p["length"]) for p in found)
            assert [s for s, _ in at] == [0, *itertools.accumulate(n for _, n in at)][:-1]
    assert set(by_doc) == set(want)
    out = []
    for s in sorted(seqs):
        own = sorted(seqs[s], key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [0, *itertools.accumulate(p["length"] for p in own)][:-1]
        out.append(own)
    lengths = [sum(p["length"] for p in own) for own in out]
    assert sorted(seqs) == list(range(len(seqs))) and all(n == window or n < window and n & (n - 1) == 0 for n in lengths)
    return out


def test_packing(docs, library):
    got = packing.report(docs).collect()
    checked(ROWS, got, library)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, packing.report(docs.repartition(2)).collect()), key=repr)


def test_encoder_is_the_library(library):
    own = packing.WordEncoder(packing.vocabulary_path(), remembered=5)
    for _, text, *_ in ROWS:
        ids = np.frombuffer(own.encode((text or "").encode(), 1), own.dtype).tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_asks_once_for_each_piece(library):
    """Words beside punctuation, contractions, digits and Latin capitals don't need the library's whole encoder, and each piece is merged once."""
    own, asked = packing.WordEncoder(packing.vocabulary_path()), []
    merge = own.model

    class Model:
        def tokenize(self, piece):
            asked.append(piece)
            return merge.tokenize(piece)

    def whole(text):
        raise AssertionError(text)

    own.model, own.whole = Model(), whole
    text = "The word, the word. (THE) word! Don't; it's word's 'word' we'll 21, 12 Été éTÉ, word..."
    for _ in range(2):
        assert np.frombuffer(own.encode(text.encode(), 1), own.dtype).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
    assert len(asked) == len(set(asked))


ODD_PARTS = [
    *"abstmdrevlSTRELV'''',.-_#01 \t\n\r\x0b\x0c\x00\x1c\x7f", "'s", "'re", "'ll", "don't", "<|", "|>", "<|endoftext|>",
    *"ÉéßẞİıŸªµ×́ſǅǆȺʰɐЖ中١ \u0085 ’ﬁᄒ가‍Å²\U0001f600",
]


@pytest.mark.parametrize("remembered", [7, 400_000])
def test_texts_encoded_together_are_the_library(library, remembered):
    own, pick = packing.WordEncoder(packing.vocabulary_path(), remembered), random.Random(13)
    for _ in range(1500):
        texts = ["".join(pick.choices(ODD_PARTS, k=pick.randrange(24))) for _ in range(pick.randrange(1, 5))]
        got = [np.frombuffer(ids, own.dtype).tolist() for ids in own.encode_all([t.encode() for t in texts], 1)]
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert len(own.known) <= remembered
    for _ in range(500):
        text = bytes(pick.choices(b"ab's \xc3\xa9\xe2\x80\x99\xc9\xff\xc2", k=pick.randrange(14)))
        assert np.frombuffer(own.encode(text, 1), own.dtype).tolist() == [*library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, 1]


def test_portions_are_whole_rows():
    texts = [b"", b"abc", b"d" * 50, b"", b"ef", b"ghijk", b"lmnopqrs", b""]
    batch = pa.record_batch({"text": texts})
    parts = [b.column("text").to_pylist() for b in packing.portions(iter([batch, batch.slice(3, 3)]), 10)]
    assert [t for p in parts for t in p] == texts + texts[3:6]
    assert all(len(p) == 1 or sum(map(len, p)) <= 10 for p in parts) and len(parts) == 5


def robin(queues, quanta, packets):
    """Deficit round-robin step by step: (source, packet, tokens) in the order of sending."""
    sent, deficit, at = [], dict.fromkeys(queues, 0), dict.fromkeys(queues, 0)
    while any(at[s] < queues[s] for s in queues):
        for s in sorted(queues):
            deficit[s] += quanta[s]
            while at[s] < queues[s] and deficit[s] >= packets[s]:
                n = min(packets[s], queues[s] - at[s])
                sent.append((s, n))
                deficit[s] -= packets[s]
                at[s] += n
    return sent


@pytest.mark.parametrize("weights", [None, {"a": 4.0, "b": 3.5, "c": 0.25, None: 0.25}])
def test_packing_is_deficit_round_robin(spark, weights):
    """The layout from sums equals the walk: sources' tokens along the line, and each window's mixture."""
    window, least = 256, 16
    rows = [(i, i, "abc"[i % 5 % 3] if i % 11 else None, 3 + i * 37 % 400, i) for i in range(400)]
    df = spark.createDataFrame(rows, "_row bigint, doc_id bigint, source string, n bigint, order bigint")
    got = packing.layout(df, window, least, weights, ranges=8).collect()
    source = {r[0]: r[2] or "" for r in rows}
    line = []
    for p in sorted(got, key=lambda p: (p["sequence_id"], p["offset"])):
        line += [source[p["_row"]]] * p["length"]
    queues = Counter()
    for r in rows:
        queues[r[2] or ""] += r[3]
    w = {s: queues[s] if weights is None else weights[s or None] for s in queues}
    quanta = {s: window * w[s] / sum(w.values()) for s in queues}
    packets = {s: max(least, int(quanta[s])) for s in queues}
    assert line == [s for s, n in robin(queues, quanta, packets) for _ in range(n)]
    ends = {s: len(line) - line[::-1].index(s) for s in queues}
    for at in range(0, min(ends.values()) - window, window):
        held = Counter(line[at : at + window])
        for s in queues:
            assert abs(held[s] - quanta[s]) <= 2 * packets[s] and abs(sum(1 for x in line[: at + window] if x == s) - quanta[s] * (at // window + 1)) <= sum(packets.values())


def test_end_cuts():
    assert packing.end_cuts(2048 * 3 + 1300, 2048) == [6144, 7168, 7424, 7440] and packing.end_cuts(4096, 2048) == []
