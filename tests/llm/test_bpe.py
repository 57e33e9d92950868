import hashlib
import random

import pytest
from tokenizers import Tokenizer

from showbill.llm import bpe

TEXTS = [
    "", " ", "Hello world", "it's   they'll\n\n  x ", "naïve café ÄÖ 日本語 🙂", "a" * 5000, "\t\t\n 12345 6.7%% ###", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "a <|endoftext|>  b", "é​\x00\x1c\x85",
    "  <|endoftext|>", "thththth" * 700, "ab" * 3 + " " * 9,
]


@pytest.fixture(scope="module")
def own():
    return bpe.Codec(bpe.vocabulary_path())


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_text_equal_the_library(own, text):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_report_over_a_table(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*TEXTS, None, "twice", "twice"])] + [(16, "twice", "clash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    library = Tokenizer.from_file(bpe.vocabulary_path())
    got = sorted(map(tuple, bpe.report(docs).collect()))
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.report(docs.limit(0)).count() == 0


def test_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    assert dict(bpe.decode(bpe.encode(docs)).collect()) == dict(enumerate(TEXTS))


def test_plain_words_need_no_pattern(own, monkeypatch):
    """Every word that wasn't remembered was searched by the pre-token pattern, though ASCII letters are one pre-token."""
    want = own.encode(" abracadabra")
    own.young, own.old = {}, {}
    monkeypatch.setattr(own, "pieces", None)
    assert own.encode(" abracadabra") == want and own.decode(want) == " abracadabra"


def test_new_words_are_merged_side_by_side(own, monkeypatch):
    """Each word that wasn't remembered had a tree of its own, in Python; only few or very long ones have."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("aeinorstué日", k=rng.randint(4, 9))) for _ in range(500)})
    texts = [" ".join(words[:300]), " ".join(words[250:]), "", words[0]]
    library = Tokenizer.from_file(bpe.vocabulary_path())
    alone, merge = [], own.merge
    monkeypatch.setattr(own, "merge", lambda piece: alone.append(piece) or merge(piece))
    own.young, own.old = {}, {}
    assert [ids.tolist() for ids in own.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(alone) < 3 * bpe.FEW


@pytest.mark.parametrize("remembered", [3, 150_000])
def test_random_texts_equal_the_library(remembered):
    """White space of every kind beside other, signs, contractions, NUL, pre-tokens of all widths."""
    rng = random.Random(remembered)
    own, library = bpe.Codec(bpe.vocabulary_path(), remembered), Tokenizer.from_file(bpe.vocabulary_path())
    marks = [" ", " ", " ", "\n", "\n\n", " \n", "\t", "　", "\x85", "\0", "'s", "'", "'ll", ",", ".\n", "%%%", "×", "÷", "ǃ", "ɐ", "12", "½", "<|endoftext|>", "<|", "é", "é", "ß", "日本", "🙂"]
    texts = ["".join(rng.choice(marks) if rng.random() < 0.5 else "".join(rng.choices("abcdehinorstuéñö", k=rng.choice([1, 3, 8, 20, 60, 130, 300]))) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decimal(ids).decode() == ",".join(map(str, want))
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    assert len(own.young) <= remembered and len(own.old) <= remembered
