"""Personal data replaced by format-preserving pseudonyms.

Validated numbers, dates, addresses and secrets are permuted within their own format by a keyed Feistel network: a
card stays a card with a right check digit, a date stays a date, a phone number keeps its shape. The permutation
depends on the key and the kind alone, so equal values get equal pseudonyms in every document, and different values
different ones. Documents are independent; Spark streams them through mapInArrow without a shuffle.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import slices

FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
ALPHABETS = [string.digits, string.ascii_lowercase, string.ascii_uppercase]
HEX = "0123456789abcdef"

DIGIT_KINDS = r"""
  (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))
 |(?P<date>(?<![\w-])\d{4}[-/.]\d{1,2}[-/.]\d{1,2}(?![\w-])|(?<![\w/.])\d{1,2}[/.]\d{1,2}[/.]\d{4}(?![\w/]))
 |(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))
 |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
 |(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w+])\(\d{3}\)[ ]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-]))
 |(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))
 |(?P<pem>-----BEGIN[ ](?:[A-Z0-9]+[ ])*PRIVATE[ ]KEY-----[^-]+-----END[ ](?:[A-Z0-9]+[ ])*PRIVATE[ ]KEY-----)
 |(?P<token>(?<!\w)(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|xox[abeprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?!\w))
 |(?P<secret>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?i:(?<=password)|(?<=passwd)|(?<=secret)|(?<=token)|(?<=api_key))\s*[=:]\s*["']?[A-Za-z0-9+/_-]{6,}["']?)
"""
MAIL = r"(?P<mail>(?<![\w.+-])[A-Za-z0-9_.+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}(?!\w))"
WITHOUT_MAIL = re.compile(DIGIT_KINDS, re.X)
WITH_MAIL = re.compile(f"{MAIL}|{DIGIT_KINDS}", re.X)
#: What a text must hold to be read at all: every pattern needs one of these.
WORTH = re.compile(r"[0-9@]|AKIA|ASIA|PRIVATE KEY|gh[pousr]_|github_pat_|xox|sk[-_]|rk_|AIza|glpat-|eyJ|(?i:passw|secret|token|api_key)")
TOKEN_HEAD = re.compile(r"gh[pousr]_|github_pat_|xox[abeprs]-|sk-|[sr]k_live_|AIza|glpat-|eyJ")
#: Calling codes of two digits; 1 and 7 are whole codes, all others have three digits.
TWO_DIGIT_CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


class Permuter:
    """A keyed permutation of the numbers below any size: a balanced Feistel network, walked until it lands below the size."""

    def __init__(self, key: bytes, rounds: int = 8):
        self.key, self.rounds = key, rounds

    def permute(self, value: int, size: int, kind: str) -> int:
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, wide = (1 << half) - 1, (half + 7) // 8
        while True:
            left, right = value >> half, value & mask
            for r in range(self.rounds):
                h = hashlib.blake2b(b"%d|%d|%s|" % (r, size, kind.encode()) + right.to_bytes(wide, "big"), key=self.key, digest_size=min(64, wide + 8)).digest()
                if wide > 56:
                    h = hashlib.shake_256(h).digest(wide + 8)
                left, right = right, left ^ (int.from_bytes(h, "big") & mask)
            value = left << half | right
            if value < size:
                return value

    def digits(self, digits: str, kind: str) -> str:
        return str(self.permute(int(digits), 10 ** len(digits), kind)).zfill(len(digits)) if digits else ""

    def letters(self, text: str, kind: str) -> str:
        """Permutes letters and digits, each within its class; other characters stay. Long texts go in parts of 64 characters."""
        if len(text) > 64:
            return "".join(self.letters(text[i : i + 64], f"{kind}|{i}") for i in range(0, len(text), 64))
        hexadecimal = len(text) >= 16 and all(c in HEX for c in text)
        classes = [HEX if hexadecimal else next((a for a in ALPHABETS if c in a), "") for c in text]
        value, size = 0, 1
        for c, a in zip(text, classes, strict=True):
            if a:
                value, size = value * len(a) + a.index(c), size * len(a)
        value, out = self.permute(value, size, f"{kind}|{len(text)}"), []
        for c, a in zip(reversed(text), reversed(classes), strict=True):
            if a:
                value, at = divmod(value, len(a))
                c = a[at]
            out.append(c)
        return "".join(reversed(out))


def check_digit(digits: str) -> str:
    """The Luhn digit that completes digits."""
    total = sum(int(c) if i % 2 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
    return str(-total % 10)


def refill(shape: str, digits: str) -> str:
    """shape with its digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def only_digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(text: str, p: Permuter) -> str | None:
    d = only_digits(text)
    if not 13 <= len(d) <= 19 or check_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = p.digits(d[:-1], "card")
    return refill(text, body + check_digit(body))


def date(text: str, p: Permuter) -> str | None:
    numbers = re.findall(r"\d+", text)
    orders = [(0, 1, 2)] if len(numbers[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        try:
            day = datetime.date(*(int(numbers[i]) for i in (y, m, d)))
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = FIRST_DAY + datetime.timedelta(p.permute((day - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, "date"))
        wide = 1 if min(len(numbers[m]), len(numbers[d])) == 1 else 2  # 2024-1-5 is written without zeros
        values = {y: f"{new.year:04d}", m: f"{new.month:0{wide}d}", d: f"{new.day:0{wide}d}"}
        marks = re.findall(r"\D", text)
        return values[0] + marks[0] + values[1] + marks[1] + values[2]
    return None


def address(text: str, p: Permuter) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    n = p.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, n.to_bytes(4, "big")))


def calling_code(digits: str) -> str:
    return digits[:1] if digits[:1] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def phone(text: str, p: Permuter) -> str | None:
    """Keeps the calling code and the shape. Equal numbers have equal digits, however they are written; without a code, ten digits are a number of code 1."""
    d = only_digits(text)
    code = calling_code(d) if text.startswith("+") else ""
    rest = d[len(code) :]
    if not 7 <= len(rest) <= 14:
        return None
    return refill(text, code + p.digits(rest, f"phone {code or '1'}"))


def iban(text: str, p: Permuter) -> str | None:
    flat = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1:
        return None
    body = p.letters(flat[4:], f"iban {flat[:2]}")
    flat = f"{flat[:2]}{98 - number(body + flat[:2] + '00') % 97:02d}{body}"
    it = iter(flat)
    return "".join(c if c == " " else next(it) for c in text)


def ssn(text: str, p: Permuter) -> str | None:
    """Numbers that are never given out stay as they are, and the walk goes on past them."""
    given = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    d = only_digits(text)
    if not given(d):
        return None
    while not given(d := p.digits(d, "ssn")):
        pass
    return refill(text, d)


def mail(text: str, p: Permuter) -> str:
    """The name is permuted; of the domain, all but the last two labels."""
    name, _, domain = text.partition("@")
    labels = domain.split(".")
    return ".".join([p.letters(name, "mail") + "@" + p.letters(labels[0], "host") if len(labels) > 2 else p.letters(name, "mail") + "@" + labels[0], *labels[1:]])


def secret(text: str, p: Permuter) -> str | None:
    m = re.match(r"""(AKIA|ASIA|\s*[=:]\s*["']?)(.*?)(["']?)$""", text, re.S)
    if m[1][0] not in "A" and not any(c.isdigit() for c in m[2]):
        return None  # a word after "token:" is prose
    return m[1] + p.letters(m[2], "secret") + m[3]


def token(text: str, p: Permuter) -> str:
    head = TOKEN_HEAD.match(text).group()
    return head + p.letters(text[len(head) :], "token")


def pem(text: str, p: Permuter) -> str:
    """The lines between the marks are permuted; the marks stay."""
    head, body, tail = re.match(r"(-----BEGIN[^-]+-----)(.*)(-----END.*)", text, re.S).groups()
    return head + "".join(p.letters(part, "pem") if part.strip() else part for part in re.split(r"(\s+)", body)) + tail


KINDS: dict[str, Callable[[str, Permuter], str | None]] = {"mail": mail, "ip": address, "date": date, "iban": iban, "ssn": ssn, "phone": phone, "card": card, "secret": secret, "token": token, "pem": pem}


def pseudonymised(text: str, p: Permuter) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each value in the original; values that fail validation stay."""
    if not WORTH.search(text):
        return text, []
    out, spans, at = [], [], 0
    for m in (WITH_MAIL if "@" in text else WITHOUT_MAIL).finditer(text):
        new = KINDS[m.lastgroup](m.group(), p)
        if new is not None:
            out += [text[at : m.start()], new]
            spans.append((m.lastgroup, m.start(), m.end()))
            at = m.end()
    return "".join([*out, text[at:]]) if spans else text, spans


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_values and spans (array of kind, start, end in the original) of each row.

    key: the secret of the permutation. A null text stays null with no values; rows may repeat; extra
    columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permuter(hashlib.sha256(key.encode()).digest())
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in slices(batches):
            got = [pseudonymised(t, p) if t else (t, []) for t in b.column("text").to_pylist()]
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, span)], ["doc_id", "text", "n_values", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text string, n_values bigint, spans array<struct<kind:string,start:int,end:int>>")


def report(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of docs: doc_id, text, n_values and the kinds found, in order."""
    return pseudonymise(docs, key).select("doc_id", "text", "n_values", F.col("spans.kind").alias("kinds"))
