"""Format-preserving pseudonyms for personal data.

Numbers and dates that are valid in their format (and the digits and letters of mail addresses and
keys) are permuted by a keyed Feistel network over exactly the values of that format: a card number
becomes another of the same length and with the same grouping, whose check digit holds if it held
before; a date becomes another date. Equal values, however they are spelled (blanks, marks, a phone's country
apart or not, the order of a date), get equal pseudonyms in
every document, and with the key the permutation can be turned back (`reveal=True`). So that a spelling
still reads as it did, a date keeps whether its month and its day are below 10 and its day above 12, and a phone number
of ten digits whether its parts begin with 2 to 9; a phone number keeps its country, a key its prefix.

A network permutes the numbers below a power of its halves; a result that is no value of the format is
permuted again until it is one (cycle walking), which again is a permutation.

Texts do not move; each is rewritten where it is.

Defined cases: null and empty texts stay as they are; text outside the matches is not touched; what
looks like a number but is not valid (a date of the 31st of February, an address part above 255) stays.
An empty table gives an empty result. Where `docs` has a column of the result's name, the result's gets underscores before it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import fresh, table

FEISTEL_ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
# For the registered query only; in use, a secret comes from the caller.
PUBLIC_KEY = b"a public key for verification"

KINDS = ("mail", "phone", "card", "account", "social", "address", "date", "secret")
_DIGITS, _LOWER, _ACCENTED = "0123456789", "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, [*range(0xE0, 0xF7), *range(0xF8, 0xFF)]))

_MAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_SECRET = re.compile(r"(?<![\w-])(?=[0-9a-fA-F]*\d)(?=\d*[a-fA-F])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w-])")
# How keys of well-known services begin, and what may follow.
_KEY = re.compile(
    r"""(?<![\w-])(?:
        (?P<prefix>AKIA|ASIA)[0-9A-Z]{16}
      | (?P<hub>gh[oprsu]_)[0-9A-Za-z]{36,255}
      | (?P<lab>glpat-)[0-9A-Za-z_-]{20,64}
      | (?P<map>AIza)[0-9A-Za-z_-]{35}
      | (?P<chat>xox[abprs]-)(?=[0-9A-Za-z-]*\d)[0-9A-Za-z-]{10,128}
      | (?P<model>[ps]k[-_](?:live_|test_|proj-)?)(?=[0-9A-Za-z_-]*\d)[0-9A-Za-z_-]{20,255}
    )(?![\w-])""",
    re.VERBOSE | re.ASCII,
)
# Calling codes of one and of two digits; all others have three.
_COUNTRY = re.compile(
    "1|7|2[07]|3[0123469]|4[013456789]|5[12345678]|6[0123456]|8[1246]|9[0123458]"
)
_NUMBER = re.compile(
    r"""(?<![\w.+-])(?:
        (?P<account>[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,4})?)(?!\w)
      | (?P<address>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?![\w]|\.\d)
      | (?P<date>(?:\d{4}(?P<mark>[-/.])\d{1,2}(?P=mark)\d{1,2}|\d{1,2}(?P<sign>[-/.])\d{1,2}(?P=sign)\d{4}))(?:(?=T\d\d)|(?![\w]|[-/]\d))
      | (?P<social>\d{3}-\d{2}-\d{4}(?![\w-])|(?<!\d\ )\d{3}\ \d{2}\ \d{4}(?!\w|[-]\d|\ \d))
      | (?P<card>\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}(?P<space>[ -])\d{6}(?P=space)\d{5}|\d{13,19})(?!\w|[-]\d)
      | (?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|(?<!\d\ )[2-9]\d\d\ [2-9]\d\d\ \d{4}(?!\ \d))(?!\w|[-]\d)
    )""",
    re.VERBOSE | re.ASCII,
)


def feistel(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of the numbers below `size`."""
    half = 1
    while half * half < size:
        half *= 2
    width = max(1, (half.bit_length() + 7) // 8)

    def mask(i: int, x: int) -> int:
        data = f"{kind}:{size}:{i}:".encode() + x.to_bytes(width, "big")
        return int.from_bytes(blake2b(data, key=key, digest_size=min(64, width + 8)).digest(), "big") % half

    while True:
        left, right = divmod(value, half)
        for i in range(FEISTEL_ROUNDS):
            if back:
                left, right = (right - mask(FEISTEL_ROUNDS - 1 - i, left)) % half, left
            else:
                left, right = right, (left + mask(i, right)) % half
        value = left * half + right
        if value < size:
            return value


def _walk(value: int, size: int, key: bytes, kind: str, same: Callable[[int], bool], back: bool) -> int:
    """The permutation among the values that are alike in `same`."""
    alike = same(value)
    while True:
        value = feistel(value, size, key, kind, back)
        if same(value) == alike:
            return value


def luhn(digits: str) -> bool:
    doubled = [int(c) * (2 - (i + len(digits)) % 2) if (i + len(digits)) % 2 == 0 else int(c) for i, c in enumerate(digits)]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def iban(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _refill(text: str, new: str) -> str:
    """`new` in the places that letters and digits have in `text`."""
    left = iter(new)
    return "".join(next(left) if c.isalnum() else c for c in text)


def _digits(text: str, key: bytes, kind: str, back: bool, same: Callable[[str], bool] = lambda d: True, fixed: int = 0) -> str:
    """Permute the digits of `text` but for the first `fixed`."""
    digits = "".join(c for c in text if c.isdigit())
    head, rest = digits[:fixed], digits[fixed:]
    new = _walk(int(rest), 10 ** len(rest), key, f"{kind}:{head}" if fixed else kind, lambda v: same(f"{head}{v:0{len(rest)}d}"), back)
    return _refill(text, f"{head}{new:0{len(rest)}d}")


def _letters(text: str, key: bytes, kind: str, back: bool, alphabets: tuple[str, ...]) -> str:
    """Permute the characters of each alphabet among themselves; the case of every letter stays."""
    low = text.lower() if len(text.lower()) == len(text) else text
    radix = [next((a for a in alphabets if c in a), "") for c in low]
    value, size = 0, 1
    for c, a in zip(low, radix, strict=True):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    value = feistel(value, size, key, f"{kind}:{'.'.join(str(len(a)) for a in radix)}", back) if size > 1 else value
    out = []
    for c, a in zip(reversed(text), reversed(radix), strict=True):
        if a:
            value, i = divmod(value, len(a))
            out.append(a[i].upper() if c.isupper() else a[i])
        else:
            out.append(c)
    return "".join(reversed(out))


def _account(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not iban(plain):
        return None
    rest = _letters(plain[4:], key, "account", back, (_DIGITS, _LOWER))
    check = 98 - int("".join(str(int(c, 36)) for c in rest + plain[:2] + "00")) % 97
    return _refill(text, f"{plain[:2]}{check:02d}{rest}")


def _address(text: str, key: bytes, back: bool) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    value = int.from_bytes(bytes(parts), "big")
    return ".".join(map(str, feistel(value, 1 << 32, key, "address", back).to_bytes(4, "big")))


def _day_class(day: date) -> tuple[bool, bool, bool]:
    """What spellings of a date depend on: digits of its month and day, and whether the day can be a month."""
    return day.month < 10, day.day < 10, day.day > 12


@lru_cache(1)
def _days() -> dict[tuple[bool, bool, bool], list[int]]:
    """All days by class, in ascending order."""
    out: dict[tuple[bool, bool, bool], list[int]] = {}
    for v in range(FIRST_DAY, LAST_DAY + 1):
        out.setdefault(_day_class(date.fromordinal(v)), []).append(v)
    return out


def _date(text: str, key: bytes, back: bool) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    parts = text.split(mark)
    numbers = [int(p) for p in parts]
    # Year first, or day first, or (if only that can be) month first.
    for order in ((0, 1, 2), (2, 1, 0), (2, 0, 1)):
        if len(parts[order[0]]) != 4:
            continue
        try:
            day = date(*(numbers[i] for i in order))
        except ValueError:
            continue
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            continue
        of_class = _day_class(day)
        days = _days()[of_class]
        kind = "date:" + "".join(str(int(c)) for c in of_class)
        new = date.fromordinal(days[feistel(bisect_left(days, day.toordinal()), len(days), key, kind, back)])
        spelled = [""] * 3
        for i, n in zip(order, (new.year, new.month, new.day), strict=True):
            spelled[i] = str(n).zfill(len(parts[i]))
        return mark.join(spelled)
    return None


def _phone(text: str, key: bytes, back: bool) -> str:
    """The country stays; a number of country 1 is the same with and without it."""
    digits = "".join(c for c in text if c.isdigit())
    if not text.startswith("+"):
        return _digits(text, key, "phone", back, _ten_digits)
    country = _COUNTRY.match(digits)
    fixed = country.end() if country else 3
    if digits[0] == "1" and len(digits) == 11:
        head = text.index("1") + 1
        return text[:head] + _digits(text[head:], key, "phone", back, _ten_digits)
    return _digits(text, key, "phone", back, fixed=fixed)


def _ten_digits(d: str) -> bool:
    return d[0] > "1" and d[3] > "1"


def _social_valid(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


class Pseudonyms:
    """Rewrites texts with one key."""

    def __init__(self, key: bytes, reveal: bool = False):
        self.key, self.back = key[:64], reveal
        self.pseudonym = lru_cache(1 << 14)(self._pseudonym)

    def _pseudonym(self, kind: str, text: str) -> str | None:
        key, back = self.key, self.back
        if kind == "mail":
            return _letters(text, key, kind, back, (_DIGITS, _LOWER, _ACCENTED))
        if kind == "secret" and (m := _KEY.fullmatch(text)):
            return m[m.lastgroup] + _letters(text[m.end(m.lastgroup) :], key, f"key:{m[m.lastgroup]}", back, (_DIGITS, _LOWER))
        if kind == "secret":
            new = _letters(text.lower(), key, kind, back, (_DIGITS + "abcdef",))
            return new.upper() if text.isupper() else new
        if kind == "account":
            return _account(text, key, back)
        if kind == "address":
            return _address(text, key, back)
        if kind == "date":
            return _date(text, key, back)
        if kind == "social":
            return _digits(text, key, kind, back, _social_valid) if _social_valid(re.sub("[ -]", "", text)) else None
        if kind == "card":
            return _digits(text, key, kind, back, luhn)
        return _phone(text, key, back)

    def rewrite(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the kind of each, mails and secrets first."""
        kinds: list[str] = []

        def put(kind: str, found: str) -> str:
            new = self.pseudonym(kind, found)
            if new is None:
                return found
            kinds.append(kind)
            return new

        if text and "@" in text:
            text = _MAIL.sub(lambda m: put("mail", m[0]), text)
        if text and _HAS_DIGIT(text):
            text = _KEY.sub(lambda m: put("secret", m[0]), text)
            text = _SECRET.sub(lambda m: put("secret", m[0]), text)
            text = self._numbers(text, kinds)
        return text, kinds

    def _numbers(self, text: str, kinds: list[str]) -> str:
        """Numbers and dates, from left to right; what is not valid as one kind may hold one of another."""
        out, at, search = [], 0, 0
        while m := _NUMBER.search(text, search):
            kind, found = m.lastgroup, m[0]
            new = self.pseudonym(kind, found)
            while new is None and kind == "account" and " " in found:
                # Words in capitals, or numbers, may follow an account number.
                found = found[: found.rindex(" ")]
                new = self.pseudonym(kind, found)
            if new is None:
                search = m.start() + 1
                continue
            out += [text[at : m.start()], new]
            at = search = m.start() + len(found)
            kinds.append(kind)
        return "".join([*out, text[at:]])


_HAS_DIGIT = re.compile("[0-9]").search


def pseudonymise(docs: DataFrame, key: bytes, out: str = "pseudonyms", reveal: bool = False) -> DataFrame:
    """`docs` with a column `out` of (text, kinds)."""

    @F.pandas_udf("text string, kinds array<string>")
    def rewrite(texts: pd.Series) -> pd.DataFrame:
        pseudonyms = Pseudonyms(key, reveal)
        return pd.DataFrame([pseudonyms.rewrite(t if isinstance(t, str) else None) for t in texts], columns=["text", "kinds"])

    return docs.withColumn(fresh(docs, out), rewrite("text"))


def _count(kind: str) -> Column:
    return F.size(F.filter("pseudonyms.kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PUBLIC_KEY).select(
        "doc_id", F.col("pseudonyms.text").alias("text"), F.size("pseudonyms.kinds").cast("bigint").alias("n_replaced"), *map(_count, KINDS)
    )


QUERIES = {"op9_pseudonyms": op9_pseudonyms}
SQL: dict[str, str] = {}
