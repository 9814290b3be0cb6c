"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

A span is ``(kind, start, end, score)`` in code points, ``end`` exclusive. The
base kinds ``email``, ``ip``, ``card`` and ``phone`` are found leftmost and
without overlap inside their kind, and are reported whenever their check holds
(parts of at most 255, Luhn, 10 to 15 digits); their score is informative. The
further kinds are reported from a score of ``MIN_SCORE`` on:

* ``iban``: country, two check digits and 11 to 30 letters or digits, also in
  groups of four; mod-97 must give 1. Words after a grouped account look like
  groups, so the end at the length of its country is tried before the whole;
* ``ssn``: ``ddd-dd-dddd``, which has no checksum, so only near a context word;
* ``secret``: the value of an assignment (``=``, ``:``, ``=>``, with or without
  quotes) of 16 to 512 characters; in place of a checksum its characters must be as
  mixed as random ones, and it is reported only near a context word, as digests look alike.

Defined cases: a null or empty text has no spans; rows are independent, so
repeated ids and rows give repeated results; a null id stays null; an empty
table gives an empty one; other columns are not read. All scans run in time
linear in the text, also for a text that is one long word or number.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from matchlens.llm.rowwise import map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
MIN_SCORE = 0.7
#: Code points on each side in which a context word counts.
CONTEXT = 48

#: A pattern's own score, what a passed checksum adds, what a context word adds.
PATTERN_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "ssn": 0.4, "secret": 0.2}
CHECKSUM_SCORE = {"card": 0.4, "iban": 0.4, "secret": 0.3}
CONTEXT_SCORE = 0.3

#: Words that make a kind likelier.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write to", "courriel", "correo"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "debit", "payment", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "security number"),
    "secret": ("token", "secret", "key", "api", "password", "passwd", "pwd", "auth", "credential", "bearer", "jeton", "mot de passe", "clave", "contraseña", "passwort", "kennwort", "schlüssel"),
}

#: Characters of an account by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ASSIGNED = re.compile(r"""[=:]>?[ \t]{0,3}["'`]?([A-Za-z0-9+/_-]{16,512})={0,2}(?![A-Za-z0-9+/_-])""")
#: Bits of information a character that random values have at least.
MIXED = 3.0
_NOT_DIGIT = re.compile(r"[^0-9]+")

SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
)


def luhn(digits: str) -> bool:
    """Whether every second digit from the right, doubled, makes the sum a multiple of ten."""
    total = sum(int(d) for d in digits[-1::-2])
    total += sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number with its first four characters moved to the end leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The pattern starts at the first local character of the run before an @,
    # or where the last match ended; going from @ to @ keeps the scan linear.
    done, at = 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        start = done + len(run.rstrip(_LOCAL))
        done = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    # A dotted run of numbers is cut into fours from its left end.
    for run in _DOTTED.finditer(text):
        parts = list(_PART.finditer(text, run.start(), run.end()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or "0") <= 255 for p in four):
                yield four[0].start(), four[3].end()


def _digits(pattern: re.Pattern, text: str, least: int, most: int, check: Callable[[str], bool] | None) -> Iterator[tuple[int, int]]:
    for found in pattern.finditer(text):
        digits = _NOT_DIGIT.sub("", found[0])
        if least <= len(digits) <= most and (check is None or check(digits)):
            yield found.span()


def _account_end(account: str) -> int | None:
    """Where in a proposed account it ends, None if no end passes the check."""
    ends = [i for i, c in enumerate(account) if c == " "]
    own = [end for end in ends if end - account.count(" ", 0, end) == IBAN_LENGTHS.get(account[:2])]
    return next((end for end in [*own, len(account)] if mod97(account[:end].replace(" ", ""))), None)


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    # A proposal has a bounded length, so starting again inside it keeps the scan linear.
    at = 0
    while found := _IBAN.search(text, at):
        end = _account_end(found[0])
        at = found.start() + (1 if end is None else end)
        if end is not None:
            yield found.start(), at


def _mixed(value: str) -> bool:
    """Whether a value has letters and digits, in shares as even as those of random characters."""
    shares = [value.count(c) / len(value) for c in set(value)]
    return any(map(str.isdigit, value)) and any(map(str.isalpha, value)) and -sum(p * log2(p) for p in shares) >= MIXED


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    return (found.span(1) for found in _ASSIGNED.finditer(text) if _mixed(found[1]))


def score_of(kind: str, text: str, start: int, end: int) -> float:
    """Pattern and checksum score, and more if a word of the kind's context is near."""
    near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".lower()
    seen = any(re.search(rf"\b{re.escape(word)}", near) for word in CONTEXT_WORDS[kind])
    return round(PATTERN_SCORE[kind] + CHECKSUM_SCORE.get(kind, 0.0) + CONTEXT_SCORE * seen, 3)


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of one text by start, then kind as in ``KINDS``."""
    if not text:
        return []
    found = {
        "email": _emails(text),
        "ip": _addresses(text),
        "card": _digits(_CARD, text, 14, 19, luhn),
        "phone": _digits(_PHONE, text, 10, 15, None),
        "iban": _accounts(text),
        "ssn": (m.span() for m in _SSN.finditer(text)),
        "secret": _secrets(text),
    }
    scored = [(kind, start, end, score_of(kind, text, start, end)) for kind, at in found.items() for start, end in at]
    kept = [s for s in scored if s[0] in BASE_KINDS or s[3] >= MIN_SCORE]
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None) -> str | None:
    """The text with each span, or union of overlapping spans, replaced by its first kind in brackets."""
    if not text:
        return text
    out, done = [], 0
    for kind, start, end, _ in spans_of(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _maker() -> Callable:
    return lambda text: (spans_of(text),)


def find_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` for every row."""
    return map_texts(df, key, text, StructType([StructField("spans", SPANS)]), partial(_maker))


def _redact(texts: pd.Series) -> pd.Series:
    return texts.map(redacted, na_action="ignore")


def redact(text: Column | str) -> Column:
    """Texts with their personal data replaced; null stays null."""
    return F.pandas_udf(_redact, StringType())(text)
