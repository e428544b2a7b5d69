"""Format-preserving pseudonyms for personal data.

Method: a keyed Feistel network permutes the digits of a number within its
format. Validated numbers keep their shape and stay valid: a card number keeps
its length, its Luhn check and its grouping; an account number (IBAN) keeps its
country, the kinds of its characters, its grouping and its check digits' validity; an
IPv4 address stays an address, an IPv6 address keeps its first group; a phone
number keeps its country and area code and its signs; a national identity number
keeps its grouping and validity rules; a date stays a date in the same
notation. Equal values get equal pseudonyms in all documents, other values
other ones (a permutation has no collisions), so links between documents stay.
The local part of an e-mail address becomes letters from a keyed hash, its
digits are permuted; a secret is replaced by keyed hexadecimal digits of its
length, a service's token behind its prefix by keyed characters of the same kinds.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, read_table

SLICE = 2 << 20
#: The session's setting that holds the key.
KEY_SETTING = "spark.fraudflow.pii.key"
#: Published, so good for made-up tables only.
OPEN_KEY = "made-up tables"
ROUNDS = 8


def feistel(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0..size-1, the same for equal key and tweak.

    A balanced network over the least even number of bits that covers ``size``,
    walked on until the value is in range again (cycle walking).
    """
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            mac = hashlib.blake2b(f"{tweak}|{size}|{i}|{right}".encode(), key=key, digest_size=16).digest()
            left, right = right, left ^ (int.from_bytes(mac) & mask)
        value = left << half | right
        if value < size:
            return value


def permuted(digits: str, key: bytes, tweak: str) -> str:
    """A digit string as long as ``digits``."""
    return str(feistel(int(digits), 10 ** len(digits), key, tweak)).zfill(len(digits)) if digits else digits


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` followed by it valid."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 - i % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def luhn_valid(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order by ``digits``."""
    new = iter(digits)
    return "".join(next(new) if c in "0123456789" else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def card(found: str, key: bytes) -> str | None:
    """13 to 19 digits with a valid check digit; any other number stays."""
    digits = _digits(found)
    if not 13 <= len(digits) <= 19 or not luhn_valid(digits):
        return None
    body = permuted(digits[:-1], key, "card")
    return refill(found, body + luhn_digit(body))


def phone(found: str, key: bytes) -> str | None:
    """The last seven digits are permuted under those before, without a leading 1: one pseudonym whatever the notation."""
    digits = _digits(found)
    if not 8 <= len(digits) <= 15:
        return None
    area = digits[:-7]
    if len(digits) == 11 and area[0] == "1":  # country code 1 is often left out
        area = area[1:]
    return refill(found, digits[:-7] + permuted(digits[-7:], key, f"phone{area}"))


def ipv4(found: str, key: bytes) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    new = feistel(int.from_bytes(bytes(map(int, parts))), 1 << 32, key, "ipv4")
    return ".".join(map(str, new.to_bytes(4)))


def ipv6(found: str, key: bytes) -> str | None:
    """Public, local and link-local addresses: all but the first group is permuted and written in full; others stay."""
    try:
        value = int(ipaddress.IPv6Address(found))
    except ValueError:
        return None
    first, rest = divmod(value, 1 << 112)
    if not (first >> 13 == 1 or first >> 9 == 0b1111110 or first >> 6 == 0b1111111010):  # 2000::/3, fc00::/7, fe80::/10
        return None
    value = first << 112 | feistel(rest, 1 << 112, key, f"ipv6{first}")
    new = ":".join(f"{value >> 16 * i & 0xFFFF:x}" for i in range(7, -1, -1))
    return new.upper() if found.upper() == found and found.lower() != found else new


def iban(found: str, key: bytes) -> str | None:
    """A valid account number: the part behind the check digits is permuted within its kinds, the check digits follow.

    What stands behind it, words in capitals or other numbers, is left off.
    """
    while True:
        plain = found.replace(" ", "")
        if 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            break
        found = found.rpartition(" ")[0]
        if not found:
            return None
    value, size = 0, 1
    for c in plain[4:]:
        base = 10 if c.isdigit() else 26
        value, size = value * base + int(c, 36) - (0 if base == 10 else 10), size * base
    kinds = "".join("9" if c.isdigit() else "A" for c in plain[4:])
    value = feistel(value, size, key, f"iban{plain[:2]}{kinds}")
    body = []
    for k in reversed(kinds):
        value, c = divmod(value, 10 if k == "9" else 26)
        body.append("0123456789"[c] if k == "9" else _LETTERS[c].upper())
    body = "".join(reversed(body))
    check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{plain[:2]}00")) % 97
    new = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(new) for c in found)


#: Numbers of the first group that no identity number has (fixed values).
_NO_AREA = {0, 666}


def identity(found: str, key: bytes) -> str | None:
    """ddd-dd-dddd with valid groups (no 000, 666 or 9xx; no 00; no 0000)."""
    a, b, c = (int(x) for x in found.split("-"))
    if a in _NO_AREA or a >= 900 or not b or not c:
        return None
    areas = 898  # 1..899 without 666
    index = ((a - 1 - (a > 666)) * 99 + (b - 1)) * 9999 + (c - 1)
    rest, c = divmod(feistel(index, areas * 99 * 9999, key, "identity"), 9999)
    a, b = divmod(rest, 99)
    a += 1 + (a >= 665)
    return f"{a:03d}-{b + 1:02d}-{c + 1:04d}"


_FIRST = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST + 1
_EARLY = [d for d in range(_DAYS) if datetime.date.fromordinal(d + _FIRST).day <= 12]
_LATE = [d for d in range(_DAYS) if datetime.date.fromordinal(d + _FIRST).day > 12]


def date(found: str, key: bytes) -> str | None:
    """Dates of 1900 to 2099 as yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy or, if the day says so, mm/dd/yyyy.

    Where a day or month has one digit, the new ones have no leading zeros either.
    """
    sign = next(c for c in found if not c.isdigit())
    parts = found.split(sign)
    order = [0, 1, 2] if len(parts[0]) == 4 else [2, 1, 0]
    if order[0] == 2 and sign == "/" and int(parts[1]) > 12:
        order = [2, 0, 1]
    try:
        day = datetime.date(*(int(parts[i]) for i in order)).toordinal() - _FIRST
    except ValueError:
        return None
    if not 0 <= day < _DAYS:
        return None
    # one permutation for all notations, of days up to 12 and of days over 12 among themselves: dd/mm and mm/dd stay what they are
    days = _EARLY if datetime.date.fromordinal(day + _FIRST).day <= 12 else _LATE
    new = datetime.date.fromordinal(days[feistel(bisect.bisect_left(days, day), len(days), key, "date")] + _FIRST)
    width = min(len(p) for p in parts)
    values = dict(zip(order, (f"{new.year:04d}", f"{new.month:0{width}d}", f"{new.day:0{width}d}"), strict=True))
    return sign.join(values[i] for i in range(3))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letters(text: str, n: int, key: bytes) -> str:
    mac = hmac.new(key, f"name|{text}".encode(), hashlib.sha256).digest()
    return "".join(_LETTERS[b % 26] for b in (mac * (n // 32 + 1))[:n])


def email(found: str, key: bytes) -> str:
    """Another local part; the domain stays. Digits are permuted; letters and signs become keyed letters, ten at least."""
    local, _, domain = found.rpartition("@")
    if local.isascii() and local.isdigit() and len(local) <= 18:
        return f"{permuted(local, key, f'email@{domain.lower()}')}@{domain}"
    return f"{_letters(found.lower(), max(10, len(local)), key)}@{domain}"


#: Beginnings of tokens by which services mark them (fixed values).
_MARKS = r"(?:sk|pk|rk)_(?:live|test)_(?=[0-9A-Za-z]{16})|gh[opsur]_(?=[0-9A-Za-z]{36})|A[KS]IA(?=[0-9A-Z]{16}(?![0-9A-Za-z]))|xox[abeprs]-"
_MARK = re.compile(_MARKS)


def secret(found: str, key: bytes) -> str:
    """As many keyed hexadecimal digits, in the same case; behind a mark, keyed digits, capitals and small letters for such."""
    mark = _MARK.match(found)
    if mark:
        stream = hashlib.shake_256(key + f"token|{found}".encode()).digest(2 * len(found))
        out = list(found)
        for i in range(mark.end(), len(found)):
            n = stream[2 * i] << 8 | stream[2 * i + 1]
            if found[i].isdigit():
                out[i] = "0123456789"[n % 10]
            elif found[i].isalpha():
                out[i] = (_LETTERS if found[i].islower() else _LETTERS.upper())[n % 26]
        return "".join(out)
    out, i = "", 0
    while len(out) < len(found):
        out += hmac.new(key, f"secret|{i}|{found}".encode(), hashlib.sha256).hexdigest()
        i += 1
    out = out[: len(found)]
    return out.upper() if found.upper() == found and found.lower() != found else out


#: Kinds in the order in which they are looked for; what one has found is not looked at again.
KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}", email),
    ("secret", rf"(?<![0-9A-Za-z])(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}|(?:(?:{_MARKS})[0-9A-Za-z]{{16,255}}|xox[abeprs]-[0-9A-Za-z-]{{16,255}}))(?![0-9A-Za-z])", secret),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])", iban),
    ("ipv6", r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,7}(?::[0-9A-Fa-f]{1,4}){1,6})(?!\w|:[0-9A-Fa-f]|\.\d)", ipv6),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", ipv4),
    ("date", r"(?<![\d/.-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d)", date),
    ("identity", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", identity),
    ("phone", r"\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?P<sep>[ .-]?)\d{2,4}(?:(?P=sep)\d{2,8}){1,3}(?!\d)|(?<![\w.-])1(?P<sign>[ .-])[2-9]\d\d(?P=sign)\d{3}(?P=sign)\d{4}(?![\w-])|(?<![\d(])\(\d{3}\) ?\d{3}[-.]\d{4}(?!\d)|(?<![\d.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d-])", phone),
    ("card", r"(?<![\w.-])(?:\d{4}[ .-]){3}\d{1,7}(?![\w-]|\.\d)|(?<![\w.-])\d{4}[ .-]\d{6}[ .-]\d{5}(?![\w-]|\.\d)|(?<![\w.])\d{13,19}(?!\w)", card),
]
_ANY = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS), re.ASCII)
_WORK = {name: work for name, _, work in KINDS}
NAMES = [name for name, _, _ in KINDS]
#: Every value has one of these; lines without are passed over.
_HINT = re.compile(r"[0-9@_]|A[KS]IA|xox|::")


def pseudonymised(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms for all values that validate, and their numbers by kind."""
    counts = dict.fromkeys(NAMES, 0)
    if not _HINT.search(text):
        return text, counts

    def changed(line: str) -> str:
        out, done, at = [], 0, 0
        while found := _ANY.search(line, at):
            kind = found.lastgroup
            new = _WORK[kind](found[0], key)
            if new is None:  # what looks like an account number may be one word before a card number
                at = found.start() + 4 if kind == "iban" else found.end()
                continue
            counts[kind] += 1
            out += [line[done : found.start()], new]
            done = at = found.start() + len(new) if kind == "iban" else found.end()
        return "".join(out) + line[done:]

    # no value spans a line
    return "\n".join(changed(line) if _HINT.search(line) else line for line in text.split("\n")), counts


def _replace(key: bytes):
    def work(rows):
        for batch in batches(rows, SLICE, "text"):
            done = [pseudonymised(t, key) if t is not None else (None, dict.fromkeys(NAMES, 0)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([t for t, _ in done], pa.string()), *(pa.array([c[k] for _, c in done], pa.int64()) for k in NAMES)],
                names=[*batch.schema.names, "new_text", *(f"n_{k}" for k in NAMES)],
            )

    return work


def pseudonyms(docs: DataFrame, key: str = "doc_id", text: str = "text", secret_key: str | None = None) -> DataFrame:
    """(key, text, new_text, n_email, n_secret, ...) of every row of ``docs``.

    ``secret_key`` decides the permutations; if it is not given, it is the
    session's setting ``spark.fraudflow.pii.key``; without either this raises
    ``ValueError``. Values that do not
    validate (an address with a part over 255, the 31st of February) stay. A
    null text stays null, an empty one empty; repeated rows get equal results; a
    null key stays null; an empty table gives no rows. No shuffle: a text is
    rewritten where it is read. Other columns of ``docs`` are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    secret_key = secret_key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not secret_key:
        raise ValueError(f"no key: pass secret_key or set {KEY_SETTING}")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in NAMES)
    out = rows.mapInArrow(_replace(hashlib.sha256(secret_key.encode()).digest()), f"id {kind}, text string, new_text string, {counts}")
    return out.withColumnsRenamed({"id": key, "text": text})


def op3_pii_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """``pseudonyms`` of ``documents``: the new text, its digest and the counts, under ``OPEN_KEY`` if the session sets no key."""
    secret_key = spark.conf.get(KEY_SETTING, OPEN_KEY)
    out = pseudonyms(read_table(spark, sf_dir, "documents"), secret_key=secret_key).withColumnRenamed("text", "old")
    new = F.sha2(F.coalesce("new_text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", F.col("new_text").alias("text"), new.alias("text_sha256"), *(f"n_{k}" for k in NAMES))
