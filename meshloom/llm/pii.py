"""Personal data replaced by keyed pseudonyms of the same format, so that equal values stay linked across documents."""

from __future__ import annotations

import datetime
import re
from collections import Counter
from functools import lru_cache
from hashlib import shake_128
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import read_table, small_batches

KINDS = ("email", "phone", "ip", "card", "ssn", "iban", "date")
#: A deployment passes its own secret; this one only makes runs repeatable.
DEFAULT_KEY = b"meshloom-demo-key"
_ROUNDS = 10

_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])", re.A)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.A)
#: National numbers: with a leading zero in pairs (French) or after an area code (German, British), or of nine digits (Spanish).
_NATIONAL = (
    r"(?:0[1-9](?:[ .-][0-9]{2}){4}|\(?0[1-9][0-9]{1,4}\)?(?: ?[/-] ?|[ .])[0-9]{3,8}(?:[ -][0-9]{2,8}){0,2}"
    r"|[679][0-9]{2}(?:(?:[ -][0-9]{3}){2}|(?:[ -][0-9]{2}){3})|[89][0-9][ -][0-9]{3}(?:[ -][0-9]{2}){2})(?![A-Za-z0-9_]|[.-][0-9])"
)
#: With a plus: country code and groups of digits in any division, the trunk zero in brackets after it or not; cut to a length that the country has by _international.
_INTERNATIONAL = r"\+[1-9][0-9]{0,2}(?:[ .-]?\(0\))?[ .-]?\(?[0-9]{1,12}\)?(?:[ ./-](?![0-9]{4}[-/][0-9]{2}[-/])[0-9]{1,8}){0,6}(?![A-Za-z0-9_])"
#: Digits after the plus, country code included, for countries with numbers of one length (or few); others have 8 to 15.
_LENGTHS = {"1": (11,), "33": (11,), "34": (11,), "39": (8, 9, 10, 11, 12, 13), "44": (11, 12), "49": range(9, 14)}
#: One pass for all that starts with a digit, a plus or a bracket; the first alternative that matches and validates wins.
_NUMBERS = re.compile(
    r"(?<![A-Za-z0-9_@])(?<![0-9][.\-/])(?=[0-9+(])(?:"
    r"(?P<ip>[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![A-Za-z0-9_]|\.[0-9]))"
    r"|(?P<date>(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?:(?=[Tt][0-9]{2}(?::?[0-9]{2}|Z|z))|(?![A-Za-z0-9_]|[./-][0-9])))"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_]|-[0-9]))"
    r"|(?P<card>[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9_]|[-][0-9]))"
    rf"|(?P<phone>{_INTERNATIONAL}|{_NATIONAL}|"
    r"(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![A-Za-z0-9_]|[.-][0-9])|\+[0-9]{8,15}(?![A-Za-z0-9_]))"
    r")"
)
_SOME = re.compile(r"[0-9@]")
#: Years whose dates are permuted among themselves (first, end).
_ERAS = ((1900, 2100), (1, 1900), (2100, 10000))


def permute(x: int, n: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(n): an unbalanced Feistel network on a x b >= n, walked until it lands below n."""
    if n < 2:
        return x
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    size = max(8, (n.bit_length() + 7) // 8 + 8)
    while True:
        left, right = divmod(x, b)
        for r in range(_ROUNDS):
            source = right if r % 2 == 0 else left
            drawn = int.from_bytes(shake_128(b"|".join((key, tweak.encode(), b"%d" % r, b"%d" % source))).digest(size), "big")
            if r % 2 == 0:
                left = (left + drawn) % a
            else:
                right = (right + drawn) % b
        x = left * b + right
        if x < n:
            return x


def _luhn(digits: str) -> int:
    """The sum that is 0 mod 10 for a valid number."""
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))


def _respelled(model: str, digits: str) -> str:
    """Put the digits where the model has digits."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in model)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _chars(value: str, key: bytes, tweak: str) -> str:
    """Permute a string within its classes of digits, lower-case and upper-case letters; other characters stay."""
    sets = [next((s for s in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in s), c) for c in value]
    x, n = 0, 1
    for c, s in zip(value, sets, strict=True):
        x, n = x * len(s) + s.index(c), n * len(s)
    x, out = permute(x, n, key, f"{tweak}:{n}"), []
    for s in reversed(sets):
        x, k = divmod(x, len(s))
        out.append(s[k])
    return "".join(reversed(out))


def _email(value: str, key: bytes) -> str:
    local, _, domain = value.rpartition("@")
    return f"{_chars(local, key, 'email')}@{domain}"


def _ip(value: str, key: bytes) -> str | None:
    parts = [int(p) for p in value.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in value.split(".")):
        return None
    x = int.from_bytes(bytes(parts), "big")
    low, n = (1 << 24, 223 << 24) if 1 <= parts[0] <= 223 else (0, 1 << 32)
    return ".".join(map(str, (low + permute(x - low, n, key, f"ip{low}")).to_bytes(4, "big")))


def _card(value: str, key: bytes) -> str | None:
    digits = _digits(value)
    if not 13 <= len(digits) <= 19 or _luhn(digits) % 10 or digits[0] == "0" or len({*digits}) < 2:
        return None
    inner = f"{permute(int(digits[1:-1]), 10 ** (len(digits) - 2), key, f'card{len(digits)}{digits[0]}'):0{len(digits) - 2}d}"
    return _respelled(value, digits[0] + inner + str(-_luhn(digits[0] + inner + "0") % 10))


def _ssn(value: str, key: bytes) -> str | None:
    area, group, serial = value.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    areas = 898
    index = int(area) - 1 - (int(area) > 666)
    x = permute((index * 99 + int(group) - 1) * 9999 + int(serial) - 1, areas * 99 * 9999, key, "ssn")
    x, serial = divmod(x, 9999)
    index, group = divmod(x, 99)
    return f"{index + 1 + (index + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _international(value: str) -> str | None:
    """The longest part of a match, up to the end of a group, that has as many digits as the country's numbers."""
    for end in range(len(value), 7, -1):
        if not value[end - 1 : end].isdigit() or value[end : end + 1].isdigit():
            continue
        part = value[:end]
        digits = _digits(part.replace("(0)", ""))
        if re.fullmatch(r"[+][0-9]+[.][0-9]+", part):  # a signed decimal
            return None
        known = next((n for code, n in _LENGTHS.items() if digits.startswith(code)), range(8, 16))
        if len(digits) in known and part.count("(") == part.count(")"):
            return part
    return None


def _north_american(digits: str) -> bool:
    return len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"


def _phone(value: str, key: bytes) -> str | None:
    if value.count("(") != value.count(")"):
        return None
    trunk = value.find("(0)") if value[0] == "+" else -1
    if trunk > 0:  # the same number with or without it
        new = _phone(value[:trunk] + value[trunk + 3 :], key)
        return new and new[:trunk] + "(0)" + new[trunk:]
    digits = _digits(value)
    spanish = len(digits) == 9 and digits[0] in "6789" and "." not in value
    if value[0] != "+" and (9 <= len(digits) <= 12 and digits[0] == "0" != digits[1] or spanish):
        keep = 1 if spanish else 2
        rest = digits[keep:]
        return _respelled(value, digits[:keep] + f"{permute(int(rest), 10 ** len(rest), key, f'national{digits[:keep]}{len(rest)}'):0{len(rest)}d}")
    if value[0] == "+" and not 8 <= len(digits) <= 15 or value[0] != "+" and len(digits) != 10:
        return None
    american = len(digits) == 11 and digits[0] == "1" if value[0] == "+" else True
    rest = digits[-10:]
    if american and _north_american(rest):
        x = ((int(rest[:3]) - 200) * 800 + int(rest[3:6]) - 200) * 10_000 + int(rest[6:])
        x, line = divmod(permute(x, 6_400_000_000, key, "phone"), 10_000)
        area, exchange = divmod(x, 800)
        return _respelled(value, f"{digits[:-10]}{area + 200}{exchange + 200}{line:04d}")
    if value[0] != "+":
        return None
    x, n = int(digits[2:]), 10 ** (len(digits) - 2)
    while True:  # walked past the numbers that the other rule permutes, so no two numbers meet
        x = permute(x, n, key, f"phone{digits[:2]}{len(digits) - 2}")
        new = f"{digits[:2]}{x:0{len(digits) - 2}d}"
        if not (american and _north_american(new[1:])):
            return _respelled(value, new)


def _date(value: str, key: bytes) -> str | None:
    """Dates are permuted in their era; with slashes among the spellings of their own kind, so that no two spellings of different dates meet.

    Those kinds are: both numbers at most 12 (either may be the month), only the first above it, only the second above it.
    """
    mark = next(c for c in value if not c.isdigit())
    a, b, c = value.split(mark)
    first = len(a) == 4
    year, one, two = (int(a), int(b), int(c)) if first else (int(c), int(a), int(b))
    month, day = (one, two) if first or mark == "/" and one <= 12 else (two, one)
    try:
        had = datetime.date(year, month, day)
    except ValueError:
        return None
    low, end = next(e for e in _ERAS if e[0] <= year < e[1])
    if mark == "/" and not first and day <= 12:
        x, two = divmod(permute(((year - low) * 12 + one - 1) * 12 + two - 1, (end - low) * 144, key, f"slash{low}"), 12)
        year, one = divmod(x, 12)
        year, one, two = year + low, one + 1, two + 1
    elif mark == "/" and not first:
        start = datetime.date(low, 1, 1).toordinal()
        # the days after the 12th, counted from the era's start: walked until one is met
        x, n = had.toordinal() - start, datetime.date(end - 1, 12, 31).toordinal() - start + 1
        while True:
            x = permute(x, n, key, f"days{low}{one > 12}")
            new = datetime.date.fromordinal(start + x)
            if new.day > 12:
                break
        year, one, two = (new.year, new.day, new.month) if one > 12 else (new.year, new.month, new.day)
    else:
        start = datetime.date(low, 1, 1).toordinal()
        new = datetime.date.fromordinal(start + permute(had.toordinal() - start, datetime.date(end - 1, 12, 31).toordinal() - start + 1, key, f"date{low}"))
        year, one, two = (new.year, new.month, new.day) if first else (new.year, new.day, new.month)
    if first:
        return f"{year:04d}{mark}{one:02d}{mark}{two:02d}"
    pad = 2 if len(a) == len(b) == 2 else 1
    return f"{one:0{pad}d}{mark}{two:0{pad}d}{mark}{year:04d}"


def _iban(value: str, key: bytes) -> str | None:
    plain = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _chars(plain[4:], key, "iban" + plain[:2])
    rest = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(rest) for c in value)


_MAKE = {"email": _email, "phone": _phone, "ip": _ip, "card": _card, "ssn": _ssn, "iban": _iban, "date": _date}


@lru_cache(maxsize=1 << 16)
def pseudonym(kind: str, value: str, key: bytes = DEFAULT_KEY) -> str | None:
    """The pseudonym of a value, or None if the value isn't valid for its kind."""
    return _MAKE[kind](value, key)


def pseudonymise(text: str, key: bytes = DEFAULT_KEY) -> tuple[str, Counter]:
    """The whole text with every validated value replaced, and how many of each kind there were."""
    found: Counter = Counter()
    if not _SOME.search(text):
        return text, found

    def put(kind: str, value: str) -> str | None:
        new = pseudonym(kind, value, key)
        if new is not None:
            found[kind] += 1
        return new

    pieces, done = [], 0
    marked = [("email", m) for m in _EMAIL.finditer(text)] if "@" in text else []
    marked += [("iban", m) for m in _IBAN.finditer(text)]
    for kind, m in sorted(marked, key=lambda x: x[1].start()):
        if m.start() >= done and (new := put(kind, m[0])) is not None:
            pieces += (_numbers(text[done : m.start()], put), new)
            done = m.end()
    return "".join((*pieces, _numbers(text[done:], put))), found


def _numbers(text: str, put) -> str:
    """The text, which holds no address or IBAN, with its numbers and dates replaced."""
    out, done, at = [], 0, 0
    while m := _NUMBERS.search(text, at):
        value = _international(m[0]) if m.lastgroup == "phone" and m[0][0] == "+" else m[0]
        new = put(m.lastgroup, value) if value else None
        if new is None and m.lastgroup in ("card", "ssn", "ip", "date"):
            alone = _PHONE.match(text, m.start())
            if alone and (new := put("phone", alone[0])) is not None:
                value = alone[0]
        if new is None:
            at = m.start() + max(1, len(_RUN.match(text, m.start())[0]))
            continue
        out += (text[done : m.start()], new)
        done = at = m.start() + len(value)
    return "".join((*out, text[done:]))


_PHONE = re.compile(_NATIONAL + r"|(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![A-Za-z0-9_]|[.-][0-9])")
_RUN = re.compile(r"[+(]?[0-9]*")


def pseudonymise_documents(docs: DataFrame, text_col: str = "text", key: bytes = DEFAULT_KEY, counts: bool = True) -> DataFrame:
    """The same rows and columns with the values in text_col replaced; with counts, columns n_email ... n_date follow (any of those names in docs are replaced).

    E-mail addresses keep their domain and the classes of their characters, cards and IBANs stay valid,
    dates stay dates in the same spelling (of the years 1900 to 2099, before and after among themselves), telephone numbers keep country code or trunk digits and punctuation. Equal
    values give equal pseudonyms in every document and run under one key. A null text stays null with
    counts of zero, an empty one empty; invalid look-alikes stay as they are. Row by row, no shuffle.
    """
    names = [f"n_{k}" for k in KINDS]
    kept = docs.drop(*names) if counts else docs
    schema = StructType(kept.schema.fields[:])
    width, at = len(schema), schema.names.index(text_col)

    def run(batches):
        for batch in batches:
            texts, tallies = [], []
            for text in batch.column(at).to_pylist():
                new, found = (None, Counter()) if text is None else pseudonymise(text, key)
                texts.append(new)
                tallies.append(found)
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(width)]
            columns += [pa.array([t[k] for t in tallies], pa.int64()) for k in KINDS] * counts
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names * counts])

    for name in names * counts:
        schema.add(name, "long")
    small_batches(kept.sparkSession)
    return kept.mapInArrow(run, schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise_documents(read_table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text")))
