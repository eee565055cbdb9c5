"""Pseudonyms that keep the format: a keyed Feistel permutation of validated numbers and dates."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ruleframe.llm.words import trimmed

ROUNDS = 10
_START, _DAYS, _SIDE = datetime.date(1900, 1, 1).toordinal(), 73049, 271  # fixed values: 1900 to 2099

_BEFORE = r"(?<![\w.@+-])"
_SHAPES = {
    "email": _BEFORE + r"(?:(?<!%)[\w.%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?!\w)",
    "iban": _BEFORE + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)",
    "ip": _BEFORE + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "date": _BEFORE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=[Tt][0-9]{2})"
    r"|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?!\w|[./-][0-9]))",
    "ssn": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?!\w|-[0-9])",
    "phone": r"(?<![\w.@])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?!\w|[.-][0-9])",
    "card": _BEFORE + r"[0-9](?:[\x20-]?[0-9]){12,18}(?!\w|-[0-9])",
}
_PATTERN = re.compile("|".join(_SHAPES.values()))
#: The shapes to try where something matches, in this order; for cards and IBANs one for each length. Blanks
#: in threes and fours are a telephone number's, so what follows one does not make it a card.
_TRIED = [
    (kind, re.compile(shape))
    for kind, whole in _SHAPES.items()
    for shape in {
        "iban": [_BEFORE + rf"[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + r"(?!\w)" for n in range(34, 14, -1)],
        "card": [_BEFORE + rf"[0-9](?:[\x20-]?[0-9]){{{n - 1}}}(?!\w|-[0-9])" for n in range(19, 12, -1)],
    }.get(kind, [whole])
]
#: What no value holds: it parts a text into pieces that are read alike alone and together.
_APART = re.compile(r"([^\w.%+@\x20()/-]|(?<=[a-z])\x20|\x20(?=[a-z]))")
_HINT = re.compile(r"@|[0-9][\x20./()-]*[0-9]")


class Feistel:
    """Permutations of [0, a * b) by a key, as an alternating Feistel network over both halves.

    Each round adds a keyed hash of one half to the other, modulo that half's size. So any sizes do,
    the inverse runs the rounds backwards, and the tweak gives each kind of value its own permutation.
    """

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key = hashlib.blake2b(key).digest()
        self.rounds = rounds

    def _round(self, tweak: str, number: int, half: int, size: int) -> int:
        text = f"{tweak}|{number}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big") % size

    def permute(self, value: int, a: int, b: int, tweak: str, back: bool = False) -> int:
        left, right = divmod(value, b)
        for i in range(self.rounds)[:: -1 if back else 1]:
            if i % 2:
                moved = self._round(tweak, i, right, a)
                left = (left - moved if back else left + moved) % a
            else:
                moved = self._round(tweak, i, left, b)
                right = (right - moved if back else right + moved) % b
        return left * b + right

    def walk(self, value: int, a: int, b: int, tweak: str, inside: Callable[[int], bool], back: bool = False) -> int:
        """A permutation of the values that are ``inside``: permute until one is."""
        while True:
            value = self.permute(value, a, b, tweak, back)
            if inside(value):
                return value

    def digits(self, digits: list[int], sizes: list[int], tweak: str, back: bool = False) -> list[int]:
        """Permute a number of mixed digits, digit i below sizes[i]."""
        half = len(sizes) // 2
        value = 0
        for digit, size in zip(digits, sizes):
            value = value * size + digit
        value = self.permute(value, prod(sizes[:half]), prod(sizes[half:]), tweak, back)
        out = []
        for size in reversed(sizes):
            value, digit = divmod(value, size)
            out.append(digit)
        return out[::-1]


def luhn(digits: list[int]) -> int:
    """The check digit that follows these digits."""
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _characters(text: str, feistel: Feistel, tweak: str, back: bool) -> str:
    """Permute ASCII digits and letters, each within its kind and case; the rest stays."""
    kinds = [(ord("0"), 10), (ord("A"), 26), (ord("a"), 26)]
    places = [(i, *k) for i, c in enumerate(text) for k in kinds if k[0] <= ord(c) < k[0] + k[1]]
    if not places:
        return text
    out = list(text)
    shape = "".join("0Aa"[[48, 65, 97].index(first)] for _, first, _ in places)
    new = feistel.digits([ord(text[i]) - f for i, f, _ in places], [s for *_, s in places], f"{tweak}|{shape}", back)
    for (i, first, _), digit in zip(places, new):
        out[i] = chr(first + digit)
    return "".join(out)


def _email(value: str, f: Feistel, back: bool) -> str:
    local, _, domain = value.rpartition("@")
    return f"{_characters(local, f, 'email', back)}@{domain}"


def _refill(value: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if c.isalnum() else c for c in value)


def _card(value: str, f: Feistel, back: bool) -> str | None:
    digits = [int(c) for c in value if c.isdigit()]
    if luhn(digits[:-1]) != digits[-1]:
        return None
    new = digits
    while True:  # what digits behind it would make a longer card stays too, so that it is found again
        new = f.digits(new[:-1], [10] * (len(digits) - 1), f"card|{len(digits)}", back)
        new.append(luhn(new))
        if luhn(new) == luhn(digits):
            return _refill(value, "".join(map(str, new)))


def _phone(value: str, f: Feistel, back: bool) -> str:
    digits = [int(c) for c in value if c.isdigit()]
    new = f.digits(digits[-10:], [10] * 10, "phone", back)
    return _refill(value, "".join(map(str, [*digits[:-10], *new])))


def _ssn(value: str, f: Feistel, back: bool) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area -= 2 if area > 666 else 1
    area, group, serial = f.digits([area, group - 1, serial - 1], [898, 99, 9999], "ssn", back)
    return f"{area + (2 if area >= 665 else 1):03}-{group + 1:02}-{serial + 1:04}"


def _ip(value: str, f: Feistel, back: bool) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    return ".".join(map(str, f.digits([int(o) for o in octets], [256] * 4, "ip", back)))


def _iban(value: str, f: Feistel, back: bool) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1 or plain[2:4] in ("00", "01", "99"):
        return None  # those digits are none that are given out, and would share a pseudonym with their twins
    new = _characters(plain[4:], f, f"iban|{plain[:2]}", back)
    return _refill(value, f"{plain[:2]}{98 - _mod97(new + plain[:2] + '00'):02}{new}")


def _date(value: str, f: Feistel, back: bool) -> str | None:
    """Year first, or day and month in either order; ambiguous ones count as month first with slashes
    and as day first with dots, and stay so."""
    sign = next(c for c in value if not c.isdigit())
    parts = value.split(sign)
    widths = [len(p) for p in parts]
    a, b, c = map(int, parts)

    def day_of(year: int, month: int, day: int) -> int | None:
        try:
            number = datetime.date(year, month, day).toordinal() - _START
        except ValueError:
            return None
        return number if 0 <= number < _DAYS else None

    day_first = sign == "." or a > 12
    number = day_of(a, b, c) if sign == "-" else day_of(c, *((b, a) if day_first else (a, b)))
    if number is None or (sign == "." and a > 31):
        return None

    def inside(new: int) -> bool:
        if new >= _DAYS:
            return False
        if sign == "-":
            return True
        d = datetime.date.fromordinal(new + _START)
        first, second = (d.day, d.month) if day_first else (d.month, d.day)
        fits = all((x >= 10) == (y >= 10) or w == 2 for x, y, w in ((first, a, widths[0]), (second, b, widths[1])))
        return fits and (sign == "." or not day_first or d.day > 12)

    d = datetime.date.fromordinal(f.walk(number, _SIDE, _SIDE, "date", inside, back) + _START)
    if sign == "-":
        return d.isoformat()
    first, second = (d.day, d.month) if day_first else (d.month, d.day)
    return f"{first:0{widths[0]}}{sign}{second:0{widths[1]}}{sign}{d.year:04}"


_KINDS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def _values(text: str, feistel: Feistel, back: bool) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, new value) of the validated values. Where a shape matches, all kinds and lengths
    are tried; if none is valid, the search goes on one character further."""
    found, at = [], 0
    while match := _PATTERN.search(text, at):
        at = match.start() + 1
        for kind, shape in _TRIED:
            part = shape.match(text, match.start())
            new = _KINDS[kind](part[0], feistel, back) if part else None
            if new is not None:
                at = part.end()
                found.append((part.start(), at, kind, new))
                break
    return found


def _replaced(text: str, found: list[tuple[int, int, str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with the new values, and where they stand in it."""
    out, places, at, moved = [], [], 0, 0
    for start, end, kind, new in found:
        out += [text[at:start], new]
        places.append((start + moved, start + moved + len(new), kind))
        at, moved = end, moved + len(new) - (end - start)
    return "".join([*out, text[at:]]), places


def _walked(text: str, feistel: Feistel, back: bool) -> str:
    """The values permuted together until they are found where they stand, so that the way back finds them."""
    step = _values(text, feistel, back)
    while step:
        text, places = _replaced(text, step)
        if [x[:3] for x in _values(text, feistel, back)] == places:
            break
        step = [(*place, _KINDS[place[2]](text[place[0] : place[1]], feistel, back)) for place in places]
    return text


def pseudonymise(text: str, feistel: Feistel, back: bool = False) -> tuple[str, int]:
    """The text with every validated value permuted, and how many there were."""
    if not _HINT.search(text):
        return text, 0
    found = _values(text, feistel, back)
    if not found:
        return text, 0
    new, places = _replaced(text, found)
    if [x[:3] for x in _values(new, feistel, back)] != places:
        new = "".join(_walked(x, feistel, back) if i % 2 == 0 else x for i, x in enumerate(_APART.split(text)))
    return new, len(found)


def pseudonymise_documents(
    docs: DataFrame, key: bytes, *, text: str = "text", name: str = "n_private", back: bool = False
) -> DataFrame:
    """``docs`` with its text pseudonymised and one more column, the number of values replaced.

    Validated values are e-mail addresses (the local part changes), IBANs and cards with a right check
    digit, IPv4 addresses, dates from 1900 to 2099, US social security and ten-digit telephone numbers.
    Each is mapped by a keyed permutation of its own format, so equal values stay equal in all documents
    whatever blanks or signs part their digits (a date is linked to others of its notation), check digits stay right, and ``back`` with the same key restores the text.
    A value that fails its check is text and stays, but valid ones inside it are found: shorter ones, other
    kinds at its place and those that start later. If a pseudonym makes such a neighbour valid by chance, the
    values around it are permuted again, and are then not linked to equal ones elsewhere. Null stays null, an empty text empty; nothing is
    shuffled; a column called ``name`` is replaced; all other columns and rows pass unchanged.
    """
    schema = StructType(
        [StructField(f.name, StringType()) if f.name == text else f for f in docs.schema if f.name != name]
        + [StructField(name, LongType())]
    )
    docs = docs.drop(name)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            texts, counts = [], []
            for body in batch.column(place):
                body = body.as_py()
                new, count = pseudonymise(body, feistel, back) if body else (body, 0)
                texts.append(new)
                counts.append(count)
            arrays = [*batch.columns, pa.array(counts, pa.int64())]
            arrays[place] = pa.array(texts, batch.schema.types[place])
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, name])

    return docs.mapInArrow(trimmed(run), schema)
