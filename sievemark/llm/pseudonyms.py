"""Personal data replaced by format-preserving pseudonyms: keyed Feistel permutations.

A value that passes its check (Luhn, IBAN, ranges of numbers, the calendar) is permuted among the
values of its own format: same length, same marks, same check digits. A Feistel network over
mixed digits and letters does it, with a keyed hash as round function; where the result
is no valid value, it is permuted again until it is one. The permutation depends on the key, the
kind and the format alone, so equal values get equal pseudonyms in all documents, and different
values different ones. With the key, `Pseudonyms.reveal` finds the value again.

Kinds, in the order in which they claim text: secret (access keys, passwords, tokens), e-mail, IBAN,
card, IP address (version 4 and 6), social security number, phone, date.

Digits of any script count as digits: a value is permuted as the number it is and written in its
own script again, so it stays linked to the same value in other digits. A date keeps the form it is
written in: its order, the width of day and month, the language and length of the month's name. Day
before month is taken where both readings are dates.

Defined results: null stays null; empty texts stay empty; text without such values is unchanged; columns
other than the text are kept, and ``pii`` lists what was found (kind, start and length in the new
text, which has the length of the old one). An empty key is refused; one above 64 bytes is hashed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b
from ipaddress import AddressValueError, IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROUNDS = 10
LONG_VALUE = 256  # symbols that are permuted together; longer values block by block
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
# Letters of other scripts in names of mail boxes, each permuted within its own row.
LETTERS = tuple(
    "".join(c for c in map(chr, range(first, last + 1)) if c.isalpha() and c.islower() == low)
    for first, last in ((0xC0, 0xFF), (0x100, 0x17F), (0x391, 0x3C9), (0x400, 0x45F))
    for low in (True, False)
)
_FIRST_DAY, _DAYS = date(1900, 1, 1), 73_049  # 1900 to 2099


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def luhn_digit(digits: str) -> str:
    return next(d for d in DIGITS if luhn(digits + d))


def iban_number(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4]))


class Pseudonyms:
    """The permutations of one key."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.key = key if len(key) <= 64 else blake2b(key).digest()
        self._seen = lru_cache(maxsize=100_000)(self._of)

    def of(self, kind: str, value: str) -> str:
        return self._seen(kind, value) if len(value) <= LONG_VALUE else self._of(kind, value)

    # The network works on a row of symbols, each with a number of possible values.

    def _round(self, kind: str, step: int, value: int, modulus: int) -> int:
        message = f"{kind}|{step}|{value}|{modulus}".encode()
        wide = blake2b(message, key=self.key, digest_size=32).digest()
        return int.from_bytes(wide, "big") % modulus

    def permute(self, symbols: list[int], radices: list[int], kind: str, back: bool = False) -> list[int]:
        middle = (len(symbols) + 1) // 2
        sizes = [1, 1]
        for i, radix in enumerate(radices):
            sizes[i >= middle] *= radix
        halves = [0, 0]
        for i, (symbol, radix) in enumerate(zip(symbols, radices)):
            halves[i >= middle] = halves[i >= middle] * radix + symbol
        tweak = f"{kind}|{','.join(map(str, radices))}"
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            side = step % 2
            change = self._round(tweak, step, halves[1 - side], sizes[side])
            halves[side] = (halves[side] + (-change if back else change)) % sizes[side]
        out = []
        for i in reversed(range(len(symbols))):
            side = i >= middle
            halves[side], symbol = divmod(halves[side], radices[i])
            out.append(symbol)
        return out[::-1]

    def _walk(
        self,
        value: str,
        kind: str,
        valid: Callable[[str], bool] = lambda _: True,
        back: bool = False,
        alphabets: tuple[str, ...] = (DIGITS, LOWER, UPPER),
    ) -> str:
        """Permute the digits and letters of a value until the result is valid again."""
        spots, own = [], []
        for i, c in enumerate(value):
            for alphabet in alphabets:
                if c in alphabet:
                    spots.append(i)
                    own.append(alphabet)
                    break
        radices = [len(a) for a in own]
        outline = list(value)
        for i in spots:
            outline[i] = "."
        tweak = kind + "|" + "".join(outline[:LONG_VALUE])
        symbols = [a.index(value[i]) for i, a in zip(spots, own)]
        blocks = [slice(i, i + LONG_VALUE) for i in range(0, len(symbols), LONG_VALUE)]
        while True:
            symbols = [
                symbol
                for at, block in enumerate(blocks)
                for symbol in self.permute(symbols[block], radices[block], f"{tweak}|{at}" if at else tweak, back)
            ]
            made = list(value)
            for i, a, s in zip(spots, own, symbols):
                made[i] = a[s]
            if valid("".join(made)):
                return "".join(made)

    def _of(self, kind: str, value: str, back: bool = False) -> str:
        return getattr(self, f"_{kind}")(value, back)

    def reveal(self, kind: str, pseudonym: str) -> str:
        return self._of(kind, pseudonym, True)

    def _secret(self, value: str, back: bool) -> str:
        if re.fullmatch("[0-9a-f]+", value):
            return self._walk(value, "secret", back=back, alphabets=("0123456789abcdef",))
        return self._walk(value, "secret", back=back)

    def _email(self, value: str, back: bool) -> str:
        name, end = value.rsplit(".", 1)
        return self._walk(name, "email", back=back, alphabets=(DIGITS, LOWER, UPPER, *LETTERS)) + "." + end

    def _iban(self, value: str, back: bool) -> str:
        plain = value.replace(" ", "")
        body = self._walk(plain[4:], "iban" + plain[:2], back=back)
        check = 98 - iban_number(plain[:2] + "00" + body) % 97
        return _fill(value, plain[:2] + f"{check:02d}" + body)

    def _card(self, value: str, back: bool) -> str:
        digits = re.sub(r"\D", "", value)
        body = self._walk(digits[:-1], "card", back=back)
        return _fill(value, body + luhn_digit(body))

    def _ip(self, value: str, back: bool) -> str:
        if ":" in value:
            return self._walk(value, "ipv6", back=back, alphabets=(DIGITS, "abcdef", "ABCDEF"))
        # Octets of one width keep the length of the text.
        octets = value.split(".")
        low = [0 if len(o) == 1 else 10 ** (len(o) - 1) for o in octets]
        radices = [min(256, 10 ** len(o)) - b for o, b in zip(octets, low)]
        made = self.permute([int(o) - b for o, b in zip(octets, low)], radices, "ip", back)
        return ".".join(str(m + b) for m, b in zip(made, low))

    def _ssn(self, value: str, back: bool) -> str:
        return self._walk(value, "ssn", is_ssn, back)

    def _phone(self, value: str, back: bool) -> str:
        found = re.match(r"\+\d{1,3}[ .-]", value) or re.match(rf"\+(?:{_COUNTRY})", value)
        code = found[0] if found else ""
        rest = value[len(code) :]
        digits = re.sub(r"\D", "", rest)
        local = is_local_phone(digits)
        bare = value.isdigit() and not local
        made = self._walk(
            digits,
            "phone" + code.strip(" .-"),
            lambda v: is_local_phone(v) == local and (not bare or v[0] >= "2"),
            back,
        )
        return code + _fill(rest, made)

    def _date(self, value: str, back: bool) -> str:
        form = DateForm.of(value)
        days = (form.day - _FIRST_DAY).days
        while True:
            # A radix of two and a larger one: 1 day in 150,000 or less is walked over.
            two, rest = divmod(days, 36_525)
            two, rest = self.permute([two, rest], [2, 36_525], "date", back)
            days = two * 36_525 + rest
            if days < _DAYS:
                made = form.write(_FIRST_DAY + timedelta(days=days))
                if made is not None:
                    return made


def _fill(pattern: str, symbols: str) -> str:
    """The symbols in place of the digits and letters of a pattern."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in pattern)


def is_ssn(value: str) -> bool:
    area, group, serial = value[:3], value[4:6], value[7:]
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def is_local_phone(digits: str) -> bool:
    return len(digits) == 10 and digits[0] >= "2" and digits[3] >= "2"


# The names of months; a name of several languages is of the first.
_MONTHS = [
    "January February March April May June July August September October November December".split(),
    "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(),
    "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split(),
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
]
_MONTH_OF = {
    name.lower(): (names, number)
    for names in reversed(_MONTHS)
    for number, name in enumerate(names, 1)
}
# The codes of countries, of one, two or three digits.
_COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2}"


class DateForm:
    """A date, and the way in which it is written."""

    def __init__(self, pieces: list[str], order: str, day: date):
        # Every second piece is a field, in the order of the letters of ``order``.
        self.pieces, self.order, self.day = pieces, order, day

    @classmethod
    def of(cls, value: str) -> DateForm | None:
        """None if the value is no date from 1900 to 2099."""
        pieces = re.split(r"(\d+|[^\W\d_]{3,})", value)
        fields = pieces[1::2]
        if len(fields) != 3:
            return None
        for order in ("ymd",) if len(fields[0]) == 4 else ("dmy", "mdy"):
            numbers = dict(zip(order, fields))
            if not numbers["m"].isdigit():
                numbers["m"] = _MONTH_OF.get(numbers["m"].lower(), (None, "0"))[1]
            try:
                day = date(int(numbers["y"]), int(numbers["m"]), int(numbers["d"]))
            except ValueError:
                continue
            if 0 <= (day - _FIRST_DAY).days < _DAYS:
                return cls(pieces, order, day)
        return None

    def _shape(self) -> list:
        """What a pseudonym has in common with the date."""
        fields = dict(zip(self.order, self.pieces[1::2]))
        month = fields["m"]
        if not month.isdigit():
            # Days below ten may be written with one digit or two; that stays.
            names = _MONTH_OF[month.lower()][0]
            return [self.order, len(fields["d"]), fields["d"][0] == "0", id(names), len(month)]
        widths = [len(fields["d"]), len(month)]
        if widths == [2, 2]:
            return [self.order, *widths]
        return [self.order, *widths, fields["d"][0] == "0", month[0] == "0"]

    def write(self, day: date) -> str | None:
        """Another date in this form; None if it has no such form."""
        pieces = list(self.pieces)
        for i, letter in enumerate(self.order):
            old = pieces[2 * i + 1]
            if not old.isdigit():
                new = _MONTH_OF[old.lower()][0][day.month - 1]
                new = new.upper() if old.isupper() else new.lower() if old.islower() else new.title()
            else:
                number = {"y": day.year, "m": day.month, "d": day.day}[letter]
                new = f"{number:0{len(old)}d}"
            pieces[2 * i + 1] = new
        made = DateForm.of("".join(pieces))
        # Read back, it must be the same date in the same form.
        return "".join(pieces) if made and made.day == day and made._shape() == self._shape() else None


def is_ipv6(value: str) -> bool:
    if len(re.findall("[0-9A-Fa-f]+", value)) < 3:
        return False
    try:
        IPv6Address(value)
    except AddressValueError:
        return False
    return True


# How secrets of well-known services begin.
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    r"AKIA(?P<a>[A-Z0-9]{16})(?![A-Za-z0-9])"
    r"|gh[opsru]_(?P<c>[A-Za-z0-9]{36,})"
    r"|github_pat_(?P<d>[A-Za-z0-9_]{22,})"
    r"|glpat-(?P<e>[A-Za-z0-9_-]{20,})"
    r"|xox[abprs]-(?P<f>[A-Za-z0-9-]{10,})"
    r"|AIza(?P<g>[A-Za-z0-9_-]{35})"
    r"|sk-(?P<h>[A-Za-z0-9_-]{20,})"
    r")"
    r"|(?i:\b(?:password|passwd|secret|token|api[_-]?key)\b)[\"']?\s*[=:]\s*[\"']?(?P<b>[A-Za-z0-9+/_.-]{8,})"
)
_SECRET_MARKS = ("AKIA", "_", "-", "AIza", "password", "passwd", "secret", "token", "key")
_MONTH_NAME = "|".join(sorted(_MONTH_OF, key=len, reverse=True))
_FINDERS: list[tuple[str, str, re.Pattern, Callable[[str], bool]]] = [
    ("email", "@", re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}(?![\w])"),
     lambda v: True),
    ("iban", "", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
     lambda v: 15 <= len(v.replace(" ", "")) <= 34 and iban_number(v.replace(" ", "")) % 97 == 1),
    ("card", "", re.compile(r"(?<![\w.-])(?!(?<=\+)\d{7,15}(?!\d))\d(?:[ -]?\d){12,18}(?![\w-])"),
     lambda v: luhn(re.sub(r"\D", "", v))),
    ("ip", "", re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w])(?!\.\d)"),
     lambda v: all(int(o) < 256 and (o == "0" or o[0] != "0") for o in v.split("."))),
    ("ip", ":", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}|:(?=:))(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])(?!\.\d)"), is_ipv6),
    ("ssn", "", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), is_ssn),
    ("phone", "", re.compile(
        r"(?<![\w+(])(?:\+\d{1,3}[ .-](?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
        r"|\+[1-9]\d{7,14}"
        r"|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?![\w-])"),
     lambda v: 7 <= len(re.sub(r"\D", "", v)) <= 15),
    ("phone", "", re.compile(r"(?<![\w.,/+-])\d{10}(?![\w/-])(?![.,]\d)"), lambda v: v[0] >= "2"),
    ("date", "", re.compile(
        r"(?<![\w./-])(?:\d{4}([-/.])\d{2}\1\d{2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-])(?!\.\d)"),
     lambda v: DateForm.of(v) is not None),
    ("date", "", re.compile(
        rf"(?i)(?<![\w./-])(?:\d{{1,2}}\.? (?:{_MONTH_NAME}),? \d{{4}}"
        rf"|(?:{_MONTH_NAME}) \d{{1,2}},? \d{{4}})(?![\w/-])(?!\.\d)"),
     lambda v: DateForm.of(v) is not None),
]
_ANY_DIGIT = re.compile("[0-9]")
_OTHER_DIGIT = re.compile(r"(?![0-9])\d")


def plain_digits(text: str) -> str:
    """The text with the digits of all scripts as 0 to 9; every character stays one."""
    return text if text.isascii() else _OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text)


def in_script(made: str, old: str) -> str:
    """The pseudonym with its digits in the script of the digits they replace."""
    if old.isascii():
        return made
    return "".join(
        chr(ord(o) - unicodedata.decimal(o) + int(m)) if o not in DIGITS and o.isdecimal() and m in DIGITS else m
        for m, o in zip(made, old)
    )


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of valid values, none within another; other digits must be made plain before."""
    digits = _ANY_DIGIT.search(text) is not None
    found: list[tuple[int, int, str]] = []
    claimed = bytearray(len(text))

    def claim(start: int, stop: int, kind: str) -> None:
        if claimed.find(1, start, stop) < 0:
            claimed[start:stop] = b"\1" * (stop - start)
            found.append((start, stop, kind))

    low = text.lower()
    if any(mark in text or mark in low for mark in _SECRET_MARKS):
        for m in _SECRET.finditer(text):
            claim(*m.span(m.lastgroup), "secret")
    for kind, mark, pattern, valid in _FINDERS:
        if mark not in text if mark else not digits:
            continue
        for m in pattern.finditer(text):
            if valid(m[0]):
                claim(*m.span(), kind)
    return sorted(found)


def replace(text: str, names: Pseudonyms) -> tuple[str, list[dict]]:
    pieces, at, listed = [], 0, []
    plain = plain_digits(text)
    for start, stop, kind in find(plain):
        pieces += [text[at:start], in_script(names.of(kind, plain[start:stop]), text[start:stop])]
        listed.append({"kind": kind, "start": start, "length": stop - start})
        at = stop
    return "".join([*pieces, text[at:]]), listed


def pseudonymize(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``pii``: what was found where."""
    columns = docs.columns
    others = [docs[n] for n in columns if n != text_col]
    rows = docs.select(
        (F.struct(*others) if others else F.lit(True)).alias("kept"), docs[text_col].alias("text")
    )
    kind = rows.schema["kept"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            texts, found = [], []
            for text in batch.column("text"):
                text = text.as_py()
                new, listed = (text, []) if not text else replace(text, names)
                texts.append(new)
                found.append(listed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(texts, pa.string()), pa.array(found, pa.list_(item))],
                ["kept", "text", "pii"],
            )

    done = rows.mapInArrow(
        run, f"kept {kind}, text string, pii array<struct<kind: string, start: int, length: int>>"
    )
    return done.select(
        *[F.col("text").alias(n) if n == text_col else F.col(f"kept.`{n}`").alias(n) for n in columns],
        "pii",
    )
