"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that prove valid (card numbers by their check digit, account numbers (IBAN) by
their remainder, IPv4 addresses by their octets, telephone and social security numbers by their
numbering rules, dates of 1900 to 2099 by the calendar) and the local parts of e-mail addresses are replaced by the
image of their value under a permutation of all values of the same format. Separators, lengths and
validity stay, check digits are made anew, and equal values get equal pseudonyms in every document,
however they are written: a date is permuted among those with a day above twelve or among the others,
so it has one image whether the year, the day or (where only that is a date) the month comes first.
Card numbers start with 3 to 6 or with 2221 to 2720 and keep that start's kind. Without the key the permutation cannot be turned round; with it, it can
(`inverse=True`). Candidates that fail their check stay as they are.

One pass over whole texts, no shuffle. Null text stays null and has no findings.
"""

from __future__ import annotations

import datetime
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, pick

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1

# Candidates, in order of preference where several start at one place.
CANDIDATE = re.compile(
    r"""
    (?P<email>(?<![\w.%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d))
  | (?P<date>(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}[./]\d{2}[./]\d{4})(?!\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>(?<![\w.+])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\)[ ]?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\d)
      |(?<![\w+])\+[2-9]\d{0,2}(?:[ .()-]{0,2}\d){6,12}(?!\d))
  | (?P<card>(?<!\d)\d(?:[ -]?\d){12,18}(?!\d))
    """,
    re.VERBOSE | re.ASCII,
)
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
SPACED = ("iban", "card")  # a candidate can run on into the next number


def feistel(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """Image of `value` under a keyed permutation of range(size): an alternating Feistel network
    on the next power of two, walked until it falls inside the range."""
    if size < 2:
        return value
    bits = max(2, (size - 1).bit_length())
    low = bits // 2
    widths = (bits - low, low)  # left, right

    def mixed(part: int, turn: int, width: int) -> int:
        data = f"{tweak}:{size}:{turn}:{part}".encode()
        raw = hashlib.blake2b(data, key=key).digest()
        for more in range(1, -(-width // 512)):  # halves wider than a digest
            raw += hashlib.blake2b(data + b":%d" % more, key=key).digest()
        return int.from_bytes(raw, "big") & ((1 << width) - 1)

    def once(x: int) -> int:
        left, right = x >> low, x & ((1 << low) - 1)
        for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if turn % 2 == 0:
                left ^= mixed(right, turn, widths[0])
            else:
                right ^= mixed(left, turn, widths[1])
        return left << low | right

    value = once(value)
    while value >= size:
        value = once(value)
    return value


def luhn_digit(digits: str) -> str:
    """Check digit that makes `digits` followed by it a valid card number."""
    total = 0
    for place, sign in enumerate(reversed(digits)):
        n = int(sign) * (2 if place % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


class Pseudonyms:
    """Maps valid values to pseudonyms under one key; remembers values it has met."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key = hashlib.blake2b(key).digest()
        self.inverse = inverse
        self.known: dict = {}
        # The days of the range by whether their number in the month is above twelve, and each one's place.
        self.halves: tuple[list, list] = ([], [])
        self.place: list = []

    def _half(self, day: datetime.date) -> list:
        if not self.place:
            for n in range(DAYS):
                half = self.halves[datetime.date.fromordinal(FIRST_DAY + n).day > 12]
                self.place.append(len(half))
                half.append(n)
        return self.halves[day.day > 12]

    def _move(self, value: int, size: int, tweak: str) -> int:
        return feistel(value, size, self.key, tweak, self.inverse)

    def _mixed(self, signs: str, tweak: str) -> str:
        """Permutes digits among digits and letters among letters, position by position format."""
        sizes = [10 if s.isdigit() else 26 for s in signs]
        number, size = 0, 1
        for sign, base in zip(signs, sizes, strict=True):
            at = int(sign) if base == 10 else ord(sign.lower()) - 97
            number, size = number * base + at, size * base
        number = self._move(number, size, tweak)
        out = []
        for sign, base in zip(reversed(signs), reversed(sizes), strict=True):
            number, at = divmod(number, base)
            letter = str(at) if base == 10 else chr(97 + at)
            out.append(letter.upper() if sign.isupper() else letter)
        return "".join(reversed(out))

    def pseudonym(self, kind: str, text: str) -> str | None:
        """The replacement, or None where the candidate is not valid."""
        at = (kind, text)
        if at not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[at] = getattr(self, "_" + kind)(text)
        return self.known[at]

    def _email(self, text):
        local, _, domain = text.partition("@")
        signs = "".join(s for s in local if s.isalnum())
        if not signs:
            return None
        return f"{_refill(local, self._mixed(signs.lower(), 'email'), str.isalnum)}@{domain}"

    def _iban(self, text):
        plain = text.strip().replace(" ", "")
        country, account = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_digits(country, account) != plain[2:4]:
            return None
        account = self._mixed(account, "iban" + country)
        return _refill(text, country + iban_digits(country, account) + account, str.isalnum)

    def _ip(self, text):
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        number = int.from_bytes(bytes(octets), "big")
        return ".".join(map(str, self._move(number, 2**32, "ip").to_bytes(4, "big")))

    def _date(self, text):
        sign = next(s for s in text if not s.isdigit())
        parts = [int(x) for x in re.split(r"[-./]", text)]
        year_first = len(re.split(r"[-./]", text)[0]) == 4
        if text.count(sign) != 2:
            return None
        # Day first; month first where only that is a date, so the order is part of the format.
        for order in ["ymd"] if year_first else ["dmy", "mdy"]:
            field = dict(zip(order, parts, strict=True))
            try:
                date = datetime.date(field["y"], field["m"], field["d"])
            except ValueError:
                continue
            day = date.toordinal() - FIRST_DAY
            if not 0 <= day < DAYS:
                continue
            half = self._half(date)
            moved = half[self._move(self.place[day], len(half), f"date{date.day > 12}")]
            return self._written(datetime.date.fromordinal(FIRST_DAY + moved), order, sign)
        return None

    @staticmethod
    def _written(day, order, sign):
        field = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
        return sign.join(field[o] for o in order)

    def _ssn(self, text):
        area, group, serial = (int(x) for x in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        rank = area - 1 - (area > 666)
        number = (rank * 99 + group - 1) * 9999 + serial - 1
        number, serial = divmod(self._move(number, 898 * 99 * 9999, "ssn"), 9999)
        rank, group = divmod(number, 99)
        return f"{rank + 1 + (rank + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, text):
        digits = "".join(s for s in text if s.isdigit())
        if text.startswith("+") and digits[0] != "1":
            code = 1 if digits[0] == "7" else 2
            moved = self._mixed(digits[code:], "phone" + digits[:code])
            return _refill(text, digits[:code] + moved, str.isdigit)
        code, own = digits[:-10], digits[-10:]
        number = int(own[0]) - 2
        number = (number * 100 + int(own[1:3])) * 8 + int(own[3]) - 2
        number = number * 10**6 + int(own[4:])
        number, rest = divmod(self._move(number, 64 * 10**8, "phone1"), 10**6)
        number, exchange = divmod(number, 8)
        area, tail = divmod(number, 100)
        return _refill(text, f"{code}{area + 2}{tail:02d}{exchange + 2}{rest:06d}", str.isdigit)

    def _card(self, text):
        digits = "".join(s for s in text if s.isdigit())
        if len(digits) < 13 or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        if "2221" <= digits[:4] <= "2720":
            tail = 10 ** (len(digits) - 5)
            number = (int(digits[:4]) - 2221) * tail + int(digits[4:-1])
            start, rest = divmod(self._move(number, 500 * tail, "card2"), tail)
            moved = f"{start + 2221}{rest:0{len(digits) - 5}d}"
            return _refill(text, moved + luhn_digit(moved), str.isdigit)
        if digits[0] not in "3456":
            return None
        moved = digits[0] + self._mixed(digits[1:-1], "card" + digits[0])
        return _refill(text, moved + luhn_digit(moved), str.isdigit)


def _refill(shape: str, signs: str, takes) -> str:
    """`shape` with the characters that `takes` accepts replaced by `signs` in turn."""
    rest = iter(signs)
    return "".join(next(rest) if takes(s) else s for s in shape)


def pseudonymise_text(text: str, names: Pseudonyms) -> tuple[str, list[tuple[str, int, int]]]:
    """(new text, findings as (kind, start, end) in the old text)."""
    found = []
    if "@" not in text and not any(d in text for d in "0123456789"):
        return text, found

    out, done, at = [], 0, 0
    while match := CANDIDATE.search(text, at):
        kind, start, part = match.lastgroup, match.start(), match.group()
        name = names.pseudonym(kind, part)
        while name is None and kind in SPACED and len(part) > 13:
            # The number may end before a space or dash, with another number behind it.
            cut = max(part.rfind(" "), part.rfind("-"))
            if cut < 13:
                break
            part = part[:cut]
            name = names.pseudonym(kind, part)
        if name is None:
            at = start + 1  # something else may start inside
            continue
        at = start + len(part)
        out += [text[done:start], name]
        found.append((kind, start, at))
        done = at
    out.append(text[done:])
    return "".join(out), found


def pseudonymise(docs: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """(doc_id, text, n_found, spans) for documents (doc_id, text): pseudonymised text, the number
    of values replaced, and kind:start:end of each in the original text."""
    bound_batches(docs.sparkSession)
    plain = pick(docs, "doc_id", "text")

    def moved(batches):
        import pyarrow as pa

        names = Pseudonyms(key, inverse)
        for batch in batches:
            texts, counts, spans = [], [], []
            for text in batch.column("text").to_pylist():
                new, found = (None, []) if text is None else pseudonymise_text(text, names)
                texts.append(new)
                counts.append(len(found))
                spans.append(",".join(f"{k}:{s}:{e}" for k, s, e in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()),
                 pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                ["doc_id", "text", "n_found", "spans"],
            )

    return plain.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        moved, "doc_id long, text string, n_found long, spans string"
    )
