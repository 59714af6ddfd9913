"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Numbers and dates are found by pattern and validated: card numbers by Luhn's sum, IBANs modulo 97, social
security numbers by their ranges, IPv4 addresses by their octets, dates by the calendar (1900-2099; two-digit days and months, no word character
behind but an ISO time's T and digit: 3/7/1985 and 2024-05-01_log are left out), phone
numbers by their layout; so are e-mail addresses and access keys.  A value is its place among all values of
its format (the valid ones: a date stays a date, a card number keeps a valid sum).  A Feistel network over
that range, keyed and walked until it falls inside, permutes the places.  So a pseudonym has the format of
its original, equal values get equal pseudonyms in all documents (however they are spaced), different ones
different pseudonyms, and whoever has the key can invert it.

Texts are handled one by one within tasks; nothing is shuffled or broadcast but the key.

Kept as they are: separators, a phone's country code, an address's domain, the prefix of an access key, a
card's first digit, an IBAN's country.  Defined results: a null text stays null, an empty one empty, both
without spans; numbers that fail their test are left alone; of a run of groups (digits for a card,
capitals and digits for an IBAN) every part from group to group is tested, cards in their printed groups
first, then from the left and the longest first, and where neighbours would make another part valid the
permutation walks on, so that it can be inverted (such a value is not linked to its other places); where findings overlap, the earlier kind of
``KINDS`` wins; repeated rows and extra columns pass through (columns named like an output are replaced).
An empty table gives no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.common import ship, slices

ROUNDS = 10
#: Key of the registered query; a production run passes its own.
DEMO_KEY = b"pseudonym key of the registered query"
#: Text bytes that a task handles at once.
AT_ONCE = 4 << 20

_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


# ------------------------------------------------------------------ the permutation
class Feistel:
    """A keyed permutation of 0 .. size-1 for any size; ``tweak`` selects one of many."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, n: int, size: int, value: int) -> int:
        data = b"%d|%d|%d|" % (n, size, value) + tweak
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _halves(self, size: int) -> tuple[int, int]:
        a = math.isqrt(size - 1) + 1
        return a, -(-size // a)

    def _once(self, value: int, size: int, tweak: bytes, back: bool) -> int:
        a, b = self._halves(size)
        left, right = divmod(value, b)
        for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if n % 2:
                right = (right + sign * self._round(tweak, n, size, left)) % b
            else:
                left = (left + sign * self._round(tweak, n, size, right)) % a
        return left * b + right

    def permute(self, value: int, size: int, tweak: bytes = b"", back: bool = False) -> int:
        if size < 2:
            return value
        value = self._once(value, size, tweak, back)
        while value >= size:  # the halves' product is little more than the size
            value = self._once(value, size, tweak, back)
        return value


def _mixed(values: list[int], radices: list[int], feistel: Feistel, tweak: bytes, back: bool) -> list[int]:
    """Numerals of given radices, permuted as one number."""
    place, size = 0, 1
    for v, r in zip(values, radices):
        place, size = place * r + v, size * r
    place = feistel.permute(place, size, tweak, back)
    out = []
    for r in reversed(radices):
        place, v = divmod(place, r)
        out.append(v)
    return out[::-1]


def _characters(text: str, feistel: Feistel, tweak: bytes, back: bool) -> str:
    """Digits, small and capital letters (A-Z) permuted within their class; other characters stay."""
    at, values, radices, firsts = [], [], [], []
    for i, c in enumerate(text):
        for first, radix in (("0", 10), ("a", 26), ("A", 26)):
            if first <= c <= chr(ord(first) + radix - 1):
                at.append(i)
                values.append(ord(c) - ord(first))
                radices.append(radix)
                firsts.append(ord(first))
    out = list(text)
    for i, first, v in zip(at, firsts, _mixed(values, radices, feistel, tweak, back)):
        out[i] = chr(first + v)
    return "".join(out)


def _into(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, one after the other."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# ------------------------------------------------------------------ kinds of values
def luhn_sum(digits: str) -> int:
    """Luhn's sum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _card(text: str, f: Feistel, back: bool) -> str:
    digits = _digits(text)
    n = len(digits)
    body = f"{f.permute(int(digits[1:-1]), 10 ** (n - 2), b'card' + digits[:1].encode(), back):0{n - 2}d}"
    body = digits[0] + body
    return _into(text, body + str((10 - luhn_sum(body + "0")) % 10))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return not luhn_sum(digits) and len(set(digits)) > 1


#: Groups in which cards are printed; such parts of a run of digits are tried first.
_CARD_SHAPES = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))


def _card_parts(groups: list[str]) -> list[tuple[int, int]]:
    ranked = []
    for i in range(len(groups)):
        n = 0
        for j in range(i, len(groups)):
            n += len(groups[j])
            if n > 19:
                break
            if n >= 13:
                shape = tuple(len(g) for g in groups[i:j + 1])
                rank = 0 if j == i else 1 + _CARD_SHAPES.index(shape) if shape in _CARD_SHAPES else 9
                ranked.append((rank, i, -j))
    return [(i, -j + 1) for _, i, j in sorted(ranked)]


def _printed_parts(groups: list[str]) -> list[tuple[int, int]]:
    """The parts of one group or of printed groups."""
    return [(i, j) for i, j in _card_parts(groups) if j == i + 1 or tuple(len(g) for g in groups[i:j]) in _CARD_SHAPES]


def _iban_rest(country: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country + "00")) % 97


def _iban(text: str, f: Feistel, back: bool) -> str:
    plain = text.replace(" ", "")
    account = _characters(plain[4:], f, b"iban" + plain[:2].encode(), back)
    out = iter(f"{plain[:2]}{98 - _iban_rest(plain[:2], account):02d}{account}")
    return "".join(c if c == " " else next(out) for c in text)


_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return (15 <= len(plain) <= 34 and _IBAN.fullmatch(text) is not None
            and int(plain[2:4]) == 98 - _iban_rest(plain[:2], plain[4:]))


def _iban_parts(groups: list[str]) -> list[tuple[int, int]]:
    out = []
    for i, first in enumerate(groups):
        if re.match(r"[A-Z]{2}\d{2}", first):
            n, ends = 0, []
            for j in range(i, len(groups)):
                n += len(groups[j])
                if n > 34:
                    break
                if n >= 15:
                    ends.append(j + 1)
            out += [(i, j) for j in reversed(ends)]
    return out


class Run(NamedTuple):
    """Values that are parts of a run of groups: ``parts`` gives the places to try, (first, end) group, best
    first; of those that are ``valid``, each that meets no better one is a value."""

    parts: Callable[[list[str]], list[tuple[int, int]]]
    valid: Callable[[str], bool]
    pseudonym: Callable[[str, Feistel, bool], str]

    def values(self, m: re.Match, f: Feistel, back: bool, free: Callable[[int, int], bool],
               other: Callable[[str, int, int], bool]) -> Iterator[tuple[int, int, str]]:
        at = [g.span() for g in re.finditer(r"[A-Z0-9]+", m[0])]
        text, start = list(m[0]), m.start()
        tried = [(i, j) for i, j in self.parts([m[0][a:b] for a, b in at]) if free(start + at[i][0], start + at[j - 1][1])]
        holds = lambda i, j: self.valid("".join(text[at[i][0]:at[j - 1][1]]))

        def clash(text: list[str], a: int, b: int) -> bool:
            low = max(0, a - 40)
            left = m.string[max(0, start + a - 40):start] if a < 40 else ""
            piece = left + "".join(text[low:b + 40])
            return other(piece + m.string[m.end():m.end() + 40], len(left) + a - low, len(left) + b - low)

        owner: dict[int, int] = {}
        taken = []
        for n, (i, j) in enumerate(tried):
            if not any(g in owner for g in range(i, j)) and holds(i, j):
                owner.update((g, n) for g in range(i, j))
                taken.append(n)
        meets: dict[int, list[int]] = {}
        for n, (i, j) in enumerate(tried):
            for g in range(i, j):
                if g in owner:
                    meets.setdefault(owner[g], []).append(n)
        # One value after the other (from the last, to invert) walks on until no other part or kind would be
        # taken in its place: the new text has its values where the old one has them.
        for n in reversed(taken) if back else taken:
            i, j = tried[n]
            a, b = at[i][0], at[j - 1][1]
            was = clash(text, a, b)
            while True:
                text[a:b] = self.pseudonym("".join(text[a:b]), f, back)
                if clash(text, a, b) == was and not any(
                        holds(*tried[c]) and all(owner.get(g, c) >= c for g in range(*tried[c])) for c in set(meets[n]) - {n}):
                    break
        for n in sorted(taken, key=tried.__getitem__):
            a, b = at[tried[n][0]][0], at[tried[n][1] - 1][1]
            yield start + a, start + b, "".join(text[a:b])


def _ssn(m: re.Match, f: Feistel, back: bool) -> str | None:
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area, group, serial = _mixed([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], f, b"ssn", back)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(m: re.Match, f: Feistel, back: bool) -> str | None:
    number = _digits(m[2])
    # A leading 2-9 of area and exchange stays one, as these are not free elsewhere either.
    radices = [8 if i in (0, 3) and c >= "2" else 2 if i in (0, 3) else 10 for i, c in enumerate(number)]
    values = [int(c) - 2 if r == 8 else int(c) for c, r in zip(number, radices)]
    tweak = b"phone" + bytes(radices)
    out = _mixed(values, radices, f, tweak, back)
    return (m[1] or "") + _into(m[2], "".join(str(v + 2 * (r == 8)) for v, r in zip(out, radices)))


def _ipv4(m: re.Match, f: Feistel, back: bool) -> str | None:
    octets = [int(x) for x in m[0].split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    return ".".join(map(str, _mixed(octets, [256] * 4, f, b"ipv4", back)))


def _date(m: re.Match, f: Feistel, back: bool) -> str | None:
    parts = re.split(r"([-/.])", m[0])
    numbers = [int(x) for x in parts[::2]]
    orders = ["ymd"] if len(parts[0]) == 4 else ["dmy", "mdy"]
    for order in orders:
        at = {c: i for i, c in enumerate(order)}
        try:
            day = dt.date(numbers[at["y"]], numbers[at["m"]], numbers[at["d"]]).toordinal()
        except ValueError:
            continue
        if _FIRST_DAY <= day <= _LAST_DAY:
            new = dt.date.fromordinal(_FIRST_DAY + f.permute(day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, b"date", back))
            if order == "mdy" and new.day <= 12:
                # As text it would be read day first: walk on until it is not, so that it stays invertible.
                while new.day <= 12:
                    new = dt.date.fromordinal(_FIRST_DAY + f.permute(new.toordinal() - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, b"date", back))
            values = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            out = [values[c] for c in order]
            return out[0] + parts[1] + out[1] + parts[3] + out[2]
    return None


def _email(m: re.Match, f: Feistel, back: bool) -> str | None:
    return _characters(m[1], f, b"email" + m[2].lower().encode(), back) + "@" + m[2]


def _access_key(m: re.Match, f: Feistel, back: bool) -> str | None:
    return m[1] + _characters(m[2], f, b"key", back)


class Kind(NamedTuple):
    name: str
    pattern: re.Pattern
    pseudonym: Callable[[re.Match, Feistel, bool], str | None] | Run
    #: A character that every value of the kind has; texts without it are not searched.
    needs: str = ""


KINDS = (
    Kind("email", re.compile(r"(?<![\w.+-])([A-Za-z0-9][A-Za-z0-9._%+-]*)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"), _email, "@"),
    Kind("access_key", re.compile(r"(?<![A-Za-z0-9])(A[KS]IA)([0-9A-Z]{16})(?![A-Za-z0-9])"), _access_key, "IA"),
    Kind("access_key", re.compile(r"((?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s*[=:]\s*[\"']?)([A-Za-z0-9][^\s\"']{4,}[A-Za-z0-9])"), _access_key),
    Kind("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]*(?: [A-Z0-9]+(?![A-Za-z0-9]))*(?![A-Za-z0-9])"), Run(_iban_parts, _is_iban, _iban)),
    Kind("card", re.compile(r"(?<![\d.+-])\d+(?:[ -]\d+)*(?<=\d)"), Run(_printed_parts, _is_card, _card)),
    Kind("phone", re.compile(r"(?<![\w.+(-])(\+?1[ .-]?)?(\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-])"), _phone),
    Kind("phone", re.compile(r"(?<![\w.+-])(\+\d{1,3}[ .-]?)(\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4})(?![\w-])"), _phone, "+"),
    Kind("ssn", re.compile(r"(?<![\w-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"), _ssn, "-"),
    Kind("ipv4", re.compile(r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"), _ipv4, "."),
    Kind("date", re.compile(r"(?<![\w./-])(?:\d{4}([-/.])\d{2}\1\d{2}(?=T\d)|\d{4}([-/.])\d{2}\2\d{2}(?!\w|[./-]\d)|\d{2}([-/.])\d{2}\3\d{4}(?!\w|[./-]\d))"), _date),
    # Other parts after the kinds of a fixed layout: one in ten has a valid sum by chance.
    Kind("card", re.compile(r"(?<![\d.+-])\d+(?:[ -]\d+)*(?<=\d)"), Run(_card_parts, _is_card, _card)),
)


def findings(text: str, feistel: Feistel, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of each value, in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        if kind.needs and kind.needs not in text:
            continue
        before = [k for k in KINDS[:KINDS.index(kind)] if not isinstance(k.pseudonym, Run)]
        other = lambda piece, a, b: any(
            m.start() < b and m.end() > a and k.pseudonym(m, feistel, back) is not None for k in before for m in k.pattern.finditer(piece))
        free = lambda a, b: all(b <= s or a >= e for s, e, *_ in found)
        for m in kind.pattern.finditer(text):
            if isinstance(kind.pseudonym, Run):
                if m.end() - m.start() >= 13:
                    found += [(s, e, kind.name, new) for s, e, new in kind.pseudonym.values(m, feistel, back, free, other)]
            elif all(m.end() <= s or m.start() >= e for s, e, *_ in found):
                new = kind.pseudonym(m, feistel, back)
                if new is not None:
                    found.append((m.start(), m.end(), kind.name, new))
    return sorted(found)


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                   T.StructField("kind", T.StringType()), T.StructField("pseudonym", T.StringType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("pseudonym", pa.string())]))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "spans", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and ``spans_col``: places (code points of the old text), kinds
    and pseudonyms.  ``back=True`` inverts it with the same key."""
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() != spans_col.lower()]
    docs = docs.select(*[f"`{c}`" for c in names])
    schema = T.StructType([*docs.schema, T.StructField(spans_col, _SPANS)])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            for i, j in slices(batch.column(at), AT_ONCE):
                part = batch.slice(i, j - i)
                texts, spans = [], []
                for text in part.column(at).to_pylist():
                    found = findings(text, feistel, back) if text else []
                    texts.append(replaced(text, found) if found else text)
                    spans.append([{"start": s, "end": e, "kind": k, "pseudonym": p} for s, e, k, p in found])
                columns = [part.column(k) for k in range(len(names))]
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _ARROW_SPANS)], [*names, spans_col])

    return docs.mapInArrow(run, schema)
