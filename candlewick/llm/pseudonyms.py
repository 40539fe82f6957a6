"""Format-preserving pseudonyms for personal data.

Found values are permuted by a keyed Feistel network over exactly the values
of their format, so a pseudonym has the same shape and is valid again, equal
values get equal pseudonyms in every document, and the key's holder can
invert them.

* payment cards (13-19 digits, optional single blanks or dashes, Luhn-valid):
  all digits but the check digit are permuted, the check digit is computed
* IBANs (mod-97-valid): letters and digits of the account part are permuted in
  place, the check digits are computed
* national ids ``ddd-dd-dddd`` with a valid area, group and serial
* telephone numbers with a country code or an area code in parentheses: the
  digits after the country code
* IPv4 addresses: the four octets as one number
* dates ``yyyy-mm-dd`` (or ``/``), ``dd.mm.yyyy``, ``dd/mm/yyyy`` and
  ``mm/dd/yyyy`` (read day first if both fit) of 1900-2099: the day, so the
  same date links across notations; days of the month above 12 stay above 12,
  so a month-first date is read back as one. A day or month of one digit keeps
  that width (such a date is walked on to one that fits, and need not link to
  its two-digit notation)
* e-mail addresses: letters and digits in place; the top-level domain stays

Numbers, codes or dates beside a value do not hide it: each start and each
end at a separator is checked, the longest first. A value that its format's
check rejects is left alone. A pseudonym that would be read together with its
neighbours is walked on to one that is not; only such a value need not link.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from candlewick.llm.common import hidden, position
from candlewick.session import ship_package

ROUNDS = 10
KINDS = ("email", "iban", "date", "ssn", "ip", "phone", "card")
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to 2099-12-31

#: Shapes to check; digits that continue a longer number are not taken.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}(?P<ymd>[-/])[0-9]{2}(?P=ymd)[0-9]{2}|[0-9]{1,2}(?P<dmy>[./])[0-9]{1,2}(?P=dmy)[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,5}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
SHAPES = re.compile("|".join(f"(?:{FORMS[k]})" for k in KINDS))
FORM = {k: re.compile(v) for k, v in FORMS.items()}
#: Kinds whose shape may take in the words or numbers that follow.
OPEN_ENDED = ("iban", "phone", "card")
#: The groupings that cards are printed in.
PRINTED_CARD = re.compile(
    r"(?<![0-9+])(?:[0-9]{13,19}|[0-9]{4}(?P<four>[ -])[0-9]{4}(?P=four)[0-9]{4}(?P=four)[0-9]{4}(?:(?P=four)[0-9]{1,3})?|[0-9]{4}(?P<six>[ -])[0-9]{6}(?P=six)[0-9]{4,5})(?![0-9])"
)
REACH = 150  # longer than any candidate but an e-mail address, whose shape has no further check
LONGEST = 700  # longer than any candidate

def luhn_total(digits: str) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


class Feistel:
    """Keyed permutation of 0 .. size-1: an alternating Feistel network over
    two residues, walked until the result is in range."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, number: int, value: int, modulus: int) -> int:
        data = f"{tweak}|{number}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big") % modulus

    def permute(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        if size <= 1:
            return value
        a = 1
        while a * a < size:
            a += 1 if size < 1 << 20 else max(1, a)  # a coarse root is enough: a * b >= size
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if n % 2 == 0:
                    left = (left + sign * self._round(tweak, n, right, a)) % a
                else:
                    right = (right + sign * self._round(tweak, n, left, b)) % b
            value = left * b + right
            if value < size:
                return value

    def within(self, value: int, size: int, tweak: str, valid: Callable[[int], bool], back: bool = False) -> int:
        """Permutation of the valid values: walks on until one is reached."""
        while True:
            value = self.permute(value, size, tweak, back)
            if valid(value):
                return value


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its ASCII letters and digits replaced in order."""
    new = iter(chars)
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in shape)


def _mixed(text: str) -> tuple[int, int]:
    """A string of letters and digits as a number in the mixed radix of its
    character classes, and the number of such strings."""
    value, size = 0, 1
    for c in text:
        radix, at = (10, int(c)) if c.isdigit() else (26, ord(c.lower()) - 97)
        value, size = value * radix + at, size * radix
    return value, size


def _unmixed(value: int, like: str) -> str:
    out = []
    for c in reversed(like):
        value, at = divmod(value, 10 if c.isdigit() else 26)
        out.append(str(at) if c.isdigit() else chr((97 if c.islower() else 65) + at))
    return "".join(reversed(out))


def _calendar(text: str) -> tuple[datetime.date, str] | None:
    """The day and its strftime layout."""
    a, sep, b, _, c = re.match(r"([0-9]+)([./-])([0-9]+)([./-])([0-9]+)", text).groups()
    layouts = [f"%Y{sep}%m{sep}%d"] if len(a) == 4 else [f"%d{sep}%m{sep}%Y", *([f"%m{sep}%d{sep}%Y"] if sep == "/" else [])]
    for layout in layouts:
        try:
            day = datetime.datetime.strptime(text, layout).date()
        except ValueError:
            continue
        if 0 <= day.toordinal() - FIRST_DAY < DAYS:
            return day, layout
    return None


def _ssn_fine(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


class Pseudonymiser:
    def __init__(self, key: str):
        self.net = Feistel(hashlib.blake2b(key.encode(), digest_size=32).digest())
        self.cached = lru_cache(maxsize=100_000)(self._replace)

    def _replace(self, kind: str, text: str, back: bool) -> str | None:
        return getattr(self, "_" + kind)(text, back)

    def _card(self, text: str, back: bool) -> str | None:
        digits = re.sub("[ -]", "", text)
        if luhn_total(digits) % 10 or len(set(digits)) == 1:
            return None
        n = len(digits) - 1
        fine = lambda v: v > 0  # noqa: E731  not only zeros
        body = str(self.net.within(int(digits[:n]), 10**n, f"card{n}", fine, back)).zfill(n)
        return _refill(text, body + str(-luhn_total(body + "0") % 10))

    def _iban(self, text: str, back: bool) -> str | None:
        plain = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or not 2 <= int(plain[2:4]) <= 98 or number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        value, size = _mixed(plain[4:])
        shape = re.sub("[0-9]", "0", re.sub("[A-Z]", "A", plain[4:]))
        body = _unmixed(self.net.permute(value, size, "iban" + plain[:2] + shape, back), plain[4:])
        return _refill(text, f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")

    def _date(self, text: str, back: bool) -> str | None:
        found = _calendar(text)
        if found is None:
            return None
        day, layout = found
        order = [c for c in layout if c in "dmY"]
        width = dict(zip(order, map(len, re.findall("[0-9]+", text))))

        def same_form(n: int) -> bool:
            other = datetime.date.fromordinal(FIRST_DAY + n)
            fits = (width["d"] > 1 or other.day < 10) and (width["m"] > 1 or other.month < 10)
            return fits and (other.day > 12) == (day.day > 12)  # reads day first or month first as before

        moved = datetime.date.fromordinal(FIRST_DAY + self.net.within(day.toordinal() - FIRST_DAY, DAYS, "date", same_form, back))
        value = {"d": moved.day, "m": moved.month, "Y": moved.year}
        numbers = iter([f"{value[c]:0{width[c]}d}" for c in order])
        return re.sub("[0-9]+", lambda _: next(numbers), text)

    def _ssn(self, text: str, back: bool) -> str | None:
        value = int(text.replace("-", ""))
        return _refill(text, f"{self.net.within(value, 10**9, 'ssn', _ssn_fine, back):09d}") if _ssn_fine(value) else None

    def _ip(self, text: str, back: bool) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(x != "0" and x.startswith("0") for x in text.split(".")):
            return None
        moved = self.net.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, moved.to_bytes(4, "big")))

    def _phone(self, text: str, back: bool) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        country = re.match(r"\+([0-9]{1,3}?)(?=[ .(-])|\+(1)|\+([0-9]{2})", text)
        code = next(filter(None, country.groups()), "") if country else ""
        rest = digits[len(code) :]
        if not 6 <= len(rest) <= 12 or len(digits) > 15:
            return None
        n, american = len(rest), len(rest) == 10 and code in ("", "1")
        fine = lambda v: not american or (v // 10**9 >= 2 and v // 10**6 % 10 >= 2)
        if not fine(int(rest)):
            return None
        tweak = f"phone1/{n}" if american else f"phone{code}/{n}"
        return _refill(text, code + str(self.net.within(int(rest), 10**n, tweak, fine, back)).zfill(n))

    def _email(self, text: str, back: bool) -> str | None:
        head, _, top = text.rpartition(".")
        plain = "".join(c for c in head if c.isalnum())
        value, size = _mixed(plain.lower())
        shape = re.sub("[0-9]", "0", re.sub("[A-Za-z]", "a", head))
        return _refill(head, _unmixed(self.net.permute(value, size, "email" + shape, back), plain)) + "." + top

    def _ends(self, kind: str, text: str, start: int) -> Iterator[int]:
        """Where a candidate of this shape may end: the longest first, then
        before each separator inside it."""
        m = FORM[kind].match(text, start)
        if m is None:
            return
        yield m.end()
        if kind in OPEN_ENDED:
            for end in range(m.end() - 1, start, -1):
                if text[end] in " .-(" and text[end - 1] not in " .-(" and FORM[kind].fullmatch(text, start, end):
                    yield end

    def _inside(self, kind: str, text: str, start: int, longest: int, back: bool) -> list[tuple[int, int]]:
        """Valid dates (and cards as printed, unless this is one) that start
        inside a candidate."""
        own = kind == "card" and PRINTED_CARD.match(text, start)
        out = []
        for p in range(start + 1, longest):
            if text[p - 1] not in " .-)" or not text[p].isdigit():
                continue
            m = FORM["date"].match(text, p)
            if m and self.cached("date", m.group(), back) is not None:
                out.append((p, m.end()))
            elif not own and (m := PRINTED_CARD.match(text, p)):
                ends = [e for e in self._ends("card", text, p) if e <= m.end()]
                out += [(p, e) for e in ends if PRINTED_CARD.fullmatch(text, p, e) and self.cached("card", text[p:e], back) is not None][:1]
        return out

    def _candidates(self, kind: str, text: str, start: int, back: bool) -> Iterator[int]:
        """Ends in the order they are tried. A phone or card cuts through no
        date or card that starts inside it; a phone that holds a whole one
        comes last, a card that holds one is none."""
        ends = list(self._ends(kind, text, start))
        if kind not in ("phone", "card") or not ends:
            yield from ends
            return
        inside = self._inside(kind, text, start, ends[0], back)
        whole = []
        for end in ends:
            held = [q for p, q in inside if p < end]
            if not held:
                yield end
            elif kind == "phone" and max(held) <= end:
                whole.append(end)
        yield from whole

    def _next(self, text: str, at: int, back: bool) -> tuple[str, int, int] | None:
        """The first valid value from ``at`` on: kind, start and end. After a
        start without one the search goes on at the next token."""
        while m := SHAPES.search(text, at):
            start = m.start()
            for kind in KINDS:
                for end in self._candidates(kind, text, start, back):
                    if self.cached(kind, text[start:end], back) is not None:
                        return kind, start, end
            at = start + 1
        return None

    def _same_reading(self, parts: list[str], kinds: list[str], n: int, back: bool) -> bool:
        """Whether value ``n`` and those just before it are found again as
        they are. ``parts`` are the gaps and values in turn."""
        left = 2 * n
        size = len(parts[left])
        while left and size < REACH:
            left -= 2
            size += len(parts[left]) + len(parts[left + 1])
        gap, before = parts[left], parts[left - 1][-1:] if left else ""
        if len(gap) > REACH:
            gap, before = gap[-REACH:], gap[-REACH - 1]
        right, size = [], 0
        for part in parts[2 * n + 2 :]:
            right.append(part[:LONGEST])
            size += len(right[-1])
            if size >= LONGEST:
                break
        text = "".join([before, gap, *parts[left + 1 : 2 * n + 2], *right])
        at = len(before)
        start = at + len(gap)
        for i in range(left // 2, n + 1):
            end = start + len(parts[2 * i + 1])
            if self._next(text, at, back) != (kinds[i], start, end):
                return False
            at, start = end, end + len(parts[2 * i + 2])
        return True

    def rewrite(self, text: str, back: bool = False) -> tuple[str, dict[str, int]]:
        """The text with every valid value replaced, and how many by kind.
        Invalid candidates stay.

        A pseudonym beside other digits or capitals could be read with them as
        another value; it is walked on to one that is read alone, so the
        values found in the new text are those replaced and can be inverted
        (last one first).
        """
        counts: dict[str, int] = {}
        parts, kinds, at = [], [], 0
        while found := self._next(text, at, back):
            kind, start, end = found
            parts += [text[at:start], text[start:end]]
            kinds.append(kind)
            counts[kind] = counts.get(kind, 0) + 1
            at = end
        parts.append(text[at:])
        for n in reversed(range(len(kinds))) if back else range(len(kinds)):
            while True:
                parts[2 * n + 1] = self.cached(kinds[n], parts[2 * n + 1], back)
                if self._same_reading(parts, kinds, n, back):
                    break
        return "".join(parts), counts

@lru_cache(maxsize=2)
def _tool(key: str) -> Pseudonymiser:
    return Pseudonymiser(key)


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """All columns of ``docs`` (hidden names ``_inN``) with the text rewritten,
    plus ``n_values`` and one count per kind. ``back=True`` inverts.

    A null text stays null, with counts 0; rows are independent, so the map
    needs no shuffle. Texts without a digit or ``@`` pass as they are; very long
    ones are rewritten whole, repeated rows alike, an empty table gives an empty
    result, and extra columns are passed through, whatever their names. Of
    values that overlap, the one that starts first is replaced.
    """
    ship_package(docs.sparkSession)
    raw, names = hidden(docs)
    text, at = position(names, text_col), names.index(text_col) if text_col in names else int(position(names, text_col)[3:])
    extra = ["n_values", *(f"n_{k}" for k in KINDS)]
    schema = T.StructType([*raw.schema.fields, *(T.StructField(c, T.LongType()) for c in extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _tool(key)
        for batch in batches:
            column = batch.column(text)
            mask = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
            done = [tool.rewrite(t, back) for t in column.filter(mask).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pc.replace_with_mask(column, mask, pa.array([t for t, _ in done], column.type))
            none: dict[str, int] = {}
            told = iter(done)
            counts = [next(told)[1] if m else none for m in mask.to_pylist()]
            columns.append(pa.array([sum(c.values()) for c in counts], pa.int64()))
            columns += [pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return raw.mapInArrow(run, schema)
