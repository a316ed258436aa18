"""Personal data replaced by keyed permutations within the value's own format."""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

ROUNDS = 8
# Characters permuted as one number: 26 ** BLOCK keeps each half of a network below the 128 bits
# that a round adds.
BLOCK = 40


class Feistel:
    """Permutations of 0..n-1 under a key, for any n: a Feistel network over two halves of about
    the root of n, walked until it is back below n. No number is mapped to itself: a number goes
    through the network, one secret step further on the circle, and back through the network.
    """

    def __init__(self, key: bytes, kind: str, n: int):
        self.n = n
        self.a = max(2, math.isqrt(n - 1) + 1)
        self.b = -(-n // self.a)
        self.salt = f"{kind}:{n}:".encode()
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.step = 1 + self._f(ROUNDS, 0) % (n - 1) if n > 1 else 0

    def _f(self, k: int, half: int) -> int:
        data = self.salt + b"%d:%d" % (k, half)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for k in range(ROUNDS):
            if k % 2:
                right = (right + self._f(k, left)) % self.b
            else:
                left = (left + self._f(k, right)) % self.a
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                right = (right - self._f(k, left)) % self.b
            else:
                left = (left - self._f(k, right)) % self.a
        return left * self.b + right

    def _walk(self, step: Callable[[int], int], x: int) -> int:
        x = step(x)
        while x >= self.n:
            x = step(x)
        return x

    def apply(self, x: int) -> int:
        return self._walk(self._back, (self._walk(self._once, x) + self.step) % self.n)

    def undo(self, x: int) -> int:
        return self._walk(self._back, (self._walk(self._once, x) - self.step) % self.n)


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` and it pass the Luhn check."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 if k % 2 else 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


# Length of a country's IBANs.
IBAN_LENGTH = {c: int(n) for c, n in (x.split(":") for x in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 "
    "EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 "
    "IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 "
    "NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SE:24 SI:19 SK:24 SM:27 ST:25 TL:23 TN:24 TR:26 "
    "UA:29 VA:22 VG:24 XK:20").split())}


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")


class Pseudonyms:
    """replace(text) for one key. Values are validated first; what fails stays as it is."""

    def __init__(self, key: bytes, undo: bool = False):
        self.key, self.undo = key, undo
        self.network = functools.lru_cache(maxsize=4096)(lambda kind, n: Feistel(key, kind, n))
        self.kinds: list[tuple[re.Pattern, Callable[[re.Match], str | None]]] = [
            (re.compile(r"(?<![\w.+-])([A-Za-z0-9][\w.+-]*)@((?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![\w-])"), self._email),
            (re.compile(r"(?<![A-Za-z0-9])((?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9])"), self._access_key),
            (re.compile(r"""(?i)(?<![a-z0-9])((?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?)((?<=")[^"\n]{4,}(?=")|(?<=')[^'\n]{4,}(?=')|[^\s"']{4,})"""), self._secret),
            (re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), self._iban),
            (re.compile(r"(?<![\d.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\d|\.\d)"), self._ip),
            (re.compile(r"(?<![\w.-])(\d{4})-(\d{2})-(\d{2})(?![\w-])"), self._iso_date),
            (re.compile(r"(?<![\w./])(\d{1,2})([./])(\d{1,2})\2(\d{4})(?![\w/]|\.\d)"), self._date),
            (re.compile(r"(?<![\w-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"), self._ssn),
            (re.compile(r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"), self._card),
            (re.compile(r"(?<![\w.])(?:\+?1[ .-]?)?(?:\((\d{3})\) ?|(\d{3})[ .-])(\d{3})[ .-](\d{4})(?!\w|[.-]\d)"), self._phone),
            (re.compile(r"(?<![\w.])\+(?!1[ .(-])[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)"), self._foreign_phone),
        ]

    def _move(self, kind: str, n: int, x: int) -> int:
        f = self.network(kind, n)
        return f.undo(x) if self.undo else f.apply(x)

    def _mixed(self, kind: str, digits: list[tuple[int, int]]) -> list[int]:
        """Numbers below their own radix, permuted together."""
        x, n = 0, 1
        for value, radix in digits:
            x, n = x * radix + value, n * radix
        if n < 2:
            return [v for v, _ in digits]
        x, out = self._move(kind, n, x), []
        for _, radix in reversed(digits):
            x, v = divmod(x, radix)
            out.append(v)
        return out[::-1]

    def _characters(self, kind: str, text: str, hexadecimal: bool = False) -> str:
        """Digits become digits and letters letters of the same case; the rest stays.

        More than ``BLOCK`` of them are dealt into blocks of about equal length, each with
        permutations of its own place.
        """
        letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
        at = [k for k, c in enumerate(text) if c.isascii() and c.isalnum()]
        pairs = [(int(text[k]), 10) if text[k].isdigit() else (letters.index(text[k].lower()), len(letters)) for k in at]
        blocks = max(1, -(-len(at) // BLOCK))
        cuts = [len(at) * b // blocks for b in range(blocks + 1)]
        fresh = [v for b, (i, j) in enumerate(zip(cuts, cuts[1:]))
                 for v in self._mixed(f"{kind} block {b}" if b else kind, pairs[i:j])]
        out = list(text)
        for k, v, (_, radix) in zip(at, fresh, pairs):
            c = str(v) if radix == 10 else letters[v]
            out[k] = c.upper() if text[k].isupper() else c
        return "".join(out)

    def _digits(self, kind: str, text: str, first: int = 0, last: int = 0) -> str:
        """The digits of ``text`` but the first and last few, permuted as one number."""
        at = [k for k, c in enumerate(text) if c.isdigit()]
        at = at[first:len(at) - last]
        out = list(text)
        for k, v in zip(at, self._mixed(kind, [(int(text[k]), 10) for k in at])):
            out[k] = str(v)
        return "".join(out)

    def _email(self, m):
        return f"{self._characters('email', m[1])}@{m[2]}"

    def _access_key(self, m):
        return m[1][:4] + self._characters("access key", m[1][4:])

    def _hidden(self, value: str) -> str:
        """Hexadecimal values are permuted among themselves, the others until the image is no
        hexadecimal value either: so no two values share one, and each knows its way back."""
        if _HEXADECIMAL.fullmatch(value):
            return self._characters("secret", value, True)
        out = self._characters("secret", value)
        while _HEXADECIMAL.fullmatch(out):
            out = self._characters("secret", out)
        return out

    def _secret(self, m):
        if not any(c.isascii() and c.isalnum() for c in m[2]):
            return None
        return m[1] + self._hidden(m[2])

    def _around(self, m, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
        """What a secret has before, between and after values of other kinds, each replaced."""
        edges = [m.start(2), *[x for span in sorted(taken) for x in span], m.end(2)]
        gaps = [(a, b, m.string[a:b]) for a, b in zip(edges[::2], edges[1::2]) if a < b]
        return [(a, b, self._hidden(t)) for a, b, t in gaps if any(c.isascii() and c.isalnum() for c in t)]

    def _iban(self, m):
        """An IBAN at the start of the match, which may run on into words that follow: it ends at
        a space or where the match does. The country's length comes first, then the longest."""
        text = m[0]
        ends = [len(text), *[k for k in range(len(text) - 1, 0, -1) if text[k] == " "]]
        known = IBAN_LENGTH.get(text[:2])
        if known:
            ends = [k for k in ends if k - text.count(" ", 0, k) == known] + ends[:1]
        for k in ends:
            plain = text[:k].replace(" ", "")
            country, check, rest = plain[:2], plain[2:4], plain[4:]
            if 15 <= len(plain) <= 34 and _iban_check(country, rest) == check:
                rest = self._characters("iban " + country, rest)
                fresh = iter(country + _iban_check(country, rest) + rest)
                return "".join(c if c == " " else next(fresh) for c in text[:k])
        return None

    def _ip(self, m):
        parts = [int(x) for x in m.groups()]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m.groups()):
            return None
        return ".".join(map(str, self._mixed("ip", [(p, 256) for p in parts])))

    def _day(self, year: str, month: str, day: str, after: int = 0) -> datetime.date | None:
        """The date permuted, among those beyond day ``after`` of their month."""
        try:
            x = datetime.date(int(year), int(month), int(day)).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= x < _DAYS:
            return None
        while True:
            x = self._move("date", _DAYS, x)
            moved = datetime.date.fromordinal(_FIRST_DAY + x)
            if moved.day > after:
                return moved

    def _iso_date(self, m):
        day = self._day(m[1], m[2], m[3])
        return day and day.isoformat()

    def _date(self, m):
        """Day first; month first where that alone makes a date. The pseudonym is written with
        the same order and separators, and two digits each. Month-first dates have a day beyond
        12, and so do their pseudonyms: the reading stays the same."""
        day, sep = self._day(m[4], m[3], m[1]), m[2]
        if day:
            return f"{day.day:02d}{sep}{day.month:02d}{sep}{day.year}"
        day = self._day(m[4], m[1], m[3], after=12) if int(m[3]) > 12 else None
        return day and f"{day.month:02d}{sep}{day.day:02d}{sep}{day.year}"

    def _ssn(self, m):
        area, group, serial = (int(x) for x in m.groups())
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        # 898 areas without 666, 99 groups, 9999 serials.
        a, g, s = self._mixed("ssn", [(area - 1 - (area > 666), 898), (group - 1, 99), (serial - 1, 9999)])
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"

    def _card(self, m):
        digits = re.sub(r"\D", "", m[0])
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        fresh = self._digits("card " + digits[0], digits, first=1, last=1)[:-1]
        fresh, out = iter(fresh + luhn_digit(fresh)), ""
        for c in m[0]:
            out += next(fresh) if c.isdigit() else c
        return out

    def _phone(self, m):
        area, exchange, line = m[1] or m[2], m[3], m[4]
        if area[0] in "01" or exchange[0] in "01":
            # No number of the plan; told apart from other digits only by its form.
            if m[1] is None and not m[0].startswith("+"):
                return None
            a, e, n = self._unplanned(int(area), int(exchange), int(line))
        else:
            a, e, n = self._mixed("phone", [(int(area) - 200, 800), (int(exchange) - 200, 800), (int(line), 10000)])
            a, e = a + 200, e + 200
        head, between = m[0][:m.start(1 if m[1] else 2) - m.start()], m[0]
        base = m.start()
        return (head + f"{a:03d}" + between[m.end(1 if m[1] else 2) - base:m.start(3) - base]
                + f"{e:03d}" + between[m.end(3) - base:m.start(4) - base] + f"{n:04d}")

    def _unplanned(self, area: int, exchange: int, line: int) -> tuple[int, int, int]:
        """Ten digits that are no plan number, among themselves: moved until they are none again."""
        while True:
            area, exchange, line = self._mixed("ten digits", [(area, 1000), (exchange, 1000), (line, 10000)])
            if area < 200 or exchange < 200:
                return area, exchange, line

    def _foreign_phone(self, m):
        n = sum(c.isdigit() for c in m[0])
        if not 8 <= n <= 15:
            return None
        return self._digits("phone " + str(n), m[0], first=2)

    def _matches(self, pattern, change, text: str):
        """(match, its end, pseudonym or None). An IBAN may take less than the match: the rest,
        and a failed match but its first character, are looked at again."""
        if change != self._iban:
            yield from ((m, m.end(), None) for m in pattern.finditer(text))
            return
        m = pattern.search(text)
        while m:
            fresh = change(m)
            end = m.start() + len(fresh) if fresh else m.start() + 1
            if fresh:
                yield m, end, fresh
            m = pattern.search(text, end)

    def replace(self, text: str) -> tuple[str, int]:
        """The text with every value replaced, and how many were."""
        found: list[tuple[int, int, str]] = []
        for k, (pattern, change) in enumerate(self.kinds):
            if k == 0 and "@" not in text:
                continue
            for m, end, fresh in self._matches(pattern, change, text):
                # Kinds come in order of precedence: no value is replaced twice.
                first = bisect.bisect_left(found, (m.start(),))
                first -= first > 0 and found[first - 1][1] > m.start()
                last = bisect.bisect_left(found, (end,))
                taken = [(a, b) for a, b, _ in found[first:last]]
                if taken:
                    if change == self._secret:
                        for part in self._around(m, taken):
                            bisect.insort(found, part)
                    continue
                fresh = fresh or change(m)
                if fresh is not None:
                    found.insert(first, (m.start(), end, fresh))
        if not found:
            return text, 0
        out, at = [], 0
        for a, b, fresh in found:
            out += (text[at:a], fresh)
            at = b
        return "".join(out) + text[at:], len(found)


# What every pattern needs: a digit, an @, the name of a secret, or the beginning of an access key.
_MAY_HOLD = re.compile(r"[0-9@]|AKIA|ASIA|(?i:passw|pwd|token|secret|key)")


def pseudonymize(docs: DataFrame, key: str, *, counted: bool = False, undo: bool = False) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; ``counted`` adds n_replaced (long).

    Kinds: e-mail addresses (local part), access keys, passwords and tokens after their name,
    IBANs (mod 97), IPv4 addresses, calendar dates from 1900 to 2099, US social security numbers,
    payment cards (Luhn), North American and +country phone numbers. Values of any length are
    replaced whole (quoted secrets up to the closing quote), long ones in blocks of ``BLOCK`` characters at most; equal blocks at the same
    place of equally long values get equal pseudonyms. A secret that holds an address or access
    key has that replaced as such and the rest around it as a secret. Equal values become equal
    pseudonyms everywhere, whatever separators they are written with; formats, separators and
    check digits hold; no value stays itself. The key holder can undo it, value by value (a date
    written with one-digit parts comes back with two).

    Null text stays null. Rows, other columns and their order are untouched, so repeated rows
    stay equal; an empty table stays empty. No row leaves its task.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    if not key:
        raise ValueError("a key is needed: under a known key anyone can undo the pseudonyms")
    secret = key.encode()
    extra = ", n_replaced long" if counted else ""
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def change(batches):
        hide = Pseudonyms(secret, undo).replace
        for batch in batches:
            done = [(t, 0) if t is None or not _MAY_HOLD.search(t) else hide(t)
                    for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], batch.schema.field(at).type)
            names = list(batch.schema.names)
            if counted:
                columns.append(pa.array([n for _, n in done], pa.int64()))
                names.append("n_replaced")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(change, schema + extra)
