"""Personal data: format-preserving Feistel pseudonyms for validated numbers, dates and addresses.

Values are found by their shape and then validated: card numbers (Luhn), telephone numbers (+ and country
code, or the North American plan), IPv4 addresses, US social security numbers (issued ranges), IBANs
(modulo 97), calendar dates and e-mail addresses. Where a shape fails validation, shorter readings of it
and the other kinds are tried at its spaces, so a number beside another is found; what then fails stays.

Each value is numbered within the domain of its format, permuted there by a keyed Feistel network and
written back in the same format: separators, sign and length classes stay, check digits are computed
anew, a date stays a date. The permutation depends on the kind and the value alone, so equal values get
equal pseudonyms in every document, also across separators and, for dates, across notations; different
values of a kind get different ones, whatever stands beside them. Numbers that can't be such a value in the
result (no Luhn digit, unissued ranges) are stepped over by walking the permutation's cycle. The permutation of a
value is undone exactly by ``restore`` with the same key. A text is undone exactly where its pseudonyms are
read again as they were written; where further groups of digits stand beside a number with only spaces or signs between, a
pseudonym may come to look valid together with a neighbour, and that place isn't undone (the README has the rate).

The key is a secret of the caller (``key``); the default is for tests only. Defined results: NULL text
stays NULL, empty text empty. Nothing is shuffled, whole texts are scanned once, each on its own.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = b"replace this key outside tests"
ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
KINDS = ["card", "phone", "ip", "ssn", "iban", "date", "email"]
RESULT = T.StructType([T.StructField("text", T.StringType()), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS]])


def feistel(x: int, size: int, key: bytes, tweak: str, back: bool = False, fits: Callable[[int], bool] | None = None) -> int:
    """A keyed permutation of the numbers below ``size`` (of those that fit, if ``fits`` is given): two
    halves, each round adds a keyed digest of one to the other; results outside are permuted again."""
    left, right = math.isqrt(size - 1) + 1, 0
    right = -(-size // left)

    def digest(i: int, half: int) -> int:
        told = f"{tweak}|{size}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(told, key=key, digest_size=16).digest(), "big")

    while True:
        a, b = divmod(x, right)
        for i in range(ROUNDS) if not back else reversed(range(ROUNDS)):
            sign = -1 if back else 1
            if i % 2 == 0:
                a = (a + sign * digest(i, b)) % left
            else:
                b = (b + sign * digest(i, a)) % right
        x = a * right + b
        if x < size and (fits is None or fits(x)):
            return x


def luhn_digit(digits: str) -> int:
    """The digit that completes ``digits`` to a valid number."""
    doubled = [int(c) * 2 for c in digits[::-1][::2]]
    return -(sum(d - 9 if d > 9 else d for d in doubled) + sum(map(int, digits[::-1][1::2]))) % 10


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    own = iter(digits)
    return "".join(next(own) if c.isdigit() else c for c in shape)


def _digits(value: str) -> str:
    return "".join(c for c in value if c in "0123456789")


def _card(value: str, key: bytes, back: bool) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn_digit(d[:-1]) != int(d[-1]):
        return None
    n = len(d) - 2  # the issuer's first digit stays, the last is the check digit
    body = d[0] + str(feistel(int(d[1:-1]), 10**n, key, f"card{d[0]}", back)).zfill(n)
    return _refill(value, body + str(luhn_digit(body)))


def _american(x: int) -> bool:
    """Ten digits of the North American plan: area and exchange begin with 2 to 9."""
    return x // 10**9 >= 2 and x // 10**6 % 10 >= 2


def _phone(value: str, key: bytes, back: bool) -> str | None:
    d = _digits(value)
    if (len(d) == 11 and d[0] == "1") or (len(d) == 10 and not value.startswith("+")):
        # +1 tells a telephone number also where the plan has no such area or exchange
        if not value.startswith("+") and not _american(int(d[-10:])):
            return None
        # the exchange stays (555 is kept out of use); the area code and the line are permuted
        exchange = int(d[-7:-4])
        if d[-10] in "01":  # an area outside the plan stays outside, with its first digit
            x = feistel(int(d[-9:-7] + d[-4:]), 10**6, key, f"phone{d[-10]} {exchange}", back)
            return _refill(value, d[:-9] + f"{x // 10**4:02d}{exchange:03d}{x % 10**4:04d}")
        x = feistel(int(d[-10:-7] + d[-4:]), 10**7, key, f"phone{exchange}", back, lambda v: v // 10**6 >= 2)
        area, line = divmod(x, 10**4)
        return _refill(value, d[:-10] + f"{area:03d}{exchange:03d}{line:04d}")
    if not value.startswith("+") or not 8 <= len(d) <= 15 or d[0] in "01":
        return None
    n = len(d) - 3  # the country code and the first digit after it stay
    return _refill(value, d[:3] + str(feistel(int(d[3:]), 10**n, key, f"phone{d[:3]}", back)).zfill(n))


def _ip(value: str, key: bytes, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, key, "ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _issued(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(value: str, key: bytes, back: bool) -> str | None:
    x = int(_digits(value))
    return _refill(value, f"{feistel(x, 10**9, key, 'ssn', back, _issued):09d}") if _issued(x) else None


def _iban_check(country: str, account: str) -> str:
    told = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(told) % 97:02d}"


def _alike(value: str, key: bytes, tweak: str, back: bool) -> str:
    """Letters and digits (ASCII) permuted as one number, each place within its class; the rest stays."""
    bases = [10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 0 for c in value]
    x, size = 0, 1
    for c, base in zip(value, bases, strict=True):
        if base:
            x, size = x * base + (ord(c) - 48 if base == 10 else ord(c.lower()) - 97), size * base
    x = feistel(x, size, key, tweak, back)
    out = []
    for c, base in zip(reversed(value), reversed(bases), strict=True):
        if base:
            x, k = divmod(x, base)
            new = chr(48 + k) if base == 10 else chr(97 + k)
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(reversed(out))


def _iban(value: str, key: bytes, back: bool) -> str | None:
    flat = value.replace(" ", "")
    country, account = flat[:2], flat[4:]
    if not 15 <= len(flat) <= 34 or int("".join(str(int(c, 36)) for c in account + flat[:4])) % 97 != 1:
        return None
    if flat[2:4] != _iban_check(country, account):
        return None
    account = _alike(account, key, f"iban{country}", back)
    own = iter(country + _iban_check(country, account) + account)
    return "".join(c if c == " " else next(own) for c in value)


def _permuted_day(day: dt.date, key: bytes, back: bool, fits: Callable[[dt.date], bool] | None = None) -> dt.date | None:
    if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
        return None
    size = LAST_DAY - FIRST_DAY + 1
    x = feistel(day.toordinal() - FIRST_DAY, size, key, "date", back, fits and (lambda v: fits(dt.date.fromordinal(FIRST_DAY + v))))
    return dt.date.fromordinal(FIRST_DAY + x)


def _date(value: str, key: bytes, back: bool) -> str | None:
    first, sep, second, _, third = re.split(r"([-/.])", value)
    orders = ["ymd"] if len(first) == 4 else ["dmy"] if sep == "." else ["mdy", "dmy"]
    for order in orders:
        own = dict(zip(order, (first, second, third), strict=True))
        try:
            found = dt.date(int(own["y"]), int(own["m"]), int(own["d"]))
        except ValueError:
            continue
        bare = min(len(own["m"]), len(own["d"])) == 1  # numbers below ten are written without a zero

        def fits(day: dt.date, order: str = order, own: dict = own, bare: bool = bare) -> bool:
            # the result must be read in the same order and written in the same widths
            if order == "dmy" and sep != "." and day.day <= 12:
                return False
            return not bare or (len(str(day.month)), len(str(day.day))) == (len(own["m"]), len(own["d"]))

        new = _permuted_day(found, key, back, fits)
        if new is None:
            continue
        two = "" if bare else "02"
        told = {"y": f"{new.year:04d}", "m": f"{new.month:{two}}", "d": f"{new.day:{two}}"}
        return sep.join(told[c] for c in order)
    return None


#: English names of the months.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _named_date(value: str, key: bytes, back: bool) -> str | None:
    """``March 7, 1987`` or ``7 March 1987``; a name shortened to three letters stays so."""
    name, day, year = re.search(r"[A-Za-z]+", value)[0], *(re.findall(r"[0-9]+", value))
    short = len(name) == 3
    month = next((i for i, m in enumerate(MONTHS, 1) if name.lower() in (m.lower(), m[:3].lower())), None)
    try:
        found = dt.date(int(year), month, int(day))
    except (TypeError, ValueError):
        return None
    # widths and the kind of name stay, so that the result is read the same way (May is short and long)
    new = _permuted_day(found, key, back, lambda d: len(str(d.day)) == len(day.lstrip("0")) and (short or d.month != 5))
    if new is None:
        return None
    told = MONTHS[new.month - 1][:3] if short else MONTHS[new.month - 1]
    told = told.upper() if name.isupper() else told.lower() if name.islower() else told
    out = value.replace(name, "\0", 1).replace(year, "\1", 1).replace(day, f"{new.day:0{len(day)}d}", 1)
    return out.replace("\0", told).replace("\1", f"{new.year:04d}")


def _email(value: str, key: bytes, back: bool) -> str | None:
    local, _, domain = value.rpartition("@")
    return f"{_alike(local, key, 'email@' + domain.lower(), back)}@{domain}" if any(c.isalnum() for c in local) else None


_START, _END = r"(?<!\w)(?<!\d[.,/:-])", r"(?!\w)(?![.,/:-]\d)"
_MONTH = "(?i:" + "|".join(f"{m}|{m[:3]}" for m in MONTHS) + ")"
_SHAPE = {
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:[ ][A-Z0-9]{4}){2,7}(?:[ ][A-Z0-9]{1,4})?)(?!\w)",
    "date": rf"{_START}(?:[0-9]{{4}}(?P<s1>[-/.])[0-9]{{2}}(?P=s1)[0-9]{{2}}|[0-9]{{1,2}}(?P<s2>[-/.])[0-9]{{1,2}}(?P=s2)[0-9]{{4}}){_END}",
    "named": rf"{_START}(?:(?:{_MONTH})\.?[ ][0-9]{{1,2}}(?:st|nd|rd|th)?,?[ ][0-9]{{4}}|[0-9]{{1,2}}[ ](?:{_MONTH})[ ][0-9]{{4}}){_END}",
    "ip": rf"{_START}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_END}",
    "ssn": rf"{_START}[0-9]{{3}}(?P<s3>[- ])[0-9]{{2}}(?P=s3)[0-9]{{4}}{_END}",
    "card": rf"{_START}(?:[0-9]{{13,19}}|[0-9]{{4}}(?P<s4>[ -])[0-9]{{4}}(?P=s4)[0-9]{{4}}(?P=s4)[0-9]{{1,7}}|[0-9]{{4}}(?P<s5>[ -])[0-9]{{6}}(?P=s5)[0-9]{{5}}){_END}",
    "phone": rf"""(?<![\w+])(?:\+?1[ .-]?)?(?:\([0-9]{{3}}\)[ ]?|(?<![\d(])[0-9]{{3}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}}{_END}
        |(?<![\w+])\+1[0-9]{{10}}{_END}
        |(?<![\w+])\+[2-9][0-9]{{0,2}}(?:[ .-]?\(?[0-9]{{1,4}}\)?){{2,6}}{_END}""",
}
_EACH = {kind: re.compile(shape, re.VERBOSE | re.ASCII) for kind, shape in _SHAPE.items()}
_SHAPES = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape in _SHAPE.items()), re.VERBOSE | re.ASCII)
_EMAIL = re.compile(r"(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,63})@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?!\w)")
_HINT = re.compile(r"[0-9]")
_BY = {"card": _card, "phone": _phone, "ip": _ip, "ssn": _ssn, "iban": _iban, "date": _date, "named": _named_date}


@lru_cache(maxsize=1 << 14)
def _replacement(kind: str, value: str, key: bytes, back: bool) -> str | None:
    return (_email if kind == "email" else _BY[kind])(value, key, back)


def _readings(part: str, kind: str, start: int, stop: int) -> Iterator[re.Match]:
    """The matches of a kind's shape at ``start``: the longest, then those that end before a space in it."""
    while stop > start and (m := _EACH[kind].match(part, start, stop)):
        yield m
        stop = part.rfind(" ", start, m.end())


def _within(part: str, failed: re.Match, replaced: Callable[[str, str], str | None]) -> tuple[list[tuple[int, int, str, str]], int]:
    """The valid values ``(start, end, kind, new)`` that begin at a space in a shape that failed validation, and
    where to go on. A telephone number has no check digits, so it gets what the first other value leaves."""
    starts = [failed.start(), *(k + 1 for k in range(failed.start(), failed.end()) if part[k] == " ")]

    def first(start: int, kinds: list[str], stop: int) -> tuple[int, int, str, str] | None:
        tried = ((m, kind, replaced(kind, m[0])) for kind in kinds for m in _readings(part, kind, start, stop))
        return next(((start, m.end(), kind, new) for m, kind, new in tried if new is not None), None)

    other = next((v for start in starts if (v := first(start, [k for k in _EACH if k != "phone"], len(part)))), None)
    if other is None:  # two telephone numbers
        other = next((v for start in starts[1:] if (v := first(start, ["phone"], len(part))) and first(starts[0], ["phone"], start)), None)
    values, at = [], failed.start()
    for start in starts:
        if start >= at and (other is None or start < other[0]):
            if phone := first(start, ["phone"], other[0] if other else len(part)):
                values.append(phone)
                at = phone[1]
                if other is None:
                    break
    values += [other] if other else []
    return values, values[-1][1] if values else failed.end()


def _crossing(part: str, phone: re.Match) -> list[tuple[int, re.Match, str]]:
    """Shapes that begin at a space in a number with a country code, whose length is free, and end after it."""
    if phone[0][0] != "+":
        return []
    starts = [k + 1 for k in range(phone.start(), phone.end()) if part[k] == " "]
    return [(start, m, kind) for start in starts for kind in _EACH if (m := _EACH[kind].match(part, start)) and m.end() > phone.end()]


def rewrite(text: str, key: bytes = KEY, back: bool = False) -> tuple[str, Counter]:
    """The text with every validated value replaced, and how many of each kind."""
    counts: Counter = Counter()

    def shapes(part: str) -> str:
        out, at, m = [], 0, _SHAPES.search(part)
        while m:
            kind = m.lastgroup if m.lastgroup in _BY else next(k for k in _BY if m[k])
            new = _replacement(kind, m[0], key, back)
            if new is not None:
                values, on = [(*m.span(), kind, new)], m.end()
                for start, other, beside in _crossing(part, m) if kind == "phone" else []:
                    # the number has taken groups of what may be another value
                    shorter = _EACH["phone"].match(part, m.start(), start)
                    cut = shorter and _replacement("phone", shorter[0], key, back)
                    if cut and _replacement(beside, other[0], key, back):
                        values, on = [(*shorter.span(), "phone", cut)], shorter.end()
                        break
            else:
                values, on = _within(part, m, lambda kind, value: _replacement(kind, value, key, back))
            for start, end, kind, new in values:
                out += [part[at:start], new]
                at = end
                counts["date" if kind == "named" else kind] += 1
            m = _SHAPES.search(part, on)
        return "".join([*out, part[at:]])

    # addresses first: the digits of one are not numbers of their own
    if "@" in text:
        out, last = [], 0
        for m in _EMAIL.finditer(text):
            out.append(shapes(text[last:m.start()]))
            new = _replacement("email", m[0], key, back)
            counts["email"] += new is not None
            out.append(m[0] if new is None else new)
            last = m.end()
        return "".join([*out, shapes(text[last:])]), +counts
    return (shapes(text), counts) if _HINT.search(text) else (text, counts)


def rewriter(key: bytes, back: bool = False):
    """A column function: the rewritten text and the number of values of each kind."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            text, n = rewrite(t, key, back) if t else (t, Counter())
            rows.append((text, *[n[k] for k in KINDS]))
        return pd.DataFrame(rows, columns=RESULT.names)

    return run


def pseudonymise(docs: DataFrame, into: str, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: the rewritten ``text`` and ``n_<kind>`` of each kind."""
    return docs.withColumn(into, rewriter(key)(F.col(text_col).cast("string")))


def restore(docs: DataFrame, into: str, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """The inverse: ``into.text`` is the text that ``pseudonymise`` with the same key was given, wherever its
    pseudonyms are read as they were written (see above)."""
    return docs.withColumn(into, rewriter(key, back=True)(F.col(text_col).cast("string")))


def rewrite_text(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with its ``text`` rewritten (and ``n_chars``, if there, counted anew); columns as they were."""
    into = "rewritten"
    while into in docs.columns:
        into += "_"
    new = {"text": F.col(f"{into}.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length(f"{into}.text")).cast(dict(docs.dtypes)["n_chars"])
    out = pseudonymise(docs, into, key)
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
