"""Format-preserving pseudonyms of personal data, in SQL functions alone.

Values are found by one pattern, validated, and permuted by a keyed Feistel
network inside their own format: a value always has the same pseudonym under a
key, in whatever document, and no two values of a format share one.

==========  ============================================  ==========================================
kind        valid if                                      pseudonym
==========  ============================================  ==========================================
card        13 to 19 digits with a right Luhn digit       first digit kept, Luhn digit right again
phone       ten digits as North American numbers are      any ten digits
            written
SSN         area, group and serial that are issued        area, group and serial that can be issued
IPv4        four octets of 0 to 255, no zeros in front    any four octets
date        a day of 1800 to 2199 as ``yyyy-mm-dd``,      another day of these 400 years
            ``dd.mm.yyyy`` or ``mm/dd/yyyy``
email       local part, domain and top-level domain       letters for letters, digits for digits
secret      access key ids, values after ``password=``    letters for letters, digits for digits
            and the like
==========  ============================================  ==========================================

Punctuation stays.  Numbers are a pair of a mixed radix, strings two halves of
which each is shifted character by character; either way a round adds a keyed
SHA-256 value of the other half, which can be undone.  What fails validation
is not personal data and stays.  Rows are mapped one by one: no shuffle.

Defined results: a null text stays null with no values found; an empty text
stays empty; ids do not matter; other columns are kept, but for one named like
``count``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Every alternative starts where no longer run can have started, so matching is linear in long runs.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)*(?<=\.[A-Za-z]{2,24})",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?<![A-Za-z])(?i:password|passwd|token|secret|api_key)(?-i)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_\-+/]{8,}",
    "date": r"(?<![\d.\-/])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\-/]?\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\-]?\d)",
    "phone": r"(?<![\d+\-])(?:\+?1[ .\-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\-]?\d)|(?<![\d+])\+1\d{10}(?!\d)",
    "ipv4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "card": r"(?<![\d\-])\d(?:[ \-]?\d){12,18}(?![\-]?\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def keyed(key: str, tag: str, round_: Column, half: Column) -> Column:
    """SHA-256 of key, format, round and half, in hexadecimal."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), round_.cast("string"), half), 256)


def number(hex_: Column) -> Column:
    return F.conv(F.substring(hex_, 1, 14), 16, 10).cast("long")


def permute_pair(key: str, tag: str, a: Column, b: Column, sizes: tuple[int, int], use) -> Column:
    """``use(a, b)`` of the Feistel network on pairs ``a < sizes[0], b < sizes[1]``."""

    def step(x: Column, r: Column) -> Column:
        left = F.when(r % 2 == 1, (x["a"] + number(keyed(key, tag, r, x["b"].cast("string")))) % sizes[0]).otherwise(x["a"])
        right = F.when(r % 2 == 0, (x["b"] + number(keyed(key, tag, r, x["a"].cast("string")))) % sizes[1]).otherwise(x["b"])
        return F.struct(left.alias("a"), right.alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return let(done, lambda x: use(x["a"], x["b"]))


def shift(text: Column, hashed: Column) -> Column:
    """Letters and digits moved on within their kind by the bytes of a hash."""
    return let(hashed, lambda h: _shift(text, h))


def _shift(text: Column, hex_: Column) -> Column:

    def one(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        by = F.conv(F.substring(hex_, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turn = lambda first, n: F.char((F.ascii(c) - ord(first) + by) % n + ord(first))
        return F.when(c.between("0", "9"), turn("0", 10)).when(c.between("a", "z"), turn("a", 26)).when(c.between("A", "Z"), turn("A", 26)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: i > 0), one), "")


def permute_text(key: str, tag: str, text: Column) -> Column:
    """Feistel network on strings; lengths and kinds of characters stay."""
    cut = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), cut).alias("a"), F.substring(text, cut + 1, F.length(text)).alias("b"))

    def step(x: Column, r: Column) -> Column:
        left = F.when(r % 2 == 1, shift(x["a"], keyed(key, tag, r, x["b"]))).otherwise(x["a"])
        right = F.when(r % 2 == 0, shift(x["b"], keyed(key, tag, r, x["a"]))).otherwise(x["b"])
        return F.struct(left.alias("a"), right.alias("b"))

    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step), lambda x: F.concat(x["a"], x["b"]))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refill(shape: Column, new: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``new``."""

    def one(fill: Column, i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        return F.when(c.between("0", "9"), F.substring(fill, F.length(digits(F.substring(shape, F.lit(1), i))), F.lit(1))).otherwise(c)

    return let(new, lambda fill: F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: one(fill, i)), ""))


def padded(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def whole_number(text: Column) -> Column:
    return text.try_cast("long")


def luhn_sum(body: Column, doubled: int) -> Column:
    """Sum of digits of which every second is doubled, from the right, starting with the last if ``doubled`` is 0."""

    def add(back: Column, x: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).try_cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return x + F.when((i + doubled) % 2 == 1, twice).otherwise(d)

    return let(F.reverse(body), lambda back: F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda x, i: add(back, x, i)))


def card(key: str, m: Column) -> Column:
    def of(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1), permute_text(key, "card", F.substring(d, F.lit(2), n - 2)))
        new = let(body, lambda x: F.concat(x, ((10 - luhn_sum(x, 0) % 10) % 10).cast("string")))
        return F.when(luhn_sum(d, 1) % 10 == 0, refill(m, new))

    return let(digits(m), of)


def phone(key: str, m: Column) -> Column:
    def of(d: Column) -> Column:
        own = F.substring(d, -10, 10)
        area, rest = whole_number(F.substring(own, 1, 3)), whole_number(F.substring(own, 4, 7))
        front = F.substring(d, F.lit(1), F.length(d) - 10)
        new = permute_pair(key, "phone", area, rest, (1_000, 10_000_000), lambda a, b: F.concat(front, padded(a, 3), padded(b, 7)))
        return refill(m, new)

    return let(digits(m), of)


def ssn(key: str, m: Column) -> Column:
    area, group, serial = (whole_number(F.substring(m, at, n)) for at, n in ((1, 3), (5, 2), (8, 4)))
    place = area - F.when(area > 666, 2).otherwise(1)  # 666 is never issued

    def new(a: Column, b: Column) -> Column:
        first = F.floor(a / 99) + 1
        first = first + (first >= 666).cast("int")
        return F.concat_ws("-", padded(first, 3), padded(a % 99 + 1, 2), padded(b + 1, 4))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, permute_pair(key, "ssn", place * 99 + group - 1, serial - 1, (898 * 99, 9_999), new))


def ipv4(key: str, m: Column) -> Column:
    o = [whole_number(F.get(F.split(m, r"\."), F.lit(k))) for k in range(4)]
    valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256) & ~m.rlike(r"(?:^|\.)0\d")

    def new(a: Column, b: Column) -> Column:
        parts = (F.floor(a / 256), a % 256, F.floor(b / 256), b % 256)
        return F.concat_ws(".", *(p.cast("string") for p in parts))

    return F.when(valid, permute_pair(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], (65_536, 65_536), new))


def date(key: str, m: Column) -> Column:
    start = F.lit("1800-01-01").cast("date")

    def of(form: str):
        return lambda day: moved(form, day)

    def moved(form: str, day: Column) -> Column:
        # 400 Gregorian years have 146,097 = 27 x 5,411 days.
        new = permute_pair(
            key, "date", F.floor(day / 5_411), day % 5_411, (27, 5_411),
            lambda a, b: F.date_format(F.date_add(start, (a * 5_411 + b).cast("int")), form),
        )
        return F.when(day.between(0, 146_096), new)

    out = None
    for mark, form in (("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "MM/dd/yyyy")):
        day = F.datediff(F.to_date(F.try_to_timestamp(m, F.lit(form))), start)
        has, new = F.contains(m, F.lit(mark)), let(day, of(form))
        out = F.when(has, new) if out is None else out.when(has, new)
    return out


def email(key: str, m: Column) -> Column:
    cut = F.length(m) - F.length(F.substring_index(m, ".", -1))
    return F.concat(permute_text(key, "email", F.substring(m, F.lit(1), cut - 1)), F.substring(m, cut, F.length(m)))


def secret(key: str, m: Column) -> Column:
    head = F.regexp_extract(m, "^(?:AKIA(?=[0-9A-Z]{16}$)|(?i:[a-z_]+)[ ]?[=:][ ]?[\"']?)", 0)
    return let(head, lambda h: F.concat(h, permute_text(key, "secret", F.substring(m, F.length(h) + 1, F.length(m)))))


def pseudonym(key: str, m: Column) -> Column:
    """Pseudonym of a value that some pattern matches; null if it is not valid."""
    makers = {"email": email, "secret": secret, "date": date, "ssn": ssn, "phone": phone, "ipv4": ipv4, "card": card}
    out = None
    for kind, make in makers.items():
        # Alone, a value has no neighbours that the pattern must not see.
        is_kind = m.rlike(f"^(?:{PATTERNS[kind]})$")
        out = F.when(is_kind, make(key, m)) if out is None else out.when(is_kind, make(key, m))
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str = "n_pseudonyms") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and in ``count`` (long) how many values were replaced."""
    kept = [c for c in docs.columns if c != count]
    hits, news = (next(n for k in range(len(kept) + 1) if (n := f"{name}_{k}") not in kept) for name in ("hits", "news"))
    t, own = F.col(f"`{text}`"), [F.col(f"`{c}`") for c in kept]
    found = F.when(t.rlike("[0-9@=:]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    staged = docs.select(*own, F.coalesce(found, F.array().cast("array<string>")).alias(hits))
    some = F.size(hits) > 0
    # Columns of their own, so that each is worked out once.
    staged = staged.select(*own, hits, F.when(some, F.transform(hits, lambda m: pseudonym(key, m))).alias(news))
    joined = F.array_join(
        F.transform(F.split(t, ANY, -1), lambda x, i: F.concat(x, F.coalesce(F.get(news, i), F.get(hits, i), F.lit("")))), ""
    )
    replaced = F.coalesce(F.size(F.filter(news, lambda x: x.isNotNull())), F.lit(0)).cast("long")
    return staged.select(
        *(F.when(some, joined).otherwise(t).alias(c) if c == text else F.col(f"`{c}`") for c in kept), replaced.alias(count)
    )
