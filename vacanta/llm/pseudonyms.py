"""Format-preserving pseudonyms: keyed Feistel permutations of validated values.

A value found in a text is replaced by another value of the same format: a card number by
a card number with a right check digit, an address by an address, a date by a date. The
permutation depends only on the key and the format, so equal values get equal pseudonyms
in all documents, whatever separators they were written with, and different values never
get the same one.

Each format has a domain that is split in two parts A and B. A round adds to one part a
keyed hash of the other, modulo the size of that part; the parts take turns. Every round
can be undone, so the whole is a permutation of exactly that domain.

* Strings (card and account digits, mailbox names): A and B are halves of the string, and
  each character moves inside its class (digits, letters).
* Numbers with rules (phone, social security, IP, date): the rules define a product of two
  ranges, so that every pseudonym is valid too.

Only SQL functions are used. Rounds are a fold, which binds each round's state once. Text
is not moved: one pass cuts it at the values and joins it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.llm.identity import free_name

ROUNDS = 8
# Dates between these are permuted among each other; 73,049 days = 17 * 4,297.
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 17, 4297

EMAIL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"
ACCOUNT = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY_FIRST = r"[0-9]{2}[./][0-9]{2}[./][0-9]{4}"
PHONE = r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
# Longer formats stand before those they contain.
_BEFORE, _AFTER = r"(?<![A-Za-z0-9])(?<![0-9][./-])", r"(?![A-Za-z0-9])(?![./-][0-9])"
VALUE = (
    rf"(?<![A-Za-z0-9._%+@-]){EMAIL}(?![A-Za-z0-9@])"
    rf"|{_BEFORE}{ISO_DATE}(?=T[0-9]{{2}}:?[0-9]{{2}})"  # the date of a timestamp
    rf"|{_BEFORE}(?:{ACCOUNT}|{ADDRESS}|{ISO_DATE}|{DAY_FIRST}|{SOCIAL}|{CARD}){_AFTER}"
    rf"|(?<![A-Za-z0-9(])(?<![0-9][./+-])(?:{PHONE}){_AFTER}"
)

KINDS = ("email", "account", "address", "date", "phone", "social", "card")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("long")


def _keyed(key: Column, *parts) -> Column:
    """64 hex digits that depend on the key and the parts."""
    return F.sha2(F.concat_ws("|", key, *parts), 256)


def _hash_number(digest: Column) -> Column:
    """52 bits of a digest as a long."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def permute_pair(
    a: Column, b: Column, size_a: int, size_b: int, key: Column, domain: str
) -> Column:
    """The pair (a, b) of [0, size_a) x [0, size_b), permuted; a struct of a and b."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, n: Column) -> Column:
        to_a = F.pmod(s.a + _hash_number(_keyed(key, F.lit(domain), n, s.b)), F.lit(size_a))
        to_b = F.pmod(s.b + _hash_number(_keyed(key, F.lit(domain), n, s.a)), F.lit(size_b))
        even = n % 2 == 0
        return F.struct(
            F.when(even, to_a).otherwise(s.a).cast("long").alias("a"),
            F.when(even, s.b).otherwise(to_b).cast("long").alias("b"),
        )

    return F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, step)


def _shifted(part: Column, digest: Column) -> Column:
    """Each digit or letter of a part moved inside its class by four digits of a digest."""

    def move(at: Column) -> Column:
        c = F.substring(part, at, F.lit(1))
        by = F.conv(F.substring(digest, (at - 1) % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")
        code = F.ascii(c)

        def within(first: str, size: int) -> Column:
            return F.char(F.pmod(code - ord(first) + by, F.lit(size)) + ord(first))

        return (
            F.when(c.between("0", "9"), within("0", 10))
            .when(c.between("a", "z"), within("a", 26))
            .when(c.between("A", "Z"), within("A", 26))
            .otherwise(c)
        )

    length = F.length(part)
    return F.when(
        length > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(length, F.lit(1))), move), "")
    ).otherwise("")


def permute_text(value: Column, key: Column, domain: str) -> Column:
    """A string of at least one character, permuted among those of its character classes.

    Letters count the same in either case, so spellings in other cases stay linked.
    """
    half = F.floor((F.length(value) + 1) / 2).cast("int")
    start = F.struct(
        F.substring(value, F.lit(1), half).alias("a"),
        F.substring(value, half + 1, F.length(value)).alias("b"),
    )

    def step(s: Column, n: Column) -> Column:
        def digest(other: Column, own: Column) -> Column:
            return _keyed(key, F.lit(domain), n, F.length(own), F.lower(other))

        even = n % 2 == 0
        to_a = _bound(digest(s.b, s.a), lambda d: _shifted(s.a, d))
        to_b = _bound(digest(s.a, s.b), lambda d: _shifted(s.b, d))
        return F.struct(
            F.when(even, to_a).otherwise(s.a).alias("a"), F.when(even, s.b).otherwise(to_b).alias("b")
        )

    return F.aggregate(
        F.array(*(F.lit(i) for i in range(ROUNDS))), start, step, lambda s: F.concat(s.a, s.b)
    )


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits that a check digit follows: modulo 10."""

    def term(at: Column) -> Column:
        d = F.substring(digits, at, F.lit(1)).cast("int")
        twice = (F.length(digits) - at) % 2 == 0
        return F.when(twice, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda s, x: s + x
    ) % 10


def check_digit(digits: Column) -> Column:
    return ((10 - _luhn(digits)) % 10).cast("string")


def _mod97(account: Column) -> Column:
    """An account number modulo 97, its first four characters last, letters from 10 on."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, at: Column) -> Column:
        c = F.substring(turned, at, F.lit(1))
        digit = c.between("0", "9")
        value = F.when(digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(digit, 10).otherwise(100) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), step)


def _refilled(template: Column, digits: Column) -> Column:
    """The template with its digits replaced in order; everything else stays."""

    def put(at: Column) -> Column:
        c = F.substring(template, at, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(template, F.lit(1), at), "[^0-9]", ""))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(template)), put), "")


def _date_parts(value: Column) -> tuple[Column, Column, Column]:
    iso = value.rlike(rf"^{ISO_DATE}$")
    return (
        F.when(iso, _number(value, 1, 4)).otherwise(_number(value, 7, 4)),
        F.when(iso, _number(value, 6, 2)).otherwise(_number(value, 4, 2)),
        F.when(iso, _number(value, 9, 2)).otherwise(_number(value, 1, 2)),
    )


def kind_of(value: Column) -> Column:
    """The format that a found value validly has, or null."""

    def has(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    digits = F.regexp_replace(value, "[^0-9]", "")
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    is_date = has(f"{ISO_DATE}|{DAY_FIRST}")
    # Parts of a string that is no date are never computed: CASE stops before.
    year, month, day = _date_parts(value)
    in_range = is_date & F.when(
        is_date & year.between(1900, 2099) & month.between(1, 12),
        day.between(
            1,
            F.when(month.isin(4, 6, 9, 11), 30)
            .when(month != 2, 31)
            .when((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)), 29)
            .otherwise(28),
        ),
    ).otherwise(False)
    area = _number(value, 1, 3)
    social = F.when(
        has(SOCIAL),
        (area > 0) & (area < 900) & (area != 666) & (_number(value, 5, 2) > 0) & (_number(value, 8, 4) > 0),
    ).otherwise(False)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return (
        F.when(value.contains("@"), "email")
        .when(has(ACCOUNT), F.when(_mod97(value) == 1, "account"))
        .when(has(ADDRESS), F.when(F.forall(octets, lambda x: x <= 255), "address"))
        .when(is_date, F.when(in_range, "date"))
        .when(has(PHONE), "phone")
        .when(has(SOCIAL), F.when(social, "social"))
        .when(has(CARD), F.when(check_digit(body) == F.substring(digits, -1, 1), "card"))
    )


def pseudonym(value: Column, kind: Column, key: Column) -> Column:
    """The value's pseudonym in its format; the value itself where ``kind`` is null."""
    digits = F.regexp_replace(value, "[^0-9]", "")

    at = F.instr(value, "@")
    email = F.concat(
        permute_text(F.substring(value, F.lit(1), at - 1), key, "email"),
        F.substring(value, at, F.length(value)),
    )

    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    card = _refilled(
        value, _bound(permute_text(body, key, "card"), lambda b: F.concat(b, check_digit(b)))
    )

    def checked(own: Column) -> Column:
        country = F.substring(value, 1, 2)
        rest = 98 - _mod97(F.concat(country, F.lit("00"), own))
        return F.concat(country, F.lpad(rest.cast("string"), 2, "0"), own)

    account = _bound(
        permute_text(F.substring(value, F.lit(5), F.length(value)), key, "account"), checked
    )

    octet = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    address = _bound(
        permute_pair(
            F.get(octet, F.lit(0)) * 256 + F.get(octet, F.lit(1)),
            F.get(octet, F.lit(2)) * 256 + F.get(octet, F.lit(3)),
            1 << 16,
            1 << 16,
            key,
            "address",
        ),
        lambda p: F.concat_ws(
            ".", F.floor(p.a / 256), p.a % 256, F.floor(p.b / 256), p.b % 256
        ),
    )

    day = F.datediff(F.make_date(*_date_parts(value)), F.lit(FIRST_DAY).cast("date"))

    def dated(p: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), (p.a * DAYS_B + p.b).cast("int"))
        return F.when(value.rlike(rf"^{ISO_DATE}$"), F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(
                F.date_format(new, "dd"),
                F.substring(value, 3, 1),
                F.date_format(new, "MM"),
                F.substring(value, 6, 1),
                F.date_format(new, "yyyy"),
            )
        )

    date = _bound(
        permute_pair(F.floor(day / DAYS_B), day % DAYS_B, DAYS_A, DAYS_B, key, "date"), dated
    )

    # A leading 1 is the country's. Numbers whose area code and exchange start with 2 to 9
    # are permuted among each other, and so are all others: 360,000 = 600 * 600 prefixes.
    ten = F.substring(digits, -10, 10)
    code, exchange, line = _number(ten, 1, 3), _number(ten, 4, 3), _number(ten, 7, 4)

    def dialled(code: Column, exchange: Column, line: Column) -> Column:
        parts = ((code, 3), (exchange, 3), (line, 4))
        return _refilled(
            value,
            F.concat(
                F.when(F.length(digits) > 10, F.substring(digits, 1, 1)).otherwise(""),
                *(F.lpad(part.cast("string"), n, "0") for part, n in parts),
            ),
        )

    assigned = _bound(
        permute_pair(code - 200, (exchange - 200) * 10_000 + line, 800, 8_000_000, key, "phone"),
        lambda p: dialled(p.a + 200, F.floor(p.b / 10_000) + 200, p.b % 10_000),
    )
    prefix = F.when(code < 200, code * 1_000 + exchange).otherwise(200_000 + (code - 200) * 200 + exchange)

    def unassigned(p: Column) -> Column:
        at = p.a * 600 + F.floor(p.b / 10_000)
        low = at < 200_000
        return dialled(
            F.when(low, F.floor(at / 1_000)).otherwise(F.floor((at - 200_000) / 200) + 200),
            F.when(low, at % 1_000).otherwise((at - 200_000) % 200),
            p.b % 10_000,
        )

    phone = F.when((code >= 200) & (exchange >= 200), assigned).otherwise(
        _bound(
            permute_pair(
                F.floor(prefix / 600), prefix % 600 * 10_000 + line, 600, 6_000_000, key, "phone-other"
            ),
            unassigned,
        )
    )

    area = _number(digits, 1, 3)
    social = _bound(
        permute_pair(
            area - F.when(area > 666, 2).otherwise(1),
            (_number(digits, 4, 2) - 1) * 9_999 + _number(digits, 6, 4) - 1,
            898,
            99 * 9_999,
            key,
            "social",
        ),
        lambda p: F.concat_ws(
            "-",
            F.lpad((p.a + F.when(p.a >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(p.b / 9_999) + 1).cast("string"), 2, "0"),
            F.lpad((p.b % 9_999 + 1).cast("string"), 4, "0"),
        ),
    )
    by_kind = {
        "email": email,
        "account": account,
        "address": address,
        "date": date,
        "phone": phone,
        "social": social,
        "card": card,
    }
    new = value
    for name, made in by_kind.items():
        new = F.when(kind == name, made).otherwise(new)
    return new


def pseudonymised(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with valid values in ``text`` replaced, and ``pii`` appended.

    ``pii`` is an array of the kinds replaced, in text order. Whole texts are searched;
    anything that only looks like a value (wrong check digit, no such day) stays. Null
    texts stay null and have no ``pii``; empty texts, repeated rows and null ids pass
    through. All other columns stay, except that one called ``pii`` is replaced.
    """
    secret = F.lit(key)
    found = F.transform(
        F.regexp_extract_all(text, F.lit(VALUE), F.lit(0)),
        lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")),
    )
    out = [c for c in documents.columns if c != "pii"]
    some, swaps, parts = (free_name(documents, c) for c in ("pii_found", "pii_swapped", "pii_between"))
    swapped = F.transform(
        some, lambda f: F.when(f.kind.isNull(), f.value).otherwise(pseudonym(f.value, f.kind, secret))
    )
    between = F.split(text, VALUE, -1)
    joined = F.array_join(
        F.transform(parts, lambda part, n: F.concat(part, F.coalesce(F.get(swaps, n), F.lit("")))), ""
    )
    kinds = F.transform(F.filter(some, lambda f: f.kind.isNotNull()), lambda f: f.kind)
    return (
        documents.select(*out)
        .withColumn(some, found)
        .withColumn(swaps, swapped)
        .withColumn(parts, F.when(F.size(some) > 0, between))
        .select(
            *(
                F.when(F.size(some) > 0, joined).otherwise(F.col(text)).alias(c) if c == text else F.col(c)
                for c in out
            ),
            F.coalesce(kinds, F.array().cast("array<string>")).alias("pii"),
        )
    )
