import re

import pytest

from tests.llm.conftest import SMALL
from vacanta.llm import pseudonyms
from vacanta.llm.queries import JOBS, TEST_KEY


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)]
    return sum(x if n % 2 == 0 else x * 2 - 9 * (x > 4) for n, x in enumerate(reversed(d))) % 10 == 0


def swapped(build, texts, key="k"):
    return [r.text for r in pseudonyms.pseudonymised(build(list(enumerate(texts))), key).collect()]


def test_cards_stay_valid_and_linked(build):
    one, other, again = swapped(build, ["a 4349000490986231 b", "4710186410006621.", "x 4349-0004-9098-6231!"])
    new = re.search(r"\d{16}", one)[0]
    assert luhn(new) and new != "4349000490986231"
    assert luhn(re.search(r"\d{16}", other)[0])
    assert re.sub(r"\D", "", again) == new
    assert swapped(build, ["a 4349000490986231 b"], "other key")[0] != one


@pytest.mark.parametrize(
    ("text", "kind", "form"),
    [
        ("mail ab.22@mail3.example.com.", "email", r"mail [a-z]{2}\.\d\d@mail3\.example\.com\."),
        ("+1 (543) 555-9258.", "phone", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}\."),
        ("at 67.190.110.215, ok", "address", r"at \d+\.\d+\.\d+\.\d+, ok"),
        ("born 1984-02-29", "date", r"born (19|20)\d\d-\d\d-\d\d"),
        ("born 29.02.1984", "date", r"born \d\d\.\d\d\.(19|20)\d\d"),
        ("no 123-45-6789", "social", r"no \d{3}-\d\d-\d{4}"),
        ("GB82WEST12345698765432", "account", r"GB\d\d[A-Z]{4}\d{14}"),
    ],
)
def test_formats(build, text, kind, form):
    row = pseudonyms.pseudonymised(build([(1, text)]), "k").first()
    assert row.pii == [kind]
    assert row.text != text and re.fullmatch(form, row.text)
    # A pseudonym is a valid value of the same kind, so it is found again.
    assert pseudonyms.pseudonymised(build([(1, row.text)]), "k").first().pii == [kind]


def test_phones_of_any_area_code(build, workers):
    """Codes and exchanges from 000 on, in every written form; no two numbers meet."""
    from pyspark.sql import functions as F

    texts = ["+1 (017) 555-7713", "+1 (543) 155-7713", "(117) 055-0001", "017-555-7713", "000.000.0000"]
    rows = pseudonyms.pseudonymised(build(list(enumerate(texts))), "k").collect()
    for text, row in zip(texts, rows, strict=True):
        assert row.pii == ["phone"] and row.text != text
        assert re.sub(r"\d", "0", row.text) == re.sub(r"\d", "0", text)
        assert pseudonyms.pseudonymised(build([(1, row.text)]), "k").first().pii == ["phone"]
    assert re.sub(r"\D", "", rows[0].text) == "1" + re.sub(r"\D", "", rows[3].text)
    prefix = F.format_string("(%03d) %03d-1234", F.expr("id div 90"), F.expr("id % 90 * 11"))
    numbers = workers.range(18_000).select(F.col("id").alias("doc_id"), prefix.alias("text"))
    assert pseudonyms.pseudonymised(numbers, "k").select("text").distinct().count() == 18_000


def test_date_of_a_timestamp(build):
    long, short, alone = swapped(build, ["at 2024-05-01T10:00:00Z.", "2024-05-01T1000", "2024-05-01"])
    assert alone != "2024-05-01"
    assert (long, short) == (f"at {alone}T10:00:00Z.", f"{alone}T1000")


def test_what_is_not_valid_stays(build):
    texts = ["4349000490986232", "300.1.1.1", "2023-02-29", "31/04/2020", "666-12-1234", "GB82WEST12345698765431", "v1.2.3.4.5", "12345"]
    assert swapped(build, texts) == texts


def test_permutation(build, workers):
    """Different values of a format never meet: addresses, and all dates of the domain."""
    from pyspark.sql import functions as F

    day = F.date_format(F.expr("date_add(DATE'1900-01-01', cast(id as int))"), "yyyy-MM-dd")
    days = workers.range(73_049).select(F.col("id").alias("doc_id"), day.alias("text"))
    assert pseudonyms.pseudonymised(days, "k").select("text").distinct().count() == 73_049
    numbers = workers.range(2000).select(F.col("id").alias("doc_id"), F.format_string("10.9.%d.%d", F.expr("id div 250"), F.expr("id % 250")).alias("text"))
    assert pseudonyms.pseudonymised(numbers, "k").select("text").distinct().count() == 2000


def test_brute_force_feistel(build):
    """The digit permutation against plain Python."""
    import hashlib

    def shift(part, digest):
        return "".join(str((int(c) + int(digest[4 * (i % 16) : 4 * (i % 16) + 4], 16)) % 10) for i, c in enumerate(part))

    body = "434900049098623"
    a, b = body[:8], body[8:]
    for n in range(8):
        own, other = (a, b) if n % 2 == 0 else (b, a)
        digest = hashlib.sha256(f"k|card|{n}|{len(own)}|{other}".encode()).hexdigest()
        a, b = (shift(a, digest), b) if n % 2 == 0 else (a, shift(b, digest))
    (got,) = swapped(build, ["4349000490986231"])
    assert got[:-1] == a + b and luhn(got)


def test_query_replaces_what_plain_code_finds(workers):
    """Whole table: text between values stays, cards follow the plain permutation, kinds are counted."""
    import hashlib

    def shift(part, digest):
        return "".join(str((int(c) + int(digest[4 * (i % 16) : 4 * (i % 16) + 4], 16)) % 10) for i, c in enumerate(part))

    def plain_card(value):
        digits = re.sub(r"\D", "", value)
        body = digits[:-1]
        a, b = body[: (len(body) + 1) // 2], body[(len(body) + 1) // 2 :]
        for n in range(8):
            own, other = (a, b) if n % 2 == 0 else (b, a)
            digest = hashlib.sha256(f"{TEST_KEY}|card|{n}|{len(own)}|{other}".encode()).hexdigest()
            a, b = (shift(a, digest), b) if n % 2 == 0 else (a, shift(b, digest))
        check = next(c for c in "0123456789" if luhn(a + b + c))
        new = iter(a + b + check)
        return "".join(next(new) if c.isdigit() else c for c in value)

    texts = dict(workers.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = JOBS["op3_feistel_pseudonyms"](workers, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    pattern, changed = re.compile(pseudonyms.VALUE), 0
    for r in rows:
        before, after = texts[r.doc_id], r.text
        old, new = pattern.findall(before), pattern.findall(after)
        assert pattern.split(before) == pattern.split(after) and len(old) == len(new)
        cards = [(a, b) for a, b in zip(old, new, strict=True) if re.fullmatch(pseudonyms.CARD, a) and luhn(a)]
        assert all(b == plain_card(a) for a, b in cards)
        assert sum(a != b for a, b in zip(old, new, strict=True)) <= sum(r[f"n_{k}"] for k in pseudonyms.KINDS)
        changed += len(cards)
    assert changed


def test_odd_rows(build, odd):
    docs = build(odd)
    rows = pseudonyms.pseudonymised(docs, "k")
    assert rows.columns == [*docs.columns, "pii"]
    assert [(r.doc_id, r.text) for r in rows.collect()] == odd
    assert pseudonyms.pseudonymised(build([]), "k").collect() == []


def test_no_python(build):
    plan = pseudonyms.pseudonymised(build([(1, "x")]), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
