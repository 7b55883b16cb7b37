import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from filelake.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def card(prefix):
    return next(prefix + str(d) for d in range(10) if luhn(prefix + str(d)))


def run(docs, texts, key="k"):
    rows = pii.pseudonymise(docs(list(enumerate(texts))), key).orderBy("doc_id").collect()
    return [r["text"] for r in rows], [[tuple(p) for p in r["pseudonyms"]] for r in rows]


def test_each_format_keeps_its_form(docs):
    number = card("411111111111111")
    texts = [
        f"pay {number}, or {number[:4]} {number[4:8]} {number[8:12]} {number[12:]}.", "write to jo.doe34@mail7.example.com! JO.DOE34@MAIL7.EXAMPLE.COM",
        "call +1 (017) 555-7713 or 017-555-7713", "host 97.51.17.173.", "ssn 123-45-6789", "on 2020-02-29, 03/07/2020, 31/12/1999, 5.6.2001 or 2020-03-07",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
    ]
    new, found = run(docs, texts)
    forms = [
        r"pay (\d{16}), or (\d{4} \d{4} \d{4} \d{4})\.", r"write to ([a-z]{2}\.[a-z]{3}\d\d@mail7\.example\.com)! ([A-Z]{2}\.[A-Z]{3}\d\d@MAIL7\.EXAMPLE\.COM)",
        r"call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", r"host (\d+\.\d+\.\d+\.\d+)\.", r"ssn (\d{3}-\d{2}-\d{4})",
        r"on (\d{4}-02-29), (\d\d/\d\d/\d{4}), (\d\d/\d\d/\d{4}), (\d+\.\d+\.\d{4}) or (\d{4}-\d\d-\d\d)", r'token = "([0-9a-f]{40})"',
    ]
    parts = [re.fullmatch(f, t).groups() for f, t in zip(forms, new)]
    assert all(a != b for a, b in zip(new, texts))
    assert [v for _, v in sum(found, [])] == [v for p in parts for v in p]
    assert luhn(parts[0][0]) and parts[0][0] == parts[0][1].replace(" ", "")
    assert parts[1][0].upper() == parts[1][1]
    assert re.sub(r"\D", "", parts[2][0])[1:] == re.sub(r"\D", "", parts[2][1])
    assert all(int(x) < 256 for x in parts[3][0].split("."))
    datetime.date.fromisoformat(parts[5][0])
    month, day, year = parts[5][1].split("/")
    assert datetime.date(int(year), int(month), int(day)).isoformat() == parts[5][4]


def test_what_is_not_valid_stays(docs):
    bad = next(f"411111111111111{d}" for d in range(10) if not luhn(f"411111111111111{d}"))
    texts = [
        f"{bad} 300.1.1.1 000-12-3456 666-12-3456 2021-02-29 2020-13-01 1.2.3 x4111", "Version 2.0. CC BY-NC 4.0", None, "", "no digits",
        "a@b 12345 1234567 99/99/2020", "deadbeefdeadbeefdeadbeefdeadbeef", card("411111111111111") + "x", "9" * 40,
    ]
    new, found = run(docs, texts)
    assert new == texts and found == [[]] * len(texts)


def test_equal_values_stay_linked_and_different_ones_apart(docs):
    random.seed(7)
    cards = sorted({card("".join(random.choices("0123456789", k=15))) for _ in range(300)})
    days = sorted({(datetime.date(1900, 1, 1) + datetime.timedelta(random.randrange(73_049))).isoformat() for _ in range(300)})
    hosts = sorted({".".join(str(random.randrange(256)) for _ in range(4)) for _ in range(300)})
    for values in (cards, days, hosts):
        new, _ = run(docs, [f"a {v} b {v}" for v in values])
        pairs = [re.fullmatch(r"a (\S+) b (\S+)", t).groups() for t in new]
        assert all(a == b for a, b in pairs) and len({a for a, _ in pairs}) == len(values)
    assert run(docs, [cards[0]], "k")[0] != run(docs, [cards[0]], "other key")[0]


@pytest.mark.parametrize("m, n", [(7, 7), (3, 10)])
def test_pairs_are_permuted(spark, m, n):
    every = spark.range(m * n).select(pii.permute_pair(F.col("id") % m, m, F.floor(F.col("id") / m), n, "k", "t").alias("x"))
    assert sorted((r["x"]["a"], r["x"]["b"]) for r in every.collect()) == sorted((a, b) for a in range(m) for b in range(n))


def test_all_strings_of_a_format_are_permuted(spark):
    every = spark.range(1000).select(pii.permute_chars(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("x"))
    assert sorted(r["x"] for r in every.collect()) == [f"{i:03}" for i in range(1000)]
    leap = spark.range(49).select(F.concat((F.col("id") * 4 + 1904).cast("string"), F.lit("-02-29")).alias("d"))
    new = leap.select(pii._date(F.col("d"), "k")[1].alias("x")).collect()
    assert sorted(r["x"] for r in new) == [f"{1904 + 4 * i}-02-29" for i in range(49)]


def test_days_of_a_year_and_numbers_of_an_area_are_permuted(spark):
    days = spark.range(365 * 3).select(F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("d"))
    got = [r["x"] for r in days.filter("d not like '%-02-29'").select(pii._date(F.col("d"), "k")[1].alias("x")).collect()]
    assert len(set(got)) == len(got) and all(datetime.date.fromisoformat(d) for d in got)
    ssn = spark.range(1, 900).filter("id != 666").select(F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-45-6789")).alias("s"))
    made = [r["x"] for r in ssn.select(pii._ssn(F.col("s"), "k")[1].alias("x")).collect()]
    assert len(set(made)) == 898
    assert all(0 < int(s[:3]) < 900 and s[:3] != "666" and s[4:6] != "00" and s[7:] != "0000" for s in made)


def test_long_texts_and_repeated_rows(docs):
    number = card("123456789012345")
    long_text = ("a" * 100_000 + " ") + f"{number} " * 2000 + "%" * 100_000
    new, found = run(docs, [long_text, long_text])
    assert new[0] == new[1] and len(found[0]) == 2000 and len(set(found[0])) == 1 and len(new[0]) == len(long_text)
    assert pii.pseudonymise(docs([]), "k").count() == 0


def test_plan_is_native(docs):
    plan = pii.pseudonymise(docs([(1, "x")]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_cards_next_to_other_numbers(docs):
    number = "4111 1111 1111 1111"
    texts = [
        f"{number} 12/27", f"{number} 123", f"0000 {number}", f"0000 0001 {number}", f"{number} 1234 5678", f"1234 {number.replace(' ', '-')} 12/27",
        "3782 822463 10005 1234", "1234 3782-822463-10005 4111111111111111 123", f"{number} {number} 99",
    ]
    new, found = run(docs, texts)
    by_number = {"4111": re.sub(r"\D", "", found[0][0][1]), "3782": re.sub(r"\D", "", found[6][0][1])}
    assert all(luhn(v) for v in by_number.values())
    for old, text, made in zip(texts, new, found):
        assert "1111 1111" not in text and "1111-1111" not in text and "822463" not in text and "11111111" not in text
        assert [k for k, _ in made] == ["card"] * (2 if old in texts[-2:] else 1)
        assert all(re.sub(r"\D", "", v) in by_number.values() for _, v in made)
        # What stands around the card numbers stays.
        assert re.sub(r"4111(.?)1111\1?1111\1?1111|3782.822463.10005", "#", old) == re.sub("|".join(re.escape(v) for _, v in made), "#", text)
    bad = "4111 1111 1111 1112 13"
    assert run(docs, [bad]) == ([bad], [[]])


def test_domains_of_very_many_labels(spark):
    """No form may recurse once for each part of a long text."""
    texts = ["x@" + "a." * 100_000 + "com", "1." * 100_000, "1234 " * 100_000, "12-" * 100_000, "a@b." * 50_000, "me@" + "a.b-" * 30 + "c.org"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, "key").collect()}
    # The last four of many numbers are an address, whose new octets may be longer; nothing else changes its length.
    assert got[1]["text"].startswith("1." * 99_996) and len(got[1]["text"]) <= len(texts[1]) + 8
    assert all(len(got[i]["text"]) == len(texts[i]) for i in (0, 2, 3, 4, 5))
    assert got[5]["text"] != texts[5] and got[5]["text"].endswith("@" + "a.b-" * 30 + "c.org")
