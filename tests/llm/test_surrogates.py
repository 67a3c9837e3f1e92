"""Operator 2: nothing found is left, forms and coreference are kept."""

import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from adlens.llm import surrogates

from .cases import empty, frame

TEXTS = {
    1: "Call +1 (017) 555-7713 or +10175557713, mail AND.34@MAIL7.EXAMPLE.COM or and.34@mail7.example.com.",
    2: "Mr. John Smith met Mrs. Anna Smith; Mr. Smith said 4111 1111 1111 1111 and 4111111111111111 at 97.51.17.173!",
    3: 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" 123-45-6789. господин Иван Петров',
    4: "Version 2.0 of 2024-05-06 and 3.14 stays, so does 12345.",
    5: "MR. JOHN SMITH!! and the 97.51.17.173",
}


@pytest.fixture(scope="module")
def out(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    return {r.doc_id: r.text for r in surrogates.replace_entities(df, "key").collect()}


def test_forms_and_coreference(out):
    a = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1(\d{10}), mail (\S+) or (\S+)\.", out[1])
    assert a and a[1] + a[2] + a[3] == a[4] and a[1] + a[2] + a[3] != "0175557713"
    assert a[5] == a[6].upper() and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", a[6])
    b = re.fullmatch(r"Mr\. (\S+) (\S+) met Mrs\. (\S+) (\S+); Mr\. (\S+) said ([\d ]{19}) and (\d{16}) at (\S+)!", out[2])
    assert b[2] == b[4] == b[5] and b[6].replace(" ", "") == b[7] and "Smith" not in out[2]
    digits = [int(c) for c in b[7]][::-1]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert all(0 < int(x) < 256 for x in b[8].split(".")) and b[8] in out[5]
    male = {n.lower() for n in surrogates.GIVEN["M", "latin"]}
    assert any(b[1].lower().startswith(n) for n in male)
    c = re.fullmatch(r'token = "([0-9a-f]{40})" (\d{3}-\d{2}-\d{4})\. господин ([А-Я][а-яё]+) ([А-Я][а-яё]+)', out[3])
    assert c and c[3] != "Иван" and c[4] != "Петров"


def test_other_numbers_stay(out):
    assert out[4] == TEXTS[4]


def test_surrogates_are_distinct_and_no_entity_of_the_corpus(spark):
    # as many one-digit-octet addresses as make collisions certain
    forms = spark.range(6000).select(F.lit("IP").alias("kind"), F.concat_ws(
        ".", *[(1 + F.floor(F.col("id") / 9 ** k) % 9).cast("string") for k in range(4)]).alias("form"))
    three = forms.where(F.col("form").rlike("^[1-3]"))
    got = [(r.form, r.surrogate) for r in surrogates.draw_surrogates(three, "k").collect()]
    assert len({f for f, _ in got}) == three.distinct().count()
    assert len({s for _, s in got}) == len(got) and not {s for _, s in got} & {f for f, _ in got}


STAY = "on 2024-05-06, 06.05.2024, 01.02.2024 10:20:30, v10.15.7, 3.14.159, 1.2.3-4, 12345, a::b, x[1::2], AB12 3456"
FOUND = {
    "phones": r"415-555-0132 415.555.0132 1-415-555-0132 0171 2345678 030/1234567 020 7946 0958 01 23 45 67 89 0049 171 2345678",
    "cards": "3782 822463 10005 3782-822463-10005",
    "iban": "DE89 3704 0044 0532 0130 00 PLUS GB82WEST12345698765432",
    "ipv6": "2001:db8::ff00:42:8329 FE80::1 2001:0db8:0000:0000:0000:ff00:0042:8329 ::ffff:192.168.10.12 [::1]",
}


@pytest.mark.parametrize("name", FOUND)
def test_more_forms_next_to_what_stays(spark, name):
    text = f"{STAY}; {FOUND[name]}; {STAY}"
    new = surrogates.replace_entities(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key").first()
    got = re.fullmatch(re.escape(STAY) + "; (.*); " + re.escape(STAY), new.text)[1]
    left = [w for w in re.split("[ /]", FOUND[name]) if len(w) > 4 and w in got]
    assert left in ([], ["0049"]) and new.n_entities == {"phones": 8, "cards": 2, "iban": 2, "ipv6": 5}[name], got
    shape = re.compile(r"\d" if name in ("phones", "cards") else "[0-9A-Za-z]")
    assert shape.sub("x", got) == shape.sub("x", FOUND[name])
    if name == "iban":
        for x in re.fullmatch(r"(DE.*) (?:PLUS) (GB.*)", got).groups():
            x = x.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1
    if name == "ipv6":
        import ipaddress
        assert all(ipaddress.ip_address(x.strip("[]")) for x in got.split())


def test_what_only_looks_like_an_iban(spark):
    text = "DE88 3704 0044 0532 0130 00 and DE12 4111 1111 1111 1111 12 and AT12 1234 5678 123-45-6789"
    new = surrogates.replace_entities(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key").first()
    assert new.text.startswith("DE88 ") and "4111 1111" not in new.text and "123-45-6789" not in new.text


def test_initials_titles_and_scripts(spark):
    text = ("Mr. J. Smith, Dr. Anna Smith, Prof. Dr. J.R.R. Smith, Mrs. Anna K. Smith, MR. PAUL SMITH, "
            "κύριος Νίκος Παππάς, Доктор И. Петров.")
    new = surrogates.replace_entities(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key").first()
    m = re.fullmatch(r"Mr\. (\w)\. (\w+), Dr\. (\w+) (\w+), Prof\. Dr\. (\w\.\w\.\w\.) (\w+), Mrs\. (\w+) (\w)\. (\w+), "
                     r"MR\. ([A-Z]+) ([A-Z]+), κύριος ([Α-ώ]+) ([Α-ώ]+), Доктор ([А-Я])\. ([А-я]+)\.", new.text)
    assert m and new.n_entities == 7, new.text
    assert m[1] != "J" and m[5] == f"{m[1]}.{m[5][2]}.{m[5][2]}." and m[5][2] != "R" and m[8] != "K" and m[14] != "И"
    assert m[2] == m[4] == m[6] == m[9] == m[11].capitalize() != "Smith" and m[3] == m[7] != "Anna"
    assert m[12] != "Νίκος" and m[13] != "Παππάς" and m[15] != "Петров" and m[10] != "PAUL"


def test_more_entities_than_strings_of_their_shape(spark):
    ab = [chr(97 + i) for i in range(26)]
    forms = [("IP", ".".join(f"{n:04d}")) for n in range(10_000)]            # 6,561 addresses have this shape
    forms += [("SURNAME", a + b) for a in ab for b in ab]                   # 170 surnames, all themselves forms
    forms += [("PHONE", f"{n:03d}") for n in range(1000)] + [("EMAIL", f"{a}@{b}.com") for a in ab for b in ab]
    got = surrogates.draw_surrogates(spark.createDataFrame(forms, "kind string, form string"), "k").collect()
    assert sorted((r.kind, r.form) for r in got) == sorted(forms)
    new = {(r.kind, r.surrogate) for r in got}
    assert len(new) == len(got) and not new & set(forms)
    assert all(max(map(int, s.split("."))) < 256 for k, s in new if k == "IP")
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.com", s) for k, s in new if k == "EMAIL")


def test_longer_surrogates_in_the_text(spark):
    names = [chr(65 + i) + chr(97 + j) for i in range(26) for j in range(26)]
    df = spark.createDataFrame([(1, "; ".join(f"Mr. {n} and Mr. {n.upper()}" for n in names))], "doc_id long, text string")
    pairs = re.findall(r"Mr\. (\S+) and Mr\. (\S+?)(?:;|$)", surrogates.replace_entities(df, "key").first().text)
    assert len(pairs) == 676 and all(a.upper() == b for a, b in pairs)
    assert len({a for a, _ in pairs}) == 676 and not {a for a, _ in pairs} & set(names)


def test_awkward_rows(spark):
    df = frame(spark)
    got = surrogates.replace_entities(df, "key")
    assert got.columns == [*df.columns, "n_entities"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        ((r.doc_id, r.text) for r in df.collect()), key=str)
    assert surrogates.replace_entities(empty(spark), "key").count() == 0


def test_repeated_rows_and_very_long_text(spark):
    text = "mail a.1@b2.example.com " * 3000
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    rows = surrogates.replace_entities(df, "key").collect()
    assert len(rows) == 3 and len({r.text for r in rows}) == 1 and {r.n_entities for r in rows} == {3000}
    assert len(rows[0].text) == len(text) and "a.1@b2" not in rows[0].text


def test_native_plan(spark):
    plan = surrogates.replace_entities(frame(spark), "key")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_runs_take_time_in_proportion(spark):
    n = 1_000_000
    texts = ["a" * n + " 1", "a" * n + "@", "a." * (n // 2) + "1@", "x@" * (n // 2) + "1", "@" + "b." * (n // 2) + "1",
             "ab@" + "c" * n + " 2", "1" * n, "1." * (n // 2), "f" * n + "0", "a:" * (n // 2) + "1", "Mr. " * (n // 8) + "1",
             "x" * n + "@mail.example 1", "x" * 200 + "@mail.example 1", "a@b." + "c" * n + " 1", "Mr. A" + "a" * n]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    began = time.time()
    got = {r.doc_id: r for r in surrogates.replace_entities(df, "key").collect()}
    assert time.time() - began < 120
    assert got[12].n_entities == 1 and got[12].text.endswith("example 1") and not got[12].text.startswith("xxxx")
    assert all(got[i].text == texts[i] for i in (0, 1, 6, 8, 11, 13, 14))


def test_places_equal_a_plain_search(spark):
    rnd = random.Random(8)
    bits = ["a.b+c@mail.example", "x@y.z.co-d@e.com", ".a@b.co", "a.@b.co", "97.51.17.173", "1.2.3.4.5", "fe80::1", "x[1::2]",
            "(017) 555-7713", "415-555-0132", "2024-05-06", "4111 1111 1111 1111", "123-45-6789", "Dr. Anna Smith", "Mr. J. Smith",
            "Drink", "word", ",", "\\n", "é@ü.example", "0171 2345678", "MR. JOHN SMITH", "12345", "@", "a" * 40 + "1"]
    texts = ["".join(rnd.choice(bits) + rnd.choice([" ", " ", "", "; "]) for _ in range(rnd.randint(1, 14))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in surrogates.replace_entities(df, "key").collect()}
    plain = regex.compile(surrogates.ANY)
    found = 0
    for i, t in enumerate(texts):
        ends = [0, *[x for m in plain.finditer(t) for x in m.span()], len(t)]
        between = [t[a:b] for a, b in zip(ends[::2], ends[1::2])]
        found += len(between) - 1
        assert re.fullmatch("(.+)".join(map(re.escape, between)), got[i], re.S), (t, got[i])
        if len(between) == 1:
            assert got[i] == t
    assert found > 500
