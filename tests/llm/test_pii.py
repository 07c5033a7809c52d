import datetime as dt
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from hourgrid.llm import pii, queries

TEXTS = {
    1: "card 4041894974608795, and 4041-8949-7460-8795 or 4041 8949 7460 8795. bad 4041894974608796",
    2: "call +1 (988) 555-2485, 555-123-4567 or +49 30 123456",
    3: "ip 70.123.182.155 not 300.1.1.1",
    4: "born 1984-02-29, 29.02.1984, 31/12/1999; bad 1983-02-29",
    5: "ssn 123-45-6789 bad 000-12-3456",
    6: "DE89370400440532013000 and GB82 WEST 1234 5698 7654 32 bad DE89370400440532013001",
    7: "bob.42@mail8.example.com. BOB.42@MAIL8.example.com",
    8: None, 9: "", 10: "nothing 12 here, 3.14 and 2024", 11: "é4041894974608795é", 12: "x " * 200_000 + "4041894974608795",
}


def luhn(text):
    digits = [int(c) for c in reversed(text)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def mod97(iban):
    iban = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


@pytest.fixture(scope="module")
def done(spark):
    docs = spark.createDataFrame([(i, t, "a", 1, "r") for i, t in TEXTS.items()], "doc_id long, text string, found string, n_card int, row string")
    return {r.id: r for r in pii.pseudonyms(docs, "key").collect()}


def test_forms_and_validity(done):
    a, b, c, bad = re.findall(r"\d[\d -]+\d", done[1].text)
    assert luhn(a) and re.sub("[ -]", "", b) == re.sub("[ -]", "", c) == a != "4041894974608795" and a[0] == "4" and bad == "4041894974608796"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}, \d{3}-\d{3}-\d{4} or \+49 \d{2} \d{6}", done[2].text) and "555-2485" not in done[2].text
    ip = re.match(r"ip (\S+) not 300\.1\.1\.1$", done[3].text)[1]
    assert ip != "70.123.182.155" and all(0 <= int(p) <= 255 for p in ip.split("."))
    iso, day, third = re.match(r"born (\S+), (\S+), (\S+); bad 1983-02-29$", done[4].text).groups()
    assert dt.date.fromisoformat(iso) == dt.datetime.strptime(day, "%d.%m.%Y").date() != dt.date(1984, 2, 29)
    assert dt.datetime.strptime(third, "%d/%m/%Y")
    assert re.fullmatch(r"ssn (?!123)\d{3}-\d{2}-\d{4} bad 000-12-3456", done[5].text)
    ibans = re.match(r"(DE\d{20}) and (GB\d\d WEST \d{4} \d{4} \d{4} \d\d) bad DE89370400440532013001$", done[6].text).groups()
    assert all(mod97(i) == 1 for i in ibans) and ibans[0] != "DE89370400440532013000"
    one, two = re.findall(r"\S+@example.invalid", done[7].text)
    assert one == two


def test_the_rest_stays(done):
    assert done[8].text is None and done[8].n_replaced == 0 and done[9].text == "" and done[10].text == TEXTS[10]
    assert done[12].text.startswith("x " * 200_000) and done[12].n_card == 1 and done[12].text[-16:] == done[1].text[5:21]
    assert done[1].n_replaced == done[1].n_card == 3 and done[4].n_date == 3 and done[1].row.found == "a"


def test_keys_and_repeats(spark):
    docs = spark.createDataFrame([(None, TEXTS[1]), (1, TEXTS[1]), (1, TEXTS[1])], "doc_id long, text string")
    texts = lambda key: [r.text for r in pii.pseudonyms(docs, key).collect()]
    assert len(set(texts("a"))) == 1 and texts("a") != texts("b") and texts("a") == texts("a")
    assert pii.pseudonyms(docs.limit(0), "a").count() == 0


@pytest.mark.parametrize(("high", "low"), [(189, 773), (10, 10), (1000, 10), (7, 1)])
def test_it_is_a_permutation(spark, high, low):
    got = spark.range(high * low).select(pii._permuted(F.col("id"), F.lit(high), F.lit(low), "key", F.lit("test")).alias("v"))
    assert got.agg(F.count_distinct("v"), F.min("v"), F.max("v")).first()[:] == (high * low, 0, high * low - 1)


@pytest.mark.parametrize("n", range(18, 24))
def test_phones_of_many_digits(spark, n):
    """Such a run is one phone to the pattern; it gets as many other digits and leaves the other rows alone."""
    digits = "999" + "9" * (n - 3)
    grouped = "+999 " + " ".join(digits[3:][i:i + 4] for i in range(0, n - 3, 4))
    texts = [f"+{digits}", f"+{digits[:-1]}8", "+999" + digits[3:5] + "0" * (n - 5), "plain"] + [grouped] * (n % 4 != 0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.id: r for r in pii.pseudonyms(docs, "key").collect()}
    for i, text in enumerate(texts):
        assert re.sub(r"\d", "0", got[i].text) == re.sub(r"\d", "0", text)
        assert got[i].n_phone == (text != "plain") and (got[i].text == text) == (text == "plain")
    assert len({re.sub(r"\D", "", got[i].text) for i in range(3)}) == 3
    if n % 4:
        assert re.sub(r"\D", "", got[4].text) == got[0].text[1:]


def test_long_runs_are_permuted(spark):
    """No two runs of 19 digits share a pseudonym, whichever half they differ in."""
    runs = spark.range(2000).select(F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.lit("0" * 15)).alias("d"))
    runs = runs.union(spark.range(1, 2000).select(F.lpad(F.col("id").cast("string"), 19, "0").alias("d")))
    got = [r.v for r in runs.select(pii._permuted_run(F.col("d"), "key", F.lit("test")).alias("v")).collect()]
    assert len(set(got)) == len(got) == 3999 and {len(v) for v in got} == {19}


def changed(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in sorted(pii.pseudonyms(docs, "key").collect(), key=lambda r: r.id)]


def test_dates_keep_four_digit_years(spark):
    days = ["9999-12-31", "31.12.9999", "9800-01-01", "0001-01-01", "0199-12-31", "0200-01-01", "9799-12-31", "1800-01-01", "2199-12-31"]
    got = changed(spark, *days)
    for old, new in zip(days, got):
        assert re.sub(r"\d", "0", old) == re.sub(r"\d", "0", new) != new
    read = [dt.date.fromisoformat(x) for x in got if "." not in x]
    years = [(9800, 9999), (9800, 9999), (1, 199), (1, 199), (200, 599), (9400, 9799), (1800, 2199), (1800, 2199)]
    assert all(a <= d.year <= b for d, (a, b) in zip(read, years))
    assert dt.datetime.strptime(got[1], "%d.%m.%Y").date() == read[0]


def test_dates_of_every_block_are_permuted(spark):
    for start, n in (("0001-01-01", pii.FIRST_DAYS), ("9800-01-01", pii.LAST_DAYS)):
        days = spark.range(n).select(F.date_format(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
        got = days.select(pii._date(F.col("d"), "key").alias("v"))
        low, high = days.agg(F.min("d"), F.max("d")).first()
        assert got.agg(F.count_distinct("v"), F.min("v"), F.max("v")).first()[:] == (n, low, high)


def test_borders_and_other_forms(spark):
    card, day = "4111111111111111", "1990-05-05"
    plain = changed(spark, card, day, "+15551234567", "25.12.1990")
    got = changed(spark, f"x-{card}", f"{day}T10:00", "12/25/1990", "NR12 4111 1111 1111 1111", "+1 555 123 4567", "AT12 4111 1111 1111 1111 and", f"{card}-1", "+49 30 123456 +4930123456")
    assert got[0] == f"x-{plain[0]}" and plain[0] != card and got[1] == f"{plain[1]}T10:00" and plain[1] != day
    assert dt.datetime.strptime(got[2], "%m/%d/%Y") == dt.datetime.strptime(plain[3], "%d.%m.%Y")
    assert got[3][:5] == "NR12 " and got[3][5:].replace(" ", "") == plain[0] and got[5].startswith("AT12 ") and got[5][5:24].replace(" ", "") == plain[0]
    assert re.sub(r"\D", "", got[4]) == plain[2][1:] and plain[2][:2] == "+1" and plain[2] != "+15551234567"
    assert got[6] == f"{card}-1"  # part of a longer number
    a, b = re.fullmatch(r"(\+49 \d\d \d{6}) (\+49\d{8})", got[7]).groups()
    assert a.replace(" ", "") == b


def plain_finder(text):
    """Valid values found without the module's patterns, token by token: cards, dates and addresses of computers."""
    found = set()
    for token in re.split(r"[\s,;:()<>\"']+", text):
        token = token.strip(".")
        if token.isascii() and token.isdigit() and 13 <= len(token) <= 19 and luhn(token):
            found.add(token)
        parts = token.split(".")
        if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
            found.add(token)
        try:
            if len(token) == 10 and token[4] == token[7] == "-":
                dt.date.fromisoformat(token)
                found.add(token)
        except ValueError:
            pass
        if re.fullmatch(r"[^@]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", token) and token.isascii():
            found.add(token)
    return found


def test_an_independent_finder_finds_nothing_left(spark, sf_dir):
    before = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    seen = 0
    for r in queries.op4_pii(spark, sf_dir).collect():
        old = plain_finder(before[r.doc_id] or "")
        seen += len(old)
        assert not [v for v in old & plain_finder(r.text or "") if "example.invalid" not in v]
    assert seen > 5


def test_only_built_in_functions(spark, sf_dir):
    plan = queries.op4_pii(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark, sf_dir):
    """Nothing valid is left, nothing else is touched, equal values stay linked."""
    before = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    after = {r.doc_id: r for r in queries.op4_pii(spark, sf_dir).collect()}
    assert after.keys() == before.keys()
    pattern = re.compile(pii.PATTERN, re.ASCII)
    names = {}
    for i, text in before.items():
        old, new = pattern.split(text), pattern.split(after[i].text)
        assert len(old) == len(new)
        for a, b in zip(pattern.findall(text), pattern.findall(after[i].text)):
            if re.fullmatch(r"\d{13,19}", a):
                assert (a != b) == luhn(a) and luhn(b) == luhn(a)
            if "@" in a:
                assert b.endswith("@example.invalid")
            assert names.setdefault(a, b) == b
        kept = pattern.sub("", text)
        assert kept == re.sub(r"u[0-9a-f]{16}@example\.invalid", "", pattern.sub("", after[i].text))
    assert rows(queries.op4_pii(spark, sf_dir).selectExpr("sum(n_replaced) > 0")) == [(True,)]
