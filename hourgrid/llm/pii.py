"""Personal data replaced by format-preserving pseudonyms, with built-in functions only.

Numbers and dates are found by one pattern and validated: card numbers by their check digit, account numbers (IBAN) by
their remainder, social-security numbers and IP addresses by their ranges, dates by the calendar.  What is valid is mapped
by a keyed Feistel network that permutes the values of its own format: half of the value is shifted by a keyed hash of the
other half, ten times in turn.  So a card number becomes another valid one, a date another date, separators stay, equal
values get equal pseudonyms in all documents, however they are written, and no table of them is kept.  E-mail addresses are
no numbers: their local part becomes a keyed hash, their domain a reserved one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col, text_of, whole_row

ROUNDS = 10

# What the kinds look like.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
DAY_DATE = r"\d{1,2}[./]\d{1,2}[./]\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
CARD = r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19}"
PHONE = r"\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{2,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
KINDS = (
    ("email", EMAIL), ("ip", IP), ("date", f"{ISO_DATE}|{DAY_DATE}"), ("ssn", SSN), ("iban", IBAN), ("card", CARD), ("phone", PHONE),
)
# no word before it, nor a number with a hyphen; behind it none but the time of a time stamp
BEFORE, BEHIND = r"(?<![\w.+])(?<!\d-)", r"(?!(?!T\d\d:)[\w@]|[.-]\d)"
PATTERN = BEFORE + "(?:" + "|".join(p for _, p in KINDS) + ")" + BEHIND
INNER = BEFORE + "(?:" + "|".join(p for k, p in KINDS if k != "iban") + ")" + BEHIND  # inside what looks like an account number but is none
# Country codes of telephone numbers of one and two digits; the others have three.
COUNTRY_CODE = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

# Blocks of dates: 400 years each from 1800 on and back, and what is left of the years 1 to 9999 at both ends.  A block has
# so many days, which are permuted among the first numbers of a product that is as large or a little larger.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"
EPOCH = "1800-01-01"
DAYS, DAYS_AS = 146_097, (189, 773)
FIRST_DAYS, LAST_DAYS, ENDS_AS = 72_683, 73_048, (271, 270)
WALKS = 16  # steps until a number is a day again; one step fails in under 1% of all cases


def _hash(key: str, *parts: Column) -> Column:
    """60 bits of a keyed hash, as a long."""
    whole = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(whole, 256), 1, 15), 16, 10).cast("long")


def _permuted(value: Column, high: Column, low: Column, key: str, domain: Column) -> Column:
    """A keyed permutation of the longs from 0 to ``high * low - 1``."""
    halves = F.struct(((value - value % low) / low).cast("long").alias("a"), (value % low).alias("b"))

    def mix(s: Column, i: Column) -> Column:
        left = F.struct(((s["a"] + _hash(key, domain, i, s["b"])) % high).alias("a"), s["b"].alias("b"))
        right = F.struct(s["a"].alias("a"), ((s["b"] + _hash(key, domain, i, s["a"])) % low).alias("b"))
        return F.when(i % 2 == 0, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, mix, lambda s: s["a"] * low + s["b"])


def _power(digits: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**k) for k in range(19)]), digits + 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _permuted_digits(digits: Column, key: str, domain: Column) -> Column:
    """As many digits again (18 at most)."""
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")
    value = _permuted(digits.cast("long"), _power(n - low), _power(low), key, F.concat_ws(",", domain, n.cast("string")))
    return F.lpad(value.cast("string"), n, "0")


def _permuted_run(digits: Column, key: str, domain: Column) -> Column:
    """As many digits again (36 at most): over 18, each half by a permutation that the other half chooses."""
    half = F.floor(F.length(digits) / 2).cast("int")
    a, b = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    moved = F.array(_permuted_digits(b, key, F.concat_ws(",", domain, a)))
    halves = F.transform(moved, lambda m: F.concat(_permuted_digits(a, key, F.concat_ws(",", domain, m)), m))[0]
    return F.when(F.length(digits) <= 18, _permuted_digits(digits, key, domain)).otherwise(halves)


def _refilled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, one after another."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(form, ""), start, put, lambda s: s["out"])


def _check_digit(payload: Column) -> Column:
    """The Luhn digit that belongs behind these digits."""

    def add(s: Column, c: Column) -> Column:
        twice = c.cast("int") * (F.lit(2) - s["i"] % 2)
        return F.struct((s["sum"] + twice - F.when(twice > 9, 9).otherwise(0)).alias("sum"), (s["i"] + 1).alias("i"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("i"))
    total = F.aggregate(F.split(F.reverse(payload), ""), start, add, lambda s: s["sum"])
    return ((10 - total % 10) % 10).cast("string")


def _card(m: Column, key: str) -> Column:
    """The first digit, which tells the kind of card, stays; the last checks the rest."""
    digits = _digits(m)
    n = F.length(digits)
    payload = F.substr(digits, F.lit(1), n - 1)
    valid = F.concat(payload, _check_digit(payload)) == digits
    fresh = F.concat(F.substring(digits, 1, 1), _permuted_digits(F.substr(digits, F.lit(2), n - 2), key, F.lit("card")))
    return F.when(valid, _refilled(m, F.concat(fresh, _check_digit(fresh))))


def _phone(m: Column, key: str) -> Column:
    """The country code stays; it is told by the digits alone, so a number has one pseudonym however it is written."""
    digits = _digits(m)
    code = F.when(m.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise(F.lit(""))
    return _refilled(m, F.concat(code, _permuted_run(F.substr(digits, F.length(code) + 1), key, F.lit("phone"))))


def _ip(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    valid = F.forall(parts, lambda p: p <= 255)
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s * 256 + p)
    new = F.array(_permuted(value, F.lit(1 << 16), F.lit(1 << 16), key, F.lit("ip")))
    dotted = F.transform(new, lambda v: F.concat_ws(".", *[(F.shiftright(v, s) % 256).cast("string") for s in (24, 16, 8, 0)]))
    return F.when(valid, dotted[0])


def _date(m: Column, key: str) -> Column:
    """Another day of the same 400 years; day first, or month first where that alone is a date."""
    iso = m.rlike(f"^{ISO_DATE}$")
    parts = F.split(m, "[./-]")
    two = lambda c: F.lpad(c, 2, "0")
    read = lambda *p: F.try_to_date(F.concat_ws("-", *p), "yyyy-MM-dd")
    day_first = F.when(iso, read(*[parts[k] for k in range(3)])).otherwise(read(parts[2], two(parts[1]), two(parts[0])))
    month_first = F.when(~iso, read(parts[2], two(parts[0]), two(parts[1])))
    date = F.coalesce(day_first, month_first)
    first, last, epoch = (F.lit(d).cast("date") for d in (FIRST_DAY, LAST_DAY, EPOCH))
    since = F.datediff(date, epoch).cast("long")
    start = since - F.pmod(since, F.lit(DAYS))  # of the block
    low, high = F.datediff(first, epoch).cast("long"), F.datediff(last, epoch).cast("long")
    start = F.greatest(start, low)
    days = F.when(start == low, FIRST_DAYS).when(start + DAYS > high + 1, LAST_DAYS).otherwise(DAYS).cast("long")
    a, b = (F.when(days == DAYS, DAYS_AS[k]).otherwise(ENDS_AS[k]) for k in (0, 1))
    step = lambda v: _permuted(v, a, b, key, F.lit("date"))
    moved = F.aggregate(F.sequence(F.lit(2), F.lit(WALKS)), step(since - start), lambda v, _: F.when(v < days, v).otherwise(step(v)))
    new = F.array(F.date_add(epoch, (start + moved).cast("int")))
    mark = F.regexp_extract(m, "[./]", 0)

    def written(d: Column) -> Column:
        plain = F.concat(F.date_format(d, "dd"), mark, F.date_format(d, "MM"), mark, F.date_format(d, "yyyy"))
        turned = F.concat(F.date_format(d, "MM"), mark, F.date_format(d, "dd"), mark, F.date_format(d, "yyyy"))
        return F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(day_first.isNotNull(), plain).otherwise(turned)

    return F.when(date.between(first, last), F.transform(new, written)[0])


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups and serials from 1."""
    parts = F.transform(F.split(m, "-"), lambda p: p.cast("long"))
    area, group, serial = parts[0], parts[1], parts[2]
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = area - F.when(area > 666, 2).otherwise(1)
    value = (place * 99 + group - 1) * 9999 + serial - 1
    new = F.array(_permuted(value, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn")))

    def written(v: Column) -> Column:
        first = F.floor(v / (99 * 9999))
        first = first + F.when(first >= 665, 2).otherwise(1)
        second = F.floor(v / 9999) % 99 + 1
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((first, 3), (second, 2), (v % 9999 + 1, 4))])

    return F.when(valid, F.transform(new, written)[0])


def _remainder(text: Column) -> Column:
    """Modulo 97, letters counting from 10."""

    def add(s: Column, c: Column) -> Column:
        letter = c.rlike("^[A-Z]$")
        return F.when(letter, (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    """Country and letters stay; the last digits, 18 at most, are permuted, and the check digits follow."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.substring(plain, 1, 2), F.substr(plain, F.lit(5))
    valid = _remainder(F.concat(body, F.substring(plain, 1, 4))) == 1
    digits = _digits(body)
    free = F.least(F.length(digits), F.lit(18))
    kept = F.length(digits) - free
    moved = F.when(free < 2, digits).otherwise(F.concat(F.substr(digits, F.lit(1), kept), _permuted_digits(F.substr(digits, kept + 1), key, F.lit("iban"))))
    new = F.array(_refilled(body, moved))
    check = F.transform(new, lambda b: F.concat(F.lpad((98 - _remainder(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), _digits(b)))
    return F.when(valid, F.concat(country, _refilled(F.substr(m, F.lit(3)), check[0])))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@example.invalid"))


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "iban": _iban, "card": _card, "phone": _phone}


def pseudonyms(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``row``, ``text`` with pseudonyms, ``n_replaced`` and ``n_<kind>`` for each kind.

    - Null texts stay null and count nothing; other texts stay as they are where nothing valid is found.
    - The key is part of the query's text: pass one made for the run.  Equal rows give equal rows; an empty table none.
    - Other columns are neither read nor changed: they are in ``row``.
    """
    text = text_of(docs, text_col)
    base = docs.select(col(id_col).alias("id"), whole_row(docs).alias("row"), text.alias("text"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("found"))

    def no_account(m: Column) -> Column:
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return m.rlike(f"^(?:{IBAN})$") & (_remainder(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))) != 1)

    def apart(whole: Column, matches: Column, pattern: str) -> Column:
        """Plain text and match in turn: what the pattern leaves, each with the match behind it."""
        return F.zip_with(F.split(whole, pattern, -1), matches, lambda b, m: F.struct(b.alias("plain"), m.alias("match")))

    # what looks like an account number and is none is looked through for other kinds
    inside = lambda m: apart(m, F.regexp_extract_all(m, F.lit(INNER), F.lit(0)), INNER)
    again = lambda p: F.when(p["match"].isNotNull() & no_account(p["match"]), F.concat(
        F.array(F.struct(p["plain"].alias("plain"), F.lit(None).cast("string").alias("match"))), inside(p["match"]))).otherwise(F.array(p))
    pieces = F.when(F.size("found") > 0, F.flatten(F.transform(apart(F.col("text"), F.col("found"), PATTERN), again)))
    base = base.withColumn("pieces", pieces).withColumn("found", F.transform("pieces", lambda p: p["match"]))

    def kind_of(m: Column) -> Column:
        kinds = None
        for name, pattern in KINDS:
            test = m.rlike(f"^(?:{pattern})$")
            kinds = F.when(test, name) if kinds is None else kinds.when(test, name)
        return kinds.otherwise("phone")

    def replaced(m: Column, kind: Column) -> Column:
        out = None
        for name, make in _MAKERS.items():
            out = F.when(kind == name, make(m, key)) if out is None else out.when(kind == name, make(m, key))
        return out

    named = base.withColumn("kinds", F.transform("found", lambda m: F.when(m.isNotNull(), kind_of(m))))
    done = named.withColumn("new", F.coalesce(F.zip_with("found", "kinds", replaced), F.array().cast("array<string>")))
    parts = F.zip_with("pieces", "new", lambda p, n: F.concat(p["plain"], F.coalesce(n, p["match"], F.lit(""))))
    valid = F.coalesce(F.filter(F.zip_with("kinds", "new", lambda k, v: F.when(v.isNotNull(), k)), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    done = done.withColumn("valid", valid)
    return done.select(
        "id", "row",
        F.when(F.col("row").getField(text_col).isNull(), None).when(F.col("pieces").isNull(), F.col("text")).otherwise(F.array_join(parts, "")).alias("text"),
        F.size("valid").cast("long").alias("n_replaced"),
        *[(F.size("valid") - F.size(F.array_remove("valid", name))).cast("long").alias(f"n_{name}") for name, _ in KINDS],
    )
