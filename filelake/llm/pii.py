"""Format-preserving pseudonyms of personal numbers and dates, by keyed Feistel networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The formats that are looked for. Each stands alone, not inside a longer word or number.
BEFORE = r"(?<![0-9A-Za-z])"
AFTER = r"(?![0-9A-Za-z])"
# A domain has at most 127 labels; without a bound the pattern would recurse once for each.
EMAIL = r"(?<![A-Za-zÀ-ɏ0-9._%+-])[A-Za-zÀ-ɏ0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
CARD = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
SECRET = r"[0-9a-f]{64}|[0-9A-F]{64}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{32}|[0-9A-F]{32}"
# Earlier ones win where two start at the same place. The card numbers are those of the text with a right check digit.
BEFORE_CARDS = f"(?:{EMAIL}|{BEFORE}(?:{SECRET}|{SSN}|{DATE}|(?:{IPV4})(?!\\.?[0-9])"
AFTER_CARDS = f"){AFTER}|(?<![0-9A-Za-z.])(?:{PHONE}){AFTER})"
# Forms of card numbers, each looked for at every place, also inside a longer row of groups of digits.
CARD_FORMS = (
    r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}", r"[0-9]{4}(?:[ -][0-9]{4}){3}", r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
    r"[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,3}", r"[0-9]{13,19}",
)
FIRST_YEAR, YEARS, FIRST_LEAP_YEAR = 1900, 200, 1904
SSN_AREAS, SSN_REST = 898, 99 * 9999


def _prf(key: str, tweak: Column, step: Column, half: Column) -> Column:
    """256 pseudo-random bits, as hexadecimal digits, from one half of the value."""
    return F.sha2(F.concat_ws("|", F.lit(key), tweak, step.cast("string"), half.cast("string")), 512)


def permute_chars(value: Column, key: str, tweak: str) -> Column:
    """Permutation of the strings with the same classes of characters: digits, lower and upper case.

    A Feistel network: in every round each character of one half moves on in its class by a number from
    the other half. Characters of other classes stay.
    """

    def moved(char: Column, by: Column) -> Column:
        code = F.ascii(char)

        def within(first: int, size: int) -> Column:
            return F.char(F.lit(first) + (code - first + by) % size)

        return (
            F.when(code.between(48, 57), within(48, 10))
            .when(code.between(97, 122), within(97, 26))
            .when(code.between(65, 90), within(65, 26))
            .otherwise(char)
        )

    def half(chars: Column, random: Column) -> Column:
        # Two hexadecimal digits for each character; longer halves use them again.
        return F.array_join(
            F.transform(
                F.split(chars, ""),
                lambda c, i: moved(c, F.conv(F.substr(random, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")),
            ),
            "",
        )

    cut = (F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1).alias("r"))
    shape = F.concat(F.lit(tweak + ":"), F.length(value).cast("string"))

    def step(acc: Column, i: Column) -> Column:
        return F.struct(acc.r.alias("l"), half(acc.l, _prf(key, shape, i, acc.r)).alias("r"))

    # An even number of rounds puts the halves back in their places.
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda a: F.concat(a.l, a.r))
    return F.when(F.length(value) > 1, done).otherwise(value)


def permute_pair(a: Column, m: int, b: Column, n: int, key: str, tweak: str) -> Column:
    """Permutation of the pairs ``(a, b)`` below ``(m, n)``, as a struct."""

    def number(i: Column, half: Column, size: int) -> Column:
        return F.conv(F.substr(_prf(key, F.lit(tweak), i, half), F.lit(1), F.lit(15)), 16, 10).cast("long") % size

    def step(acc: Column, i: Column) -> Column:
        first = (acc.a + number(i, acc.b, m)) % m
        return F.struct(first.alias("a"), ((acc.b + number(i + 100, first, n)) % n).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, from the left, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(
            F.concat(acc.out, F.when(digit, F.substr(digits, acc.k + 1, F.lit(1))).otherwise(c)).alias("out"),
            F.when(digit, acc.k + 1).otherwise(acc.k).alias("k"),
        )

    return F.aggregate(F.split(template, ""), start, step, lambda a: a.out)


def _check_digit(body: Column) -> Column:
    """The digit that makes ``body`` and it a valid card number."""
    doubled = F.transform(
        F.split(F.reverse(body), ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, x: s + x)
    return ((10 - total % 10) % 10).cast("string")


def _is_card(digits: Column) -> Column:
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    return F.length(digits).between(13, 19) & (_check_digit(body) == F.right(digits, F.lit(1)))


def _card(value: Column, key: str) -> tuple[Column, Column]:
    digits = _digits(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    valid = _is_card(digits)
    renamed = permute_chars(body, key, "card")
    return valid, _refill(value, F.concat(renamed, _check_digit(renamed)))


def _all(text: Column) -> Column:
    """Pattern of everything that is looked for in ``text``: its own card numbers are written out, the longest first."""
    found = F.flatten(F.array(*[
        F.array_distinct(F.regexp_extract_all(text, F.lit(f"{BEFORE}(?=({form}){AFTER})"), F.lit(1))) for form in CARD_FORMS
    ]))
    valid = F.filter(F.transform(found, lambda v: F.struct(v.alias("v"), _digits(v).alias("d"))), lambda x: _is_card(x.d))
    # Only places that look like a card number are compared with the list; its last entry fits nothing.
    cards = F.array_join(F.concat(F.transform(valid, lambda x: x.v), F.array(F.lit("(?!)"))), "|")
    return F.concat(F.lit(f"{BEFORE_CARDS}|(?={'|'.join(CARD_FORMS)})(?:"), cards, F.lit(f"){AFTER_CARDS}"))


def _phone(value: Column, key: str) -> tuple[Column, Column]:
    digits = _digits(value)
    # The country code stays, so that a number is the same with and without it.
    code = F.substr(digits, F.lit(1), F.length(digits) - 10)
    return F.length(digits) >= 10, _refill(value, F.concat(code, permute_chars(F.right(digits, F.lit(10)), key, "phone")))


def _ipv4(value: Column, key: str) -> tuple[Column, Column]:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("int"))
    valid = ~F.exists(parts, lambda p: p > 255)
    new = permute_pair(parts[0] * 256 + parts[1], 65536, parts[2] * 256 + parts[3], 65536, key, "ipv4")
    text = F.concat_ws(".", *[F.floor(x).cast("string") for x in (new.a / 256, new.a % 256, new.b / 256, new.b % 256)])
    return valid, text


def _ssn(value: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.substr(value, F.lit(p), F.lit(n)).cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    new = permute_pair(area - F.when(area > 666, 2).otherwise(1), SSN_AREAS, (group - 1) * 9999 + serial - 1, SSN_REST, key, "ssn")
    new_area = new.a + F.when(new.a + 1 >= 666, 2).otherwise(1)
    return valid, F.concat_ws(
        "-", F.lpad(new_area.cast("string"), 3, "0"), F.lpad((F.floor(new.b / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((new.b % 9999 + 1).cast("string"), 4, "0"),
    )


def _date(value: Column, key: str) -> tuple[Column, Column]:
    """Dates of 1900 to 2099; 29 February moves among the leap years, other days among all."""
    iso = value.rlike("^[0-9]{4}-")
    mark = F.when(value.contains("/"), F.lit("/")).otherwise(F.lit("."))
    parts = F.transform(F.split(value, "[-/.]"), lambda p: p.cast("int"))
    year = F.when(iso, parts[0]).otherwise(parts[2])
    # With slashes the month is first unless that cannot be; with dots the day is.
    month_first = (mark == "/") & (parts[0] <= 12)
    month = F.when(iso, parts[1]).when(month_first, parts[0]).otherwise(parts[1])
    day = F.when(iso, parts[2]).when(month_first, parts[1]).otherwise(parts[0])
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    months = F.array(*[F.lit(n) for n in (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)])
    before = F.array(*[F.lit(n) for n in (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)])
    extra = leap & (month == 2) & (day == 29)
    known = year.between(FIRST_YEAR, FIRST_YEAR + YEARS - 1) & month.between(1, 12)
    valid = known & (day >= 1) & (extra | (day <= F.try_element_at(months, F.when(known, month).otherwise(1))))
    of_year = F.try_element_at(before, F.when(known, month).otherwise(1)) + day - 1
    new = permute_pair(year - FIRST_YEAR, YEARS, of_year, 365, key, "date")
    new_month = F.size(F.filter(before, lambda b: b <= new.b))
    new_day = new.b - F.try_element_at(before, new_month) + 1
    # 49 leap years, as 7 by 7.
    number = F.floor((year - FIRST_LEAP_YEAR) / 4)
    other = permute_pair(F.floor(number / 7), 7, number % 7, 7, key, "29 February")
    y = F.when(extra, other.a * 28 + other.b * 4 + FIRST_LEAP_YEAR).otherwise(new.a + FIRST_YEAR).cast("string")
    m = F.when(extra, 2).otherwise(new_month).cast("string")
    d = F.when(extra, 29).otherwise(new_day).cast("string")
    first, second = (F.when(month_first, a).otherwise(b) for a, b in ((m, d), (d, m)))
    texts = F.split(value, "[-/.]")

    def as_long(new: Column, old: Column) -> Column:
        return F.lpad(new, F.greatest(F.length(new), F.length(old)), "0")

    short = F.concat(as_long(first, texts[0]), mark, as_long(second, texts[1]), mark, y)
    return valid, F.when(iso, F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))).otherwise(short)


def _email(value: Column, key: str) -> tuple[Column, Column]:
    """The local part moves, the domain stays; upper and lower case are the same address."""
    local = F.substring_index(value, "@", 1)
    renamed = permute_chars(F.lower(local), key, "email")
    return F.lit(True), F.concat(
        F.when(local == F.upper(local), F.upper(renamed)).otherwise(renamed), F.lit("@"), F.substring_index(value, "@", -1)
    )


def _secret(value: Column, key: str) -> tuple[Column, Column]:
    """Hexadecimal digits move among themselves: each half by the other, 16 digits at a time."""

    def half(chars: Column, random: Column) -> Column:
        shifted = F.transform(
            F.split(chars, ""),
            lambda c, i: F.lower(F.hex((F.conv(c, 16, 10).cast("int") + F.conv(F.substr(random, i + 1, F.lit(1)), 16, 10).cast("int")) % 16)),
        )
        return F.array_join(shifted, "")

    low = F.lower(value)
    size = (F.length(value) / 2).cast("int")
    start = F.struct(F.substr(low, F.lit(1), size).alias("l"), F.substr(low, size + 1).alias("r"))

    def step(acc: Column, i: Column) -> Column:
        return F.struct(acc.r.alias("l"), half(acc.l, _prf(key, F.lit("secret"), i, acc.r)).alias("r"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda a: F.concat(a.l, a.r))
    return value.rlike("[0-9]") & value.rlike("[A-Fa-f]"), F.when(value == F.upper(value), F.upper(done)).otherwise(done)


def _renamed(value: Column, key: str) -> Column:
    """``(kind, value)`` of a match; both null where the value is not valid in its format."""

    def one(kind: str, made: tuple[Column, Column]) -> Column:
        valid, new = made
        return F.when(valid, F.struct(F.lit(kind).alias("kind"), new.alias("value")))

    return (
        F.when(value.contains("@"), one("email", _email(value, key)))
        .when(value.rlike(f"^(?:{SSN})$"), one("ssn", _ssn(value, key)))
        .when(value.rlike(f"^(?:{DATE})$"), one("date", _date(value, key)))
        .when(value.rlike(f"^(?:{IPV4})$"), one("ipv4", _ipv4(value, key)))
        .when(value.rlike(f"^(?:{CARD})$"), one("card", _card(value, key)))
        .when(value.rlike(f"^(?:{PHONE})$"), one("phone", _phone(value, key)))
        .when(value.rlike(f"^(?:{SECRET})$"), one("secret", _secret(value, key)))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal numbers and dates replaced in the text, and ``pseudonyms``.

    Looked for are e-mail addresses, telephone numbers, IPv4 addresses, card numbers with a right check digit, US
    social security numbers, dates of 1900 to 2099 and hexadecimal secrets. Numbers that only look alike
    (wrong check digit, impossible date) stay. A card number among other groups of digits is found
    in each of its forms; of several that start at one place the longest is taken. A pseudonym has the format of its value, is valid in it, and is the
    same for equal values under one ``key`` in all documents, however they are written; different values
    have different ones. Whole texts are read. ``pseudonyms`` lists ``(kind, value)`` of the new values in the order of
    the text and replaces a column of this name; it is empty where nothing was found.

    Null texts stay null, with none. Rows are changed one by one, so repeated rows stay equal; no rows give
    no rows; all other columns are kept.
    """
    text = F.col(text_col)
    # Texts without a digit or an at sign hold nothing: they are not searched.
    worth = text.rlike("[0-9@]")
    matches = F.when(worth, F.regexp_extract_all(text, F.col("__all"), F.lit(0)))
    found = docs.withColumn("__all", F.when(worth, _all(text))).withColumn("__matches", matches).withColumn(
        "__new", F.transform("__matches", lambda m: _renamed(m, key))
    )
    between = F.split(text, F.col("__all"), -1)
    parts = F.transform(
        between,
        lambda gap, i: F.concat(
            gap,
            F.coalesce(F.try_element_at("__new", i + 1)["value"], F.try_element_at("__matches", i + 1), F.lit("")),
        ),
    )
    return found.withColumns({
        text_col: F.when(F.size("__matches") > 0, F.array_join(parts, "")).otherwise(text),
        "pseudonyms": F.coalesce(
            F.filter("__new", lambda x: x.isNotNull()), F.array().cast("array<struct<kind:string,value:string>>")
        ),
    }).drop("__all", "__matches", "__new")
