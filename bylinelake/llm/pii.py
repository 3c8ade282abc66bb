"""Format-preserving pseudonyms for validated personal values, in DataFrame functions only.

Candidates are cut out of a text by one regular expression, validated (Luhn, octet range, calendar, number plan) and
permuted by a keyed Feistel network within their own format; the pieces are joined again around them. The permutation has
no per-document input, so equal values get equal pseudonyms everywhere, and it is one-to-one within a format: pseudonyms
are valid like the values. Values that fail validation stay as they are, and so do the domains of e-mail addresses.

Dates are read year first, or day first where that is possible, else month first. Ten digits are telephone numbers in the
layouts of the North American plan; other countries' need a plus sign. Null and empty texts, and columns of any name, pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{2,63}+){1,8}"
#: Ten digits of the North American plan, with or without a country code.
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w)])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])|(?<![\w+])\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?![\w-])|(?<![\w.-])(?<!\d )[2-9]\d{2} [2-9]\d{2} \d{4}(?![\w-]| \d)"
#: Other numbers with a country code; 8 to 15 digits are valid.
WORLD = r"(?<![\w+])\+[2-9]\d{0,2}(?:[ .-]?\(?\d{2,5}\)?)?(?:[ .-]?\d{2,4}){1,3}(?![\w-])"
CARD = r"(?<!\w)\d{13,19}(?!\w)|(?<![\w-])\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?![\w-])|(?<![\w-])\d{4}[ -]\d{6}[ -]\d{5}(?![\w-])"
IPV4 = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\w./-])\d{2}[./]\d{2}[./]\d{4}(?!\d)"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
NUMBER = "(?=[0-9+(])(?:" + "|".join((PHONE, WORLD, CARD, SSN, DATE, IPV4)) + ")|" + IBAN
CANDIDATE = f"{EMAIL}|{NUMBER}"

#: 1700-01-01 and the days of a Gregorian cycle of 400 years: 146,097 = 189 * 773. A date stays in its cycle.
FIRST_DAY, DAYS, DATE_LEFT, DATE_RIGHT = "1700-01-01", 146_097, 189, 773
#: Steps at most until a date written month first has a day over 12 again; six in ten days are.
WALK = 64


def let(value: Column, use) -> Column:
    """use(value) with value computed once, however often use mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hash(key: str, kind: str, i: Column, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), i.cast("string"), F.lit("|"), value).cast("binary"), 256)


def _hex(h: Column, at: Column, n: int) -> Column:
    return F.conv(F.substring(h, at, F.lit(n)), 16, 10).cast("long")


def feistel(s: Column, alphabet: str, key: str, kind: str) -> Column:
    """A keyed permutation of the strings of s's length over alphabet (2 to 64 characters; shorter ones shift by the key)."""
    q, n = len(alphabet), F.length(s)
    left = F.floor(n / 2).cast("int")

    def step(acc: Column, i: Column) -> Column:
        a, b = acc["a"], acc["b"]
        moved = let(_hash(key, kind, i, F.concat(n.cast("string"), F.lit("|"), b)), lambda h: F.array_join(F.transform(F.sequence(F.lit(1), F.length(a)), lambda at: _shift(a, h, at, alphabet)), ""))
        return F.struct(b.alias("a"), F.when(F.length(a) > 0, moved).otherwise(F.lit("")).alias("b"))

    start = F.struct(F.substring(s, F.lit(1), left).alias("a"), F.substring(s, left + 1, n).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda done: F.concat(done["a"], done["b"]))


def _shift(a: Column, h: Column, at: Column, alphabet: str) -> Column:
    place = F.instr(F.lit(alphabet), F.substring(a, at, F.lit(1))) - 1 + _hex(h, 2 * at - 1, 2)
    return F.substring(F.lit(alphabet), (place % len(alphabet) + 1).cast("int"), F.lit(1))


def pair_feistel(left: Column, right: Column, m: int | Column, n: int, key: str, kind: str) -> Column:
    """A keyed permutation of pairs (left below m, right below n), as a struct of both."""

    def step(acc: Column, i: Column) -> Column:
        l = (acc["l"] + _hex(_hash(key, kind + "l", i, acc["r"].cast("string")), F.lit(1), 12)) % m
        return let(l, lambda l: F.struct(l.alias("l"), ((acc["r"] + _hex(_hash(key, kind + "r", i, l.cast("string")), F.lit(1), 12)) % n).alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def refill(template: Column, chars: Column, places: str) -> Column:
    """template with its characters that match the class `places` replaced, in order, by those of chars."""

    def fill(chars: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            c = F.substring(template, i, F.lit(1))
            here = c.rlike(places)
            return F.struct(F.concat(acc["out"], F.when(here, F.substring(chars, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + here.cast("int")).alias("k"))

        return F.aggregate(F.sequence(F.lit(1), F.length(template)), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step, lambda acc: acc["out"])

    return let(chars, fill)


def luhn_total(digits: Column) -> Column:
    def total(s: Column) -> Column:
        def term(acc: Column, i: Column) -> Column:
            d = F.substring(s, F.length(s) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + d - F.when(d > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), term)

    return let(digits, total)


def iban_rest(s: Column) -> Column:
    """The number that an account number without blanks spells, modulo 97."""
    moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def rest(t: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            v = F.instr(F.lit(DIGITS + LETTERS.upper()), F.substring(t, i, F.lit(1))) - 1
            return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(t)), F.lit(0), step)

    return let(moved, rest)


def _padded(n: Column, digits: int) -> Column:
    return F.lpad(n.cast("string"), digits, "0")


def _ssn(m: Column, digits: Column, key: str) -> Column:
    """Valid ones are area 001 to 899 but for 666, group from 01, serial from 0001; they are numbered without gaps."""
    area, group, serial = (F.substring(digits, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (4, 2), (6, 4)))
    bad = m.rlike("^(000|666|9)") | m.rlike("^...-00") | m.rlike("0000$")
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1

    def shown(p: Column) -> Column:
        a = F.floor(p["l"] / 99) + 1
        return F.concat_ws("-", _padded(a + F.when(a > 665, 1).otherwise(0), 3), _padded(p["l"] % 99 + 1, 2), _padded(p["r"] + 1, 4))

    return F.when(bad, m).otherwise(let(pair_feistel(left, serial - 1, 898 * 99, 9999, key, "ssn"), shown))


def _ten_digits(ten: Column, key: str) -> Column:
    """Numbers of the plan (area code and exchange from 200) stay in it, the other two kinds of ten digits among themselves."""
    area, exchange, line = (F.substring(ten, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (4, 3), (7, 4)))
    by = lambda low, part, whole: F.when(area < 200, low).when(exchange < 200, part).otherwise(whole)
    left = by(area * 1000 + exchange, (area - 200) * 200 + exchange, (area - 200) * 800 + exchange - 200)

    def shown(p: Column) -> Column:
        a = by(F.floor(p["l"] / 1000), F.floor(p["l"] / 200) + 200, F.floor(p["l"] / 800) + 200)
        return F.concat(_padded(a, 3), _padded(by(p["l"] % 1000, p["l"] % 200, p["l"] % 800 + 200), 3), _padded(p["r"], 4))

    return let(pair_feistel(left, line, by(F.lit(200_000), F.lit(160_000), F.lit(640_000)), 10_000, key, "phone"), shown)


def _date(m: Column, key: str) -> Column:
    """Year first, day first, or month first where the second number is over 12; the last walk on until it is so again."""
    iso, sep, first = m.rlike("^[0-9]{4}-"), F.substring(m, 3, 1), F.lit(FIRST_DAY).cast("date")
    plain = F.regexp_replace(m, "[./]", "-")
    month_first = ~iso & (F.substring(m, 4, 2) > "12")
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).when(month_first, F.try_to_date(plain, "MM-dd-yyyy")).otherwise(F.try_to_date(plain, "dd-MM-yyyy"))

    def turned(number: Column) -> Column:
        cycle = F.floor(number / DAYS)
        within = number - cycle * DAYS
        return let(pair_feistel(F.floor(within / DATE_RIGHT), within % DATE_RIGHT, DATE_LEFT, DATE_RIGHT, key, "date"), lambda p: cycle * DAYS + p["l"] * DATE_RIGHT + p["r"])

    at = lambda number: F.date_add(first, number.cast("int"))
    walked = lambda number: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), turned(number), lambda acc, i: F.when(F.dayofmonth(at(acc)) > 12, acc).otherwise(turned(acc)))

    def shown(other: Column) -> Column:
        d, mo, y = (F.date_format(other, x) for x in ("dd", "MM", "yyyy"))
        return F.when(iso, F.date_format(other, "yyyy-MM-dd")).when(month_first, F.concat(mo, sep, d, sep, y)).otherwise(F.concat(d, sep, mo, sep, y))

    other = let(F.datediff(day, first).cast("long"), lambda number: F.when(month_first, walked(number)).otherwise(turned(number)))
    return F.when(F.year(day).between(100, 9699), let(at(other), shown)).otherwise(m)


def _iban(m: Column, key: str) -> Column:
    """Letters and blanks stay, digits after the check digits are permuted, and the check digits are made anew."""
    packed = F.regexp_replace(m, " ", "")
    inner = F.regexp_replace(F.substring(packed, F.lit(5), F.length(packed)), "[^0-9]", "")
    body = F.concat(F.substring(m, 1, 2), F.lit("00"), let(feistel(inner, DIGITS, key, "iban"), lambda d: refill(F.substring(packed, F.lit(5), F.length(packed)), d, "[0-9]")))
    checked = let(body, lambda b: F.concat(F.substring(b, 1, 2), _padded(98 - iban_rest(b), 2), F.substring(b, F.lit(5), F.length(b))))
    return F.when((iban_rest(packed) == 1) & (F.length(inner) > 1), refill(m, checked, "[A-Z0-9]")).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate, or the candidate itself if it is not valid in its format."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    local = F.substring_index(m, "@", 1)
    part = lambda alphabet, other: feistel(F.regexp_replace(F.lower(local), other, ""), alphabet, key, "email")
    named = refill(refill(local, part(LETTERS, "[^a-z]"), "[A-Za-z]"), part(DIGITS, "[^0-9]"), "[0-9]")
    email = F.concat(named, F.substring(m, F.length(local) + 1, F.length(m)))

    checked = lambda body: F.concat(body, ((10 - luhn_total(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    turned_card = lambda d: let(feistel(F.substring(d, F.lit(1), F.length(d) - 1), DIGITS, key, "card"), checked)
    card = F.when(luhn_total(digits) % 10 == 0, refill(m, let(digits, turned_card), "[0-9]")).otherwise(m)

    lead = F.length(digits) - 10
    phone = refill(m, F.concat(F.substring(digits, F.lit(1), lead), let(F.substring(digits, lead + 1, F.lit(10)), lambda d: _ten_digits(d, key))), "[0-9]")
    abroad = refill(m, F.concat(F.substring(digits, 1, 2), let(F.substring(digits, F.lit(3), F.length(digits)), lambda d: feistel(d, DIGITS, key, "world"))), "[0-9]")
    world = F.when(F.length(digits).between(8, 15), abroad).otherwise(m)

    octet = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") for i in range(1, 5)]
    moved = pair_feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536, key, "ipv4")
    dotted = lambda p: F.concat_ws(".", *(x.cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256)))
    ipv4 = F.when(F.greatest(*octet) < 256, let(moved, dotted)).otherwise(m)

    return (
        F.when(m.contains("@"), email)
        .when(m.rlike("^[A-Z]"), _iban(m, key))
        .when(m.rlike(f"^(?:{SSN})$"), let(digits, lambda d: _ssn(m, d, key)))
        .when(m.rlike(f"^(?:{DATE})$"), _date(m, key))
        .when(m.rlike(f"^(?:{IPV4})$"), ipv4)
        .when(m.rlike(f"^(?:{PHONE})$"), phone)
        .when(m.startswith("+"), world)
        .otherwise(card)
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with the personal values of text_col replaced, and the number of replaced values in count_col if it is named.

    Null and empty texts stay as they are (0 values). All rows and other columns stay. An existing count_col is replaced.
    """
    text = F.col(f"`{text_col}`")
    pattern = F.when(text.contains("@"), F.lit(CANDIDATE)).otherwise(F.lit(NUMBER))
    some = text.rlike("[0-9@]") & F.rlike(text, pattern)
    cut = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.struct(m.alias("was"), pseudonym(m, key).alias("now")))
    between = F.split(text, pattern, -1)
    cols = docs.withColumn("__pii", F.when(some, F.struct(cut.alias("cut"), between.alias("between"))))
    cut, between = F.col("__pii.cut"), F.col("__pii.between")
    joined = let(cut, lambda c: F.array_join(F.transform(between, lambda x, i: F.concat(x, F.coalesce(F.get(c, i)["now"], F.lit("")))), ""))
    out = cols.withColumn(text_col, F.when(F.col("__pii").isNotNull(), joined).otherwise(text))
    if count_col:
        out = out.withColumn(count_col, F.coalesce(F.size(F.filter(cut, lambda c: c["was"] != c["now"])), F.lit(0)))
    return out.drop("__pii")
