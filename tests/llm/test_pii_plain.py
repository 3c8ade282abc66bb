"""The pseudonyms of whole texts against a plain Python version, and that values stay valid in their formats."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from bylinelake.llm import pii

KEY = "k"
D, L = pii.DIGITS, pii.LETTERS


def sha(kind, i, value, key=KEY):
    return hashlib.sha256(f"{key}|{kind}|{i}|{value}".encode()).hexdigest()


def chars(s, alphabet, kind):
    a, b = s[: len(s) // 2], s[len(s) // 2 :]
    for i in range(1, pii.ROUNDS + 1):
        h = sha(kind, i, f"{len(s)}|{b}")
        a, b = b, "".join(alphabet[(alphabet.index(c) + int(h[2 * k : 2 * k + 2], 16)) % len(alphabet)] for k, c in enumerate(a))
    return a + b


def pair(l, r, m, n, kind):
    for i in range(1, pii.ROUNDS // 2 + 1):
        l = (l + int(sha(kind + "l", i, r)[:12], 16)) % m
        r = (r + int(sha(kind + "r", i, l)[:12], 16)) % n
    return l, r


def fill(template, new, places):
    new = iter(new)
    return "".join(next(new) if re.fullmatch(places, c) else c for c in template)


def luhn(d):
    return sum(x * 2 - 9 * (x > 4) if i % 2 else x for i, x in enumerate(map(int, reversed(d))))


def rest97(s):
    return int("".join(str((D + L.upper()).index(c)) for c in s[4:] + s[:4])) % 97


def ten(d):
    a, e, line = int(d[:3]), int(d[3:6]), int(d[6:])
    low, m, per, a0, e0 = (0, 200_000, 1000, 0, 0) if a < 200 else (1, 160_000, 200, 200, 0) if e < 200 else (2, 640_000, 800, 200, 200)
    l, r = pair((a - a0) * per + e - e0, line, m, 10_000, "phone")
    return f"{l // per + a0:03d}{l % per + e0:03d}{r:04d}"


def date(m):
    nums = [int(x) for x in re.split("[-./]", m)]
    iso = m[4] == "-"
    first = not iso and nums[1] > 12
    y, mo, d = nums if iso else (nums[2], *((nums[0], nums[1]) if first else (nums[1], nums[0])))
    try:
        day = datetime.date(y, mo, d)
    except ValueError:
        return m
    if not 100 <= y <= 9699:
        return m
    zero = datetime.date(1700, 1, 1)
    turn = lambda n: n // pii.DAYS * pii.DAYS + (lambda p: p[0] * pii.DATE_RIGHT + p[1])(pair(*divmod(n % pii.DAYS, pii.DATE_RIGHT), pii.DATE_LEFT, pii.DATE_RIGHT, "date"))
    at = lambda n: zero + datetime.timedelta(n)
    n = turn((day - zero).days)
    while first and at(n).day <= 12:
        n = turn(n)
    o, s = at(n), m[2]
    return f"{o.year:04d}-{o.month:02d}-{o.day:02d}" if iso else f"{o.month:02d}{s}{o.day:02d}{s}{o.year:04d}" if first else f"{o.day:02d}{s}{o.month:02d}{s}{o.year:04d}"


def one(m):
    digits = re.sub("[^0-9]", "", m)
    whole = lambda p: re.fullmatch(p.replace("++", "+").replace("}+", "}"), m)
    if "@" in m:
        local = m.split("@")[0]
        low = local.lower()
        out = fill(fill(local, chars(re.sub("[^a-z]", "", low), L, "email"), "[A-Za-z]"), chars(re.sub("[^0-9]", "", low), D, "email"), "[0-9]")
        return out + m[len(local) :]
    if re.match("[A-Z]", m):
        packed = m.replace(" ", "")
        inner = re.sub("[^0-9]", "", packed[4:])
        if rest97(packed) != 1 or len(inner) < 2:
            return m
        body = packed[:2] + "00" + fill(packed[4:], chars(inner, D, "iban"), "[0-9]")
        return fill(m, f"{body[:2]}{98 - rest97(body):02d}{body[4:]}", "[A-Z0-9]")
    if whole(pii.SSN):
        a, g, s = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if a in (0, 666) or a >= 900 or not g or not s:
            return m
        l, r = pair((a - 1 - (a > 666)) * 99 + g - 1, s - 1, 898 * 99, 9999, "ssn")
        a = l // 99 + 1
        return f"{a + (a > 665):03d}-{l % 99 + 1:02d}-{r + 1:04d}"
    if whole(pii.DATE):
        return date(m)
    if whole(pii.IPV4):
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return m
        l, r = pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4")
        return f"{l >> 8}.{l & 255}.{r >> 8}.{r & 255}"
    if whole(pii.PHONE):
        return fill(m, digits[:-10] + ten(digits[-10:]), "[0-9]")
    if m[0] == "+":
        return fill(m, digits[:2] + chars(digits[2:], D, "world"), "[0-9]") if 8 <= len(digits) <= 15 else m
    if luhn(digits) % 10:
        return m
    body = chars(digits[:-1], D, "card")
    return fill(m, body + str(-luhn(body + "0") % 10), "[0-9]")


def plain(text):
    if text is None:
        return None, 0
    got = [0]

    def sub(m):
        new = one(m[0])
        got[0] += new != m[0]
        return new

    pattern = pii.CANDIDATE if "@" in text else pii.NUMBER
    return re.sub(pattern, sub, text, flags=re.ASCII), got[0]


VALUES = [
    "12/31/1999", "05/06/2001", "31.12.1999", "2001-02-28", "2001-02-30", "1066-10-14", "2250-01-01", "0042-01-01", "99/99/2000", "13/13/2000",
    "378282246310005", "3782 822463 10005", "4111 1111 1111 1111", "4111-1111-1111-1112", "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "DE88370400440532013000",
    "+49 30 1234567", "+14155552671", "415 555 2671", "415-555-2671", "(012) 345-6789", "123-456-7890", "+1 (415) 555-2671", "+44 20 7946 0958", "100 200 3000",
    "123-45-6789", "000-12-3456", "666-12-3456", "899-99-9999", "10.0.0.255", "10.0.0.256", "jane.doe99@example.org", "a@b.co", "x+1@y.example.com", "+12", "1234567",
]


def check(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: (r["text"], r["n"]) for r in pii.pseudonymise(df, KEY, "text", "n").collect()}
    for i, t in enumerate(rows):
        assert out[i] == plain(t), t
    return out


def test_formats_against_plain_python(spark):
    out = check(spark, [f"see {v} there" for v in VALUES] + [" ; ".join(VALUES), None, "", VALUES[0]] + [VALUES[0]] * 3)
    assert {i for i, v in enumerate(VALUES) if not out[i][1]} == {VALUES.index(v) for v in ("2001-02-30", "0042-01-01", "99/99/2000", "13/13/2000", "4111-1111-1111-1112", "DE88370400440532013000", "100 200 3000", "000-12-3456", "666-12-3456", "10.0.0.256", "+12", "1234567")}


def test_documents_against_plain_python(spark, sf):
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    check(spark, docs)


@pytest.mark.parametrize("make, valid", [
    (lambda g: f"{g.choice([*range(1, 666), *range(667, 900)]):03d}-{g.randrange(1, 100):02d}-{g.randrange(1, 10000):04d}", lambda s: re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", s)),
    (lambda g: f"{g.randrange(200, 1000)}-{g.randrange(200, 1000)}-{g.randrange(10000):04d}", lambda s: re.fullmatch(r"[2-9]\d\d-[2-9]\d\d-\d{4}", s)),
    (lambda g: f"{g.randrange(1, 13):02d}/{g.randrange(13, 29)}/{g.randrange(1900, 2030)}", lambda s: int(s[3:5]) > 12 and datetime.date(int(s[6:]), int(s[:2]), int(s[3:5]))),
])
def test_closed_and_one_to_one(spark, make, valid):
    g = random.Random(1)
    values = sorted({make(g) for _ in range(2000)})
    out = spark.createDataFrame([(v,) for v in values], "v string").select(pii.pseudonym(F.col("v"), KEY).alias("p")).collect()
    assert len({r["p"] for r in out}) == len(values) and all(valid(r["p"]) for r in out)
