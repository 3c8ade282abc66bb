"""Identity and normalisation of works, authors, institutions and titles, as Column expressions.

Python is used only where Spark has no built-in: Unicode decomposition and HTML entities.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_doi(doi: Column) -> Column:
    """Lower-case DOI without resolver prefix; empty is null."""
    return _null_if_empty(F.regexp_replace(F.lower(F.trim(doi)), r"^https?://(dx\.)?doi\.org/", ""))


def title_key(title: Column) -> Column:
    """Title for work keys: tags out, runs of other than letters and digits as one hyphen."""
    plain = F.regexp_replace(F.coalesce(title, F.lit("")), "<[^>]+>", " ")
    return F.regexp_replace(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def words_key(text: Column) -> Column:
    """Names and containers: lower case, runs of other than letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def work_key(doi: Column, title: Column, venue: Column, year: Column) -> Column:
    return F.coalesce(F.concat(F.lit("doi:"), norm_doi(doi)), F.concat(F.lit("vt:"), F.concat_ws("|", venue, year.cast("string"), title_key(title))))


def openalex_key(value: Column) -> Column:
    return _null_if_empty(F.regexp_extract(F.coalesce(value, F.lit("")), r"(?:^|/)(W\d+)$", 1))


def record_key(doi: Column, ident: Column, openalex: Column, corpus: Column, title: Column, venue: Column, year: Column) -> Column:
    """First of DOI, catalogue id (from either column), corpus id, then venue, year and title."""
    w = F.coalesce(openalex_key(ident), openalex_key(openalex))
    return F.coalesce(F.concat(F.lit("doi:"), norm_doi(doi)), F.concat(F.lit("openalex:"), w), F.concat(F.lit("s2:"), corpus.cast("string")), work_key(F.lit(None).cast("string"), title, venue, year))


def institution_id(value: Column) -> Column:
    """Bare I-numbers become URLs, http becomes https, trailing slashes go."""
    v = F.trim(value)
    url = F.regexp_replace(F.regexp_replace(v, "/+$", ""), "^http://", "https://")
    return F.when(v.rlike(r"^I\d+$"), F.concat(F.lit("https://openalex.org/"), v)).otherwise(url)


def short_id(value: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(value, "/+$", ""), "/"), -1)


def row_key(raw: Column) -> Column:
    return F.substring(F.sha1(raw.cast("binary")), 1, 16)


def slug(text: Column) -> Column:
    s = F.replace(F.lower(text), F.lit("&"), F.lit(" and "))
    return F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def author_slug(given: Column, family: Column) -> Column:
    return F.coalesce(_null_if_empty(slug(fold(F.concat_ws(" ", given, family)))), F.lit("unknown"))


@F.pandas_udf(T.StringType())
def fold(text):
    """Decomposed, without combining marks, case-folded, words of letters and digits joined by one blank."""
    import re
    import unicodedata

    def one(t):
        if t is None:
            return None
        bare = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        return " ".join(re.findall(r"[^\W_]+", bare.casefold()))

    return text.map(one, na_action=None).where(text.notna(), None)


@F.pandas_udf(T.StringType())
def unescape(text):
    """HTML entities decoded until nothing changes, three times at most."""
    import html

    def one(t):
        for _ in range(3):
            new = html.unescape(t)
            if new == t:
                break
            t = new
        return t

    return text.map(one, na_action="ignore")


@F.pandas_udf(T.StringType())
def plain(text):
    """HTML entities decoded once and combining marks dropped."""
    import html
    import unicodedata

    def one(t):
        return "".join(c for c in unicodedata.normalize("NFKD", html.unescape(t)) if not unicodedata.combining(c))

    return text.map(one, na_action="ignore")


def alnum_key(text: Column) -> Column:
    """Letters and digits only, folded; null gives an empty string."""
    return F.replace(F.coalesce(fold(text), F.lit("")), F.lit(" "), F.lit(""))


def query_words(title: Column) -> Column:
    """Words of a title for a search, entities decoded; null gives an empty string."""
    return F.trim(F.regexp_replace(F.coalesce(unescape(title), F.lit("")), r"[^\p{L}\p{N}_]+", " "))


#: Words of institution names and what they stand for. Fixed values.
NAME_WORDS = {"univ": "university", "inst": "institute", "natl": "national", "acad": "academy", "lab": "laboratory", "labs": "laboratories"}


def institution_words(name: Column) -> Column:
    """Institution name for matching: entities decoded, no marks, & as and, no article, abbreviations spelled out."""
    words = F.split(words_key(F.replace(plain(name), F.lit("&"), F.lit(" and "))), " ")
    spelled = F.create_map(*(F.lit(x) for pair in NAME_WORDS.items() for x in pair))
    return F.array_join(F.transform(F.filter(words, lambda w: w != "the"), lambda w: F.coalesce(F.try_element_at(spelled, w), w)), " ")


def family_in_name(family: Column, name: Column) -> Column:
    """The family name's words stand in the name as a run of whole words."""
    f = words_key(family)
    return (f != "") & F.contains(F.concat(F.lit(" "), words_key(name), F.lit(" ")), F.concat(F.lit(" "), f, F.lit(" ")))


def strip_version(doi: Column) -> Column:
    return F.regexp_replace(norm_doi(doi), r"v\d+$", "")


def year_plausible(doi: Column, found: Column, edition: Column) -> Column:
    """Preprints may be two years early and one late; others one year either way."""
    early = F.when(norm_doi(doi).startswith("10.48550/arxiv"), 2).otherwise(1)
    return found.between(edition - early, edition + 1)


def matches_prefix(doi: Column, prefixes: Column) -> Column:
    """The DOI begins with one of the comma-separated prefixes."""
    return F.exists(F.split(prefixes, r"\s*,\s*"), lambda p: (p != "") & norm_doi(doi).startswith(p))


#: Phrases of venue names and their short forms, in this order; the first of each is shortened. Fixed values.
VENUE_SHORT = (
    (r"^Symposium on ", ""),
    (r"^(.*?) / .*$", "$1"),
    (r"^(.*?)Transactions on ", "$1Trans. "),
    (r"^(.*?)Journal o[fn] ", "$1J. "),
    (r"^(.*?)(?:Emerging and )?Selected (Topics|Areas) in ", "$1Sel. $2 "),
    (r" of Integrated Circuits and Systems$", ""),
)


def short_venue(display: Column) -> Column:
    """What stands in brackets at the end, else the name with its usual phrases shortened."""
    out = display
    for pattern, short in VENUE_SHORT:
        out = F.regexp_replace(out, pattern, short)
    return F.coalesce(_null_if_empty(F.regexp_extract(display, r"\(([^()]+)\)\s*$", 1)), out)


def guess_by_rules(name: Column, rules: list[tuple[str, str]]) -> Column:
    """The value of the first rule (pattern, value) that the lower-cased name matches."""
    out = F.lit(None).cast("string")
    for pattern, value in reversed(rules):
        out = F.when(F.lower(name).rlike(pattern), value).otherwise(out)
    return out


def names_found(text: Column, names: list[str]) -> Column:
    """Which of the names stand in the text as whole words, in the order given."""
    padded = F.concat(F.lit(" "), words_key(text), F.lit(" "))
    return F.filter(F.array(*(F.lit(n) for n in names)), lambda n: F.contains(padded, F.concat(F.lit(" "), n, F.lit(" "))))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null where there is nothing to share."""
    return F.when(whole > 0, 100.0 * part / whole)


def clamp_years(first: Column, last: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """A selection (either order) within the extent."""
    a, b = F.least(first, last), F.greatest(first, last)
    return F.least(F.greatest(a, low), high), F.least(F.greatest(b, low), high)


def parse_program_authors(text: Column) -> Column:
    """'Name, Affiliation; Name' to array<struct<name, affiliation>>; a part without a comma goes to the previous author."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x != "")
    empty = F.array().cast("array<struct<name:string,affiliation:string>>")

    def add(acc: Column, part: Column) -> Column:
        name, aff = F.trim(F.substring_index(part, ",", 1)), F.trim(F.regexp_replace(part, "^[^,]*,", ""))
        fresh = F.concat(acc, F.array(F.struct(name.alias("name"), aff.alias("affiliation"))))
        last = F.element_at(acc, -1)
        longer = F.struct(last["name"].alias("name"), F.concat_ws("; ", last["affiliation"], part).alias("affiliation"))
        extended = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))
        alone = F.array(F.struct(part.alias("name"), F.lit("").alias("affiliation")))
        return F.when(part.contains(","), fresh).when(F.size(acc) == 0, alone).otherwise(extended)

    return F.aggregate(parts, empty, add)


#: Names of groups, and traces of broken encodings or control characters in names. Fixed values.
GROUP_NAME = r"(?i)collaboration|consortium|\bteam\b|working group|study group|\bcommittee\b|\bthe\b.+\b(?:project|survey|experiment|mission)\b|^\(.*\)$"
GARBLED = r"\x{FFFD}|\x{C3}[\x{80}-\x{BF}\x{A1}-\x{FF}]|\x{E2}\x{20AC}|\x{C2}[\x{A0}-\x{BF}]|&#x?[0-9a-fA-F]+;|&[a-z]{2,6};|[\x00-\x08\x0b-\x1f]"


def is_group_name(name: Column) -> Column:
    return F.coalesce(name.rlike(GROUP_NAME), F.lit(False))


def is_garbled(name: Column) -> Column:
    """Broken encodings, entities or control characters, or a name without any letter; an empty name is not garbled."""
    return F.coalesce(name.rlike(GARBLED) | ((name != "") & ~name.rlike(r"\p{L}")), F.lit(False))


def is_biennial(years: Column) -> Column:
    """At least three years, one parity, two apart."""
    y = F.array_sort(F.array_distinct(years))
    steps = F.zip_with(F.slice(y, F.lit(1), F.greatest(F.size(y) - 1, F.lit(0))), F.slice(y, F.lit(2), F.greatest(F.size(y) - 1, F.lit(0))), lambda a, b: b - a)
    return (F.size(y) >= 3) & F.forall(steps, lambda s: s == 2)


def year_runs(years: Column) -> Column:
    """'2016–2018, 2020' of an array of years."""
    y = F.array_sort(F.array_distinct(years))
    empty = F.array().cast("array<struct<a:int,b:int>>")

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        more = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), x.alias("b"))))
        return F.when((F.size(acc) > 0) & (last["b"] == x - 1), more).otherwise(F.concat(acc, F.array(F.struct(x.alias("a"), x.alias("b")))))

    runs = F.aggregate(y.cast("array<int>"), empty, add)
    return F.array_join(F.transform(runs, lambda r: F.when(r["a"] == r["b"], r["a"].cast("string")).otherwise(F.concat_ws("–", r["a"].cast("string"), r["b"].cast("string")))), ", ")


def nice_ceiling(value: Column) -> Column:
    """The least 1, 2 or 5 times a power of ten that is no smaller; 1 for nothing."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(value)))
    lead = value / power
    return F.when(value <= 0, 1.0).otherwise(power * F.when(lead <= 1, 1).when(lead <= 2, 2).when(lead <= 5, 5).otherwise(10))


def csv_field(value: Column) -> Column:
    """RFC 4180 quoting."""
    return F.when(value.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)
