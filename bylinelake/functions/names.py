"""Personal names as tokens, and when two spellings may be one person."""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENS = T.ArrayType(T.StringType())

#: Letters that do not decompose, suffixes of names, dashes. Fixed values.
LETTERS = {"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th"}
SUFFIXES = ("jr", "sr", "ii", "iii", "iv")
FAMILY_SUFFIXES = r"\b(jr|sr|ii|iii|phd|sj)\b\.?"
DASHES = "[‐-―−]"


def unmarked(text: str) -> str:
    """Decomposed, without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def tokens_of(name: str | None) -> list[str]:
    plain = html.unescape(name or "").casefold()
    for letter, spelled in LETTERS.items():
        plain = plain.replace(letter, spelled)
    return [t for t in re.findall("[a-z0-9]+", re.sub("['’]", "", unmarked(plain))) if t not in SUFFIXES]


def _ascii(name: str | None) -> str:
    return unicodedata.normalize("NFKD", re.sub(DASHES, "-", name or "")).encode("ascii", "ignore").decode().lower()


@F.pandas_udf(TOKENS)
def name_tokens(name):
    """Folded words of letters and digits without suffixes such as Jr; null gives an empty array."""
    return name.map(tokens_of)


@F.pandas_udf(TOKENS)
def letter_tokens(name):
    """Folded words of letters in any script, entities decoded; null gives an empty array."""
    return name.map(lambda n: re.findall(r"[^\W\d_]+", unmarked(html.unescape(n or "")).casefold()))


@F.pandas_udf(TOKENS)
def sorted_tokens(name):
    """ASCII words in order of the alphabet, so that the order of names does not count."""
    return name.map(lambda n: sorted(re.findall("[a-z]+", _ascii(n))))


@F.pandas_udf(T.StringType())
def family_key(name):
    """The last ASCII word that is no suffix; empty if there is none."""
    return name.map(lambda n: (re.findall("[a-z]+", re.sub(FAMILY_SUFFIXES, "", _ascii(n))) or [""])[-1])


def names_agree(a: Column, b: Column) -> Column:
    """Two arrays of tokens may name one person: the same family name and first initial, in either order of names; the same
    words; or the same letters when one is written without blanks. Empty arrays agree with nothing."""
    first, last = (lambda t: F.get(t, F.lit(0))), (lambda t: F.try_element_at(t, F.lit(-1)))
    letter = lambda w: F.substring(w, 1, 1)
    words = lambda t: F.array_sort(F.array_distinct(t))
    run = F.array_join(a, "")
    agrees = (
        ((last(a) == last(b)) & (letter(first(a)) == letter(first(b))))
        | ((last(a) == first(b)) & (letter(first(a)) == letter(last(b))))
        | (words(a) == words(b))
        | (run == F.array_join(b, ""))
        | (run == F.array_join(F.reverse(b), ""))
    )
    return F.coalesce((F.size(a) > 0) & (F.size(b) > 0) & agrees, F.lit(False))


def agreement(left: list[str], right: list[str]):
    """The same rule as a matrix over two bylines."""
    import numpy as np

    def parts(byline, turned):
        tokens = [tokens_of(n) for n in byline]
        full = np.array([bool(t) for t in tokens])
        pick = lambda f: np.array([f(t) if t else "" for t in tokens], dtype=object)
        return full, pick(lambda t: t[0]), pick(lambda t: t[0][0]), pick(lambda t: t[-1]), pick(lambda t: t[-1][0]), pick(lambda t: " ".join(sorted(set(t)))), pick("".join), pick(lambda t: "".join(reversed(t)) if turned else "")

    fa, _, ia, la, _, wa, ra, _ = parts(left, False)
    fb, hb, ib, lb, jb, wb, rb, tb = parts(right, True)
    same = lambda x, y: x[:, None] == y[None, :]
    rule = (same(la, lb) & same(ia, ib)) | (same(la, hb) & same(ia, jb)) | same(wa, wb) | same(ra, rb) | same(ra, tb)
    return rule.astype(bool) & fa[:, None] & fb[None, :]
