"""Parsers of bibliographic text, run over Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: LaTeX accents and the combining marks they stand for; then letters with names of their own. Fixed values.
ACCENTS = {"`": "\u0300", "'": "\u0301", "^": "\u0302", "~": "\u0303", '"': "\u0308", "=": "\u0304", ".": "\u0307", "u": "\u0306", "v": "\u030c", "H": "\u030b", "c": "\u0327", "k": "\u0328", "r": "\u030a"}
LETTERS = {"ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "i": "ı", "aa": "å", "AA": "Å"}


def latex_to_text(s: str) -> str:
    """Accents and named letters as Unicode, braces and other commands removed, white space collapsed."""
    import re
    import unicodedata

    def accent(m):
        return unicodedata.normalize("NFC", (m[2] or m[3]).replace("ı", "i") + ACCENTS[m[1]])

    s = re.sub(r"\\(" + "|".join(sorted(LETTERS, key=len, reverse=True)) + r")(?![A-Za-z])\s*(?:\{\})?", lambda m: LETTERS[m[1]], s)
    s = re.sub(r"\\([`'^~\"=.])\s*(?:\{(\w)\}|(\w))", accent, s)
    s = re.sub(r"\\([uvHckr])(?:\s*\{(\w)\}|\s+(\w))", accent, s)
    s = re.sub(r"\\([&%$#_{}])", r"\1", s)
    s = re.sub(r"\\[A-Za-z]+\*?\s*", "", s)
    return " ".join(s.replace("{", "").replace("}", "").replace("~", " ").split())


def split_outside_braces(s: str, word: str) -> list[str]:
    """s at the word (between blanks) where no brace is open."""
    out, depth, now = [], 0, []
    for token in s.replace("{", " { ").replace("}", " } ").split(" "):
        depth += (token == "{") - (token == "}")
        if token == word and depth == 0:
            out.append(" ".join(now))
            now = []
        else:
            now.append(token)
    out.append(" ".join(now))
    return [x.replace(" { ", "{").replace(" } ", "}").replace("{ ", "{").replace(" }", "}").strip() for x in out if x.strip()]


def bib_authors(field: str) -> list[str]:
    """Given names first; `Last, First` and `Last, Jr, First` are turned."""
    out = []
    for name in split_outside_braces(" ".join(field.split()), "and"):
        parts = [latex_to_text(p) for p in name.split(",")]
        out.append(" ".join(p for p in (parts if len(parts) == 1 else [parts[-1], parts[0], *parts[1:-1]]) if p))
    return out


def parse_bibtex(text: str) -> list[dict]:
    """Entries with type, key and fields; values in (nested) braces, in quotes or bare."""
    out, at = [], 0
    while (at := text.find("@", at)) >= 0:
        brace = text.find("{", at)
        if brace < 0:
            break
        kind, i, depth = text[at + 1 : brace].strip().lower(), brace + 1, 1
        while i < len(text) and depth:
            depth += (text[i] == "{") - (text[i] == "}")
            i += 1
        body, at = text[brace + 1 : i - 1], i
        if not kind.isalpha() or kind in ("comment", "string", "preamble"):
            continue
        key, _, rest = body.partition(",")
        entry, j = {"type": kind, "key": key.strip()}, 0
        while (eq := rest.find("=", j)) >= 0:
            name, k = rest[j:eq].strip(" ,\n\t\r").lower(), eq + 1
            while k < len(rest) and rest[k].isspace():
                k += 1
            stop, depth, quoted = k, 0, k < len(rest) and rest[k] == '"'
            while stop < len(rest):
                c = rest[stop]
                depth += (c == "{") - (c == "}")
                stop += 1
                if depth == 0 and (c == '"' and stop - 1 > k if quoted else c in "},"):
                    break
            value = rest[k:stop].strip().rstrip(",").strip()
            if value[:1] + value[-1:] in ("{}", '""'):
                value = value[1:-1]
            entry[name], j = value, stop
        out.append(entry)
    return out


def read_bibtex(files: DataFrame, text_col: str = "value") -> DataFrame:
    """(key, type, title, authors, year, volume, url) of the entries of whole files; null texts give none."""
    schema = "key string, type string, title string, authors array<string>, year int, volume string, url string"

    def run(parts):
        import pandas as pd

        for pdf in parts:
            rows = []
            for text in pdf[text_col].dropna():
                for e in parse_bibtex(text):
                    year = "".join(c for c in e.get("year", "") if c.isdigit())
                    rows.append((e["key"], e["type"], latex_to_text(e.get("title", "")), bib_authors(e.get("author", "")), int(year) if year else None, e.get("volume"), e.get("url")))
            yield pd.DataFrame(rows, columns=["key", "type", "title", "authors", "year", "volume", "url"]).astype({"year": "Int32"})

    return files.select(text_col).mapInPandas(run, schema)
