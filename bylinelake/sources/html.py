"""Fields of raw HTML pages, as expressions, and a listing parser for publisher pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title(html: Column) -> Column:
    return F.regexp_extract(html, "<title>([^<]*)</title>", 1)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))


def language(html: Column) -> Column:
    return F.regexp_extract(html, '<html lang="([a-z]+)"', 1)


def listing(pages: DataFrame, html_col: str, key_cols: list[str], item: str = "li", title_class: str = "title", author_class: str = "authors") -> DataFrame:
    """Membership rows (keys, position, title, authors, link) of listing pages: one for each `item` element with a title."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key_cols) + ", position int, title string, authors array<string>, link string"

    def run(parts):
        from html.parser import HTMLParser

        import pandas as pd

        class Listing(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.rows, self.now, self.into, self.depth = [], None, None, 0

            def handle_starttag(self, tag, attrs):
                a = dict(attrs)
                if tag == item:
                    self.now = {"title": "", "authors": "", "link": None}
                elif self.now is not None:
                    cls = (a.get("class") or "").split()
                    if title_class in cls or author_class in cls:
                        self.into, self.depth = "title" if title_class in cls else "authors", 0
                    elif self.into:
                        self.depth += 1
                    if tag == "a" and a.get("href") and self.now["link"] is None:
                        self.now["link"] = a["href"]

            def handle_endtag(self, tag):
                if tag == item and self.now is not None:
                    if self.now["title"].strip():
                        self.rows.append(self.now)
                    self.now = self.into = None
                elif self.into:
                    if self.depth == 0:
                        self.into = None
                    else:
                        self.depth -= 1

            def handle_data(self, data):
                if self.now is not None and self.into:
                    self.now[self.into] += data

        for pdf in parts:
            out = []
            for row in pdf.to_dict("records"):
                p = Listing()
                p.feed(row[html_col] or "")
                for i, r in enumerate(p.rows):
                    out.append({**{c: row[c] for c in key_cols}, "position": i, "title": " ".join(r["title"].split()), "authors": [x.strip() for x in r["authors"].split(",") if x.strip()], "link": r["link"]})
            yield pd.DataFrame(out, columns=[*key_cols, "position", "title", "authors", "link"])

    return pages.select(*key_cols, html_col).mapInPandas(run, schema)
