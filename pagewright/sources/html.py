"""Catalogue pages as tables, with the standard library's HTML parser behind Arrow UDFs.

Markup is the one thing here that no built-in expression can read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM_LINK = r"/(Item/View|File/Download)/(\d+)"
ROWS = "array<struct<document_id:string,name:string,url:string,is_file:boolean,kind:string,cells:array<string>>>"
FACETS = "map<string,map<string,string>>"


class _Tree(HTMLParser):
    """Collects table rows, links by section, and select options in one pass."""

    def __init__(self, link: re.Pattern):
        super().__init__(convert_charrefs=True)
        self.link = link
        self.rows: list[dict] = []
        self.crumbs: list[str] = []
        self.facets: dict[str, dict[str, str]] = {}
        self.next_url: str | None = None
        self._body = self._crumb = 0
        self._row: dict | None = None
        self._cell: list[str] | None = None
        self._a: tuple[str, list[str]] | None = None
        self._select: str | None = None
        self._option: tuple[str, list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if tag == "tbody":
            self._body += 1
        elif tag == "tr" and self._body:
            self._row = {"cells": [], "link": None, "name": "", "kind": None}
        elif tag == "td" and self._row is not None:
            self._cell = []
        elif tag in ("ol", "ul", "nav") and "breadcrumb" in classes:
            self._crumb += 1
        elif tag == "img" and self._row is not None and self._row["kind"] is None:
            self._row["kind"] = a.get("title") or a.get("alt")
        elif tag == "a":
            href = a.get("href") or ""
            self._a = (href, [])
            if a.get("rel") == "next" or (a.get("title") or "").lower() in ("next", "suivant", "next page") or "next" in classes:
                self.next_url = self.next_url or href or a.get("data-url")
            m = self.link.search(href)
            if m and self._crumb:
                self.crumbs.append(m[2])
        elif tag == "select":
            self._select = a.get("id") or a.get("name")
        elif tag == "option" and self._select:
            self._option = ((a.get("value") or "").strip(), [])

    def handle_data(self, data):
        for sink in (self._cell, self._a and self._a[1], self._option and self._option[1]):
            if sink is not None and sink is not False:
                sink.append(data)

    def handle_endtag(self, tag):
        text = lambda parts: " ".join("".join(parts).split())
        if tag == "tbody":
            self._body = max(0, self._body - 1)
        elif tag == "a" and self._a:
            href, parts = self._a
            m = self.link.search(href)
            if m and self._row is not None and self._row["link"] is None:
                self._row |= {"link": m, "url": href, "name": text(parts)}
            self._a = None
        elif tag == "td" and self._row is not None and self._cell is not None:
            self._row["cells"].append(text(self._cell))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            r, self._row = self._row, None
            if len(r["cells"]) >= 3 and r["link"]:
                file = r["link"][1] == "File/Download"
                self.rows.append({"document_id": r["link"][2], "name": r["name"], "url": r["url"], "is_file": file, "kind": r["kind"], "cells": r["cells"]})
        elif tag in ("ol", "ul", "nav") and self._crumb:
            self._crumb -= 1
        elif tag == "option" and self._option and self._select:
            value, parts = self._option
            if value and text(parts):
                self.facets.setdefault(self._select, {})[value] = text(parts)
            self._option = None
        elif tag == "select":
            self._select = None


def _parse(html: str | None, link: re.Pattern) -> _Tree:
    t = _Tree(link)
    if html:
        t.feed(html)
        t.close()
    return t


def result_rows(pages: DataFrame, html: str = "html", link: str = ITEM_LINK) -> DataFrame:
    """The pages' other columns (as ``page`` where names clash) and (pos, document_id, name, url, is_file, kind, cells) per result row.

    A row counts with at least three cells and an item link. Null, empty and broken markup give no row.
    """
    rx = re.compile(link)

    def rows(s: pd.Series) -> pd.Series:
        return pd.Series([_parse(x if isinstance(x, str) else None, rx).rows for x in s], dtype=object)

    made = ("pos", "document_id", "name", "url", "is_file", "kind", "cells")
    keep = [c for c in pages.columns if c != html]
    # Columns that would clash with the result's come along as one struct.
    held = [F.struct(*keep).alias("page")] if set(keep) & set(made) else [F.col(c) for c in keep]
    names = ["page"] if set(keep) & set(made) else keep
    return pages.select(*held, F.posexplode(F.pandas_udf(rows, ROWS)(F.col(html))).alias("pos", "r")).select(*names, "pos", "r.*")


def page_links(pages: DataFrame, html: str = "html", link: str = ITEM_LINK) -> DataFrame:
    """Adds breadcrumb_ids (outermost first), next_url and facets to each page."""
    rx = re.compile(link)

    def look(s: pd.Series) -> pd.DataFrame:
        trees = [_parse(x if isinstance(x, str) else None, rx) for x in s]
        return pd.DataFrame({"breadcrumb_ids": [t.crumbs for t in trees], "next_url": [t.next_url for t in trees], "facets": [t.facets for t in trees]})

    got = F.pandas_udf(look, f"breadcrumb_ids array<string>, next_url string, facets {FACETS}")(F.col(html))
    return pages.withColumn("_got", got).select(*pages.columns, F.col("_got.breadcrumb_ids").alias("breadcrumb_ids"), F.col("_got.next_url").alias("next_url"), F.col("_got.facets").alias("facets"))


def breadcrumb_parent(ids, own):
    """The last breadcrumb id that is not the item's own."""
    return F.try_element_at(F.filter(ids, lambda x: x != own), F.lit(-1))
