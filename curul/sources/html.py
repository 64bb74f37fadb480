"""Elements of HTML pages by the standard parser, which takes pages that aren't well formed."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Elements(HTMLParser):
    def __init__(self, tags: set[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.open, self.out = tags, [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.tags:
            a = dict(attrs)
            e = {"tag": tag, "id": a.get("id"), "class": a.get("class"), "href": a.get("href") or a.get("src"), "text": ""}
            self.out.append(e)
            if tag not in _VOID:
                self.open.append(e)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        for e in self.open:
            e["text"] += data


def elements(page: str | None, tags: set[str]) -> list[dict]:
    """The page's elements of the given tags in order, with their text on one line; null and empty pages have none."""
    p = _Elements(tags)
    if page:
        p.feed(page)
        p.close()
    for e in p.out:
        e["text"] = " ".join(e["text"].split())
    return p.out


def html_elements(page: Column, tags: list[str]) -> Column:
    """``elements`` as an array of (tag, id, class, href, text)."""
    wanted = set(tags)

    @F.pandas_udf("array<struct<tag string, id string, `class` string, href string, text string>>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: elements(p, wanted))

    return read(page)
