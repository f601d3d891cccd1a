"""Stored HTML pages to listing rows, descriptions and metadata.

HTML needs a tokenizer, which Spark has none of; the page text goes through a small standard-library
parser inside Arrow batches. Spark distributes the pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import first_filled, or_default

# Selectors tried in this order.
DESCRIPTION_SELECTORS = (".jobDescription", ".job-description", "#jobDescription", "div.description", "td.detailsRight")
TITLE_SELECTORS = ("h1.jobTitle", "h1", ".jobTitle", "td.detailsHeader")
LOCATION_SELECTORS = (".jobLocation", "td.location")
CONTRACT_SELECTORS = (".jobType", "td.contractType")
DEADLINE_SELECTORS = (".endDate", "td.deadline")
# Cell positions in a listing row, counted from 0, and the class of its link.
CELL_POSITIONS = {"title": 1, "location": 2, "contract_type": 4, "deadline": 7}
LINK_CLASS = "archiveLink"

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset("script style template noscript".split())
_INLINE = frozenset("a abbr b bdi bdo cite code em font i kbd label mark q s small span strong sub sup u".split())


def _tidy(pieces: list[str]) -> str:
    """Visible text: runs of blanks become one, empty lines go."""
    lines = (" ".join(line.split()) for line in "".join(pieces).split("\n"))
    return "\n".join(line for line in lines if line)


class _Page(HTMLParser):
    """Tracks open elements and the text inside those a subclass marks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[list[str]]]] = []
        self.hidden = 0

    def begins(self, tag: str, attrs: dict[str, str]) -> list[list[str]]:
        """Text buffers that collect everything inside the element."""
        return []

    def handle_starttag(self, tag, attrs):
        if tag not in _INLINE:
            self._add("\n")
        if tag in _VOID:
            return
        self.hidden += tag in _HIDDEN
        self.open.append((tag, self.begins(tag, {k: v or "" for k, v in attrs})))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self._add("\n")
        if not any(name == tag for name, _ in self.open):
            return
        while True:
            name, _ = self.open.pop()
            self.hidden -= name in _HIDDEN
            if name == tag:
                return

    def handle_data(self, data):
        if not self.hidden:
            # Line ends in the source are plain blanks.
            self._add(data.replace("\n", " "))

    def _add(self, text: str) -> None:
        for _, buffers in self.open:
            for buffer in buffers:
                buffer.append(text)


class _Selected(_Page):
    """Text of the first element per selector (`tag`, `.class`, `#id`, `tag.class`)."""

    def __init__(self, selectors) -> None:
        super().__init__()
        self.wanted = [(s, *self._split(s)) for s in selectors]
        self.found: dict[str, list[str]] = {}

    @staticmethod
    def _split(selector: str) -> tuple[str, str, str]:
        if "#" in selector:
            tag, _, name = selector.partition("#")
            return tag, "id", name
        tag, _, name = selector.partition(".")
        return tag, "class", name

    def begins(self, tag, attrs):
        buffers = []
        for selector, want_tag, attribute, name in self.wanted:
            if selector in self.found or (want_tag and want_tag != tag):
                continue
            if name and name not in attrs.get(attribute, "").split():
                continue
            self.found[selector] = []
            buffers.append(self.found[selector])
        return buffers


class _Listing(_Page):
    """Rows of a listing table that hold a posting link."""

    def __init__(self) -> None:
        super().__init__()
        self.links: list[dict] = []
        self.cells: list[list[str]] = []

    def begins(self, tag, attrs):
        buffer: list[str] = []
        if tag == "tr":
            self.cells = []
        elif tag == "td":
            self.cells.append(buffer)
            return [buffer]
        elif tag == "a" and LINK_CLASS in attrs.get("class", "").split():
            self.links.append({"href": attrs.get("href", ""), "id": buffer, "cells": self.cells})
            return [buffer]
        return []

    def rows(self) -> Iterator[dict]:
        for link in self.links:
            cells = [_tidy(c) for c in link["cells"]]
            row = {"job_id": _tidy(link["id"]), "href": link["href"]}
            for field, at in CELL_POSITIONS.items():
                row[field] = cells[at] if at < len(cells) else ""
            yield row


def _parse(page: _Page, html: str | None):
    page.feed(html or "")
    page.close()
    return page


def selected_text(html: Column, selectors: tuple[str, ...]) -> Column:
    """Struct with one text field per selector, named s0, s1, …"""
    names = [f"s{i}" for i in range(len(selectors))]
    schema = StructType([StructField(n, StringType()) for n in names])

    def extract(pages: pd.Series) -> pd.DataFrame:
        found = (_parse(_Selected(selectors), page).found for page in pages)
        rows = [[_tidy(f[s]) if s in f else "" for s in selectors] for f in found]
        return pd.DataFrame(rows, columns=names)

    return F.pandas_udf(extract, schema)(html)


def _chain(selected: Column, at: dict[str, int], selectors: tuple[str, ...], *more: Column) -> Column:
    return first_filled(*[selected[f"s{at[s]}"] for s in selectors], *more)


def page_details(pages: DataFrame, title_suffix: str = "", html: str = "html", body_chars: int | None = None) -> DataFrame:
    """Add title, location, contract type, deadline and description found on a detail page.

    Each takes the first non-empty of its selectors. The title falls back to the page title without
    `title_suffix`, the description to the body text, whole or its first `body_chars` characters.
    """
    selectors = tuple(
        dict.fromkeys(
            TITLE_SELECTORS + LOCATION_SELECTORS + CONTRACT_SELECTORS + DEADLINE_SELECTORS
            + DESCRIPTION_SELECTORS + ("title", "body")
        )
    )
    at = {s: i for i, s in enumerate(selectors)}
    found = F.col("_found")
    page_title = found[f"s{at['title']}"]
    if title_suffix:
        page_title = F.replace(page_title, F.lit(title_suffix), F.lit(""))
    body = found[f"s{at['body']}"]
    if body_chars is not None:
        body = F.substring(body, 1, body_chars)
    return (
        pages.withColumn("_found", selected_text(F.col(html), selectors))
        .withColumns(
            {
                "title": _chain(found, at, TITLE_SELECTORS, page_title),
                "location": _chain(found, at, LOCATION_SELECTORS),
                "contract_type": _chain(found, at, CONTRACT_SELECTORS),
                "deadline": _chain(found, at, DEADLINE_SELECTORS),
                # The cut body keeps a blank at its end.
                "description_raw": or_default(_chain(found, at, DESCRIPTION_SELECTORS), body),
            }
        )
        .drop("_found")
    )


LISTING_SCHEMA = "job_id STRING, href STRING, title STRING, location STRING, contract_type STRING, deadline STRING"


def listing_stubs(pages: DataFrame, base_url: str, html: str = "html") -> DataFrame:
    """One stub per posting link with an id, its cells taken by position."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in LISTING_SCHEMA.split(", ")]
        for batch in batches:
            rows = [row for page in batch[html] for row in _parse(_Listing(), page).rows()]
            yield pd.DataFrame(rows, columns=columns)

    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(base_url), F.col("href")))
    return (
        pages.select(html)
        .mapInPandas(extract, LISTING_SCHEMA)
        .filter(F.col("job_id") != "")
        .withColumn("url", url)
        .drop("href")
    )
