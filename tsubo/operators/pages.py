"""Listing pages to raw listing rows, page links and crawl completeness.

Only opening the HTML runs in Python, in Arrow batches on the executors; it
yields one row per building block.  What is read from many pages of one make is
looked up once, and their values are found by one expression and put into
columns without rows in between.  Everything else is column expressions, and no
step shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain, islice, repeat
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.functions import page_text, stations
from tsubo.functions.page_text import Element, Form, Gap
from tsubo.sources.tables import spread

# Element classes of the listing pages.
BLOCK = "cassetteitem"
TITLE = "cassetteitem_content-title"
ADDRESS = "cassetteitem_detail-col1"
STATION_LIST, STATION_TEXT = "cassetteitem_detail-col2", "cassetteitem_detail-text"
BUILDING_CELLS = "cassetteitem_detail-col3"
IMAGE_BOX, IMAGE_ATTRIBUTE = "cassetteitem_object", "rel"
UNIT = "js-cassette_link"
UNIT_LINK_CELL = ("ui-text--midium", "ui-text--bold")
PRICE = "cassetteitem_price"
RENT, MANAGEMENT_FEE = "cassetteitem_price--rent", "cassetteitem_price--administration"
DEPOSIT, KEY_MONEY = "cassetteitem_price--deposit", "cassetteitem_price--gratuity"
FLOOR_PLAN, AREA = "cassetteitem_madori", "cassetteitem_menseki"
CURRENT_PAGE = "pagination-current"

UNIT_TYPE = pa.struct(
    [
        ("href", pa.string()), ("rent", pa.string()), ("management_fee", pa.string()), ("deposit", pa.string()),
        ("key_money", pa.string()), ("cells", pa.list_(pa.string())), ("floor_plan", pa.string()), ("area", pa.string()),
    ]
)
BLOCK_TYPE = pa.schema(
    [
        ("url", pa.string()), ("block", pa.int64()), ("img", pa.string()), ("title", pa.string()), ("address", pa.string()),
        ("cells", pa.list_(pa.string())), ("station_texts", pa.list_(pa.string())), ("units", pa.list_(UNIT_TYPE)),
    ]
)
BLOCK_DDL = (
    "url STRING, block BIGINT, img STRING, title STRING, address STRING, cells ARRAY<STRING>, "
    "station_texts ARRAY<STRING>, units ARRAY<STRUCT<href: STRING, rent: STRING, management_fee: STRING, "
    "deposit: STRING, key_money: STRING, cells: ARRAY<STRING>, floor_plan: STRING, area: STRING>>"
)
LINK_TYPE = pa.schema([("url", pa.string()), ("link", pa.int64()), ("href", pa.string()), ("text", pa.string())])
LINK_DDL = "url STRING, link BIGINT, href STRING, text STRING"
NEXT_TYPE = pa.schema([("url", pa.string()), ("href", pa.string())])
NEXT_DDL = "url STRING, href STRING"

ROWS_PER_BATCH = 2048
# A make gets its form after so many of its pages, which take as long to read as the form to be made; a task holds so
# many forms, and tries so many on a page, those that fitted most first.
FORM_PAGES, FORMS_HELD, FORMS_TRIED = 64, 16, 4
BLANKS = "".join(filter(str.isspace, map(chr, range(0x10000))))

UNIT_COLUMNS = ["url", "rent", "management_fee", "deposit", "key_money", "floor", "floor_plan", "area"]
RAW_COLUMNS = [
    "title", "address", "building_age", "building_size", "stations", "nearest_station", "distance_to_nearest_station",
    "avg_distance_to_stations", *UNIT_COLUMNS,
]


def _array(values: list, kind: pa.DataType) -> pa.Array:
    """Values that are lists and structs, none of them missing, column by column."""
    if pa.types.is_list(kind):
        offsets = pa.array([0, *accumulate(map(len, values))], pa.int32())
        return pa.ListArray.from_arrays(offsets, _array([*chain.from_iterable(values)], kind.value_type), type=kind)
    if pa.types.is_struct(kind):
        return pa.StructArray.from_arrays([_array([v[f.name] for v in values], f.type) for f in kind], fields=[*kind])
    return pa.array(values, kind)


_URL = object()  # stands for a page's address where a make's rows are looked up


def _gaps(value: object) -> Iterator[Gap]:
    if isinstance(value, Gap):
        yield value
    elif isinstance(value, dict | list):
        for inner in value.values() if isinstance(value, dict) else value:
            yield from _gaps(inner)


class _Make:
    """The rows that all pages of one form have; addresses and values of pages that fit it wait for their batch."""

    def __init__(self, rows: list[dict], form: Form, schema: pa.Schema) -> None:
        self.form, self.schema = form, schema
        self.pages_per_batch = -(-ROWS_PER_BATCH // len(rows)) if rows else 0
        self.urls: list[str | None] = []
        self.values: list[tuple[bytes, ...]] = []
        self.columns = [self._column([row[f.name] for row in rows], f.type) for f in schema]

    def _column(self, values: list, kind: pa.DataType) -> tuple:
        """How a column is put together: its type, the lengths of a page's lists or what the values are, and the parts or values."""
        if pa.types.is_list(kind):
            return kind, [*map(len, values)], self._column([*chain.from_iterable(values)], kind.value_type)
        if pa.types.is_struct(kind):
            return kind, None, [self._column([v[f.name] for v in values], f.type) for f in kind]
        values = [self.form.fixed.get(v, v) if isinstance(v, Gap) else v for v in values]
        what = {"url" for v in values if v is _URL} | {"text" if v.name is None else "attribute" for v in values if isinstance(v, Gap)}
        if len(what) > 1:
            raise TypeError(f"one column of {' and '.join(sorted(what))}")
        return kind, what, [self.form.groups.get(v, v) if isinstance(v, Gap) else v for v in values]

    def _of_each_page(self, value: object) -> Iterable:
        """The addresses, the joined groups, or what is the same on every page."""
        if value is _URL:
            return self.urls
        if isinstance(value, list):
            found = map(itemgetter(*value), self.values) if value else repeat(b"", len(self.values))
            return map(b"".join, found) if len(value) > 1 else found
        return repeat(value, len(self.urls))

    def _filled(self, kind: pa.DataType, what: object, parts: object) -> pa.Array:
        if pa.types.is_list(kind):
            offsets = pa.array([0, *accumulate(what * len(self.urls))], pa.int32())
            return pa.ListArray.from_arrays(offsets, self._filled(*parts), type=kind)
        if pa.types.is_struct(kind):
            return pa.StructArray.from_arrays([self._filled(*part) for part in parts], fields=[*kind])
        values = [*chain.from_iterable(zip(*map(self._of_each_page, parts), strict=True))]
        if not what & {"text", "attribute"}:
            return pa.array(values, kind)
        texts = pa.array(values, pa.binary()).view(kind)
        return pc.utf8_trim(texts, characters=BLANKS) if "text" in what else texts

    def add(self, url: str | None, found: re.Match) -> bool:
        """Keeps a page's address and values; whether there are enough for a batch."""
        if not self.pages_per_batch:
            return False
        self.urls.append(url)
        self.values.append(page_text.group_values(found))
        return len(self.urls) >= self.pages_per_batch

    def sent(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([self._filled(*column) for column in self.columns], schema=self.schema)
        self.urls, self.values = [], []
        return batch


def _make(rows: Callable[[str, Element], Iterator[dict]], html: str, root: Element, schema: pa.Schema) -> _Make | None:
    root.page.traced = True
    found = [*rows(_URL, root)]
    root.page.traced = False
    form = page_text.form_of(html, root.page, [*_gaps(found)])
    return form and _Make(found, form, schema)


def _forward(makes: list[_Make], k: int) -> None:
    if k:
        makes[k - 1], makes[k] = makes[k], makes[k - 1]


def _texts_of(column: pa.Array) -> tuple[pa.Buffer | bytes, list[int]]:
    """The bytes of a text column, and where each value begins and the last one ends."""
    _, offsets, data = column.buffers()
    places = memoryview(offsets).cast("q" if pa.types.is_large_string(column.type) else "i")
    return data or b"", places[column.offset : column.offset + len(column) + 1].tolist()


def _read(pages: DataFrame, rows: Callable[[str, Element], Iterator[dict]], schema: pa.Schema, ddl: str, deal: bool = True) -> DataFrame:
    """Rows found on each page; a page with very many leaves in several batches.

    ``rows`` passes addresses, texts and attributes on without looking into them, and has texts and attributes in
    different columns: what it finds on one page is then found on all pages of the same tags.
    Pages from a small input are dealt out to all cores first, unless ``deal`` says that they already are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([_array([row[f.name] for row in ready], f.type) for f in schema], schema=schema)

        ready: list[dict] = []
        reader = page_text.Reader()
        makes: list[_Make] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(1)
            column.validate(full=True)
            data, places = _texts_of(column)
            for i, url in enumerate(batch.column(0).to_pylist()):
                for k, make in enumerate(islice(makes, FORMS_TRIED)):
                    if found := make.form.match(data, places[i], places[i + 1]):
                        _forward(makes, k)
                        if make.add(url, found):
                            yield make.sent()
                        break
                else:
                    html = column[i].as_py() or ""
                    root = reader.read(html)
                    for row in rows(url, root):
                        ready.append(row)
                        if len(ready) >= ROWS_PER_BATCH:
                            yield sent()
                            ready = []
                    if root.page.make:
                        _forward(makes, makes.index(root.page.make))
                    elif root.page.reads == FORM_PAGES and len(makes) < FORMS_HELD and (make := _make(rows, html, root, schema)):
                        root.page.make = make
                        makes.append(make)
            # what waits is never more than an input batch holds
            for make in makes:
                if make.urls:
                    yield make.sent()
        if ready:
            yield sent()

    read = pages.select("url", "html")
    return (spread(read) if deal else read).mapInArrow(run, ddl)


def _unit(row: Element) -> dict:
    price = {
        name: page_text.text(page_text.first(row, "span", PRICE, css))
        for name, css in (("rent", RENT), ("management_fee", MANAGEMENT_FEE), ("deposit", DEPOSIT), ("key_money", KEY_MONEY))
    }
    return price | {
        "href": _link(row),
        "cells": [page_text.text(cell) for cell in page_text.elements(row, "td")],
        "floor_plan": page_text.text(page_text.first(row, "span", FLOOR_PLAN)),
        "area": page_text.text(page_text.first(row, "span", AREA)),
    }


def _link(row: Element) -> str | None:
    links = (a for cell in page_text.elements(row, "td", *UNIT_LINK_CELL) for a in page_text.elements(cell, "a"))
    link = next(links, None)
    return None if link is None else link.get("href")


def _texts(block: Element, item: str, tag: str, *classes: str) -> list[str]:
    return [page_text.text(e) for li in page_text.elements(block, "li", item) for e in page_text.elements(li, tag, *classes)]


def _image(block: Element) -> str | None:
    images = (img for box in page_text.elements(block, "div", IMAGE_BOX) for img in page_text.elements(box, "img"))
    image = next(images, None)
    return None if image is None else image.get(IMAGE_ATTRIBUTE)


# How each column of a building is read.
BLOCK_READINGS: dict[str, Callable[[Element], object]] = {
    "img": _image,
    "title": lambda block: page_text.text(page_text.first(block, "div", TITLE)),
    "address": lambda block: page_text.text(page_text.first(block, "li", ADDRESS)),
    "cells": lambda block: _texts(block, BUILDING_CELLS, "div"),
    "station_texts": lambda block: _texts(block, STATION_LIST, "div", STATION_TEXT),
    "units": lambda block: [_unit(row) for row in page_text.elements(block, "tr", UNIT)],
}


def _blocks(url: str, page: Element) -> Iterator[dict]:
    for place, block in enumerate(page_text.elements(page, "div", BLOCK)):
        yield {"url": url, "block": place} | {name: reading(block) for name, reading in BLOCK_READINGS.items()}


def building_blocks(pages: DataFrame, deal: bool = True) -> DataFrame:
    """One row per building on a page, in document order; pages without any give none."""
    return _read(pages, _blocks, BLOCK_TYPE, BLOCK_DDL, deal)


def absolute_url(href: Column, base_url: str) -> Column:
    """The base without its last character, then the link; NULL without a link."""
    return F.concat(F.lit(base_url[:-1]), href)


def listings_from_blocks(blocks: DataFrame, base_url: str, strict_stations: bool = False, with_image: bool = False) -> DataFrame:
    """One raw listing per unit; a building without units gives no row."""
    image = ["img"] if with_image else []
    texts = F.col("station_texts")
    readings = {f"station_{name}": column for name, column in stations.readings(texts, strict_stations).items()}
    station = stations.summarize(texts, strict_stations, {name.removeprefix("station_"): F.col(name) for name in readings})
    # The building's own columns are made before its units are opened, once per building.
    building = blocks.withColumns(readings).select(
        *image,
        "title",
        "address",
        F.get("cells", F.lit(0)).alias("building_age"),
        F.get("cells", F.lit(1)).alias("building_size"),
        *(column.alias(name) for name, column in station._asdict().items()),
        "units",
    )
    opened = building.select("*", F.explode_outer("units").alias("unit")).filter("unit IS NOT NULL").drop("units")
    unit = {"url": absolute_url(F.col("unit.href"), base_url), "floor": F.get("unit.cells", F.lit(2))}
    values = [unit.get(c, F.col(f"unit.{c}")).alias(c) for c in UNIT_COLUMNS]
    return opened.select("*", *values).select(*image, *RAW_COLUMNS)


def extract_listings(pages: DataFrame, base_url: str, deal: bool = True, **options) -> DataFrame:
    return listings_from_blocks(building_blocks(pages, deal), base_url, **options)


def block_rejects(blocks: DataFrame) -> DataFrame:
    """Buildings with and without units, and the units themselves: what the explosion keeps and drops."""
    units = F.coalesce(F.size("units"), F.lit(0))
    return blocks.agg(
        F.count(F.lit(1)).alias("buildings"),
        F.count_if(units == 0).alias("without_units"),
        F.coalesce(F.sum(units), F.lit(0)).alias("listings"),
    )


def _menu_links(url: str, page: Element) -> Iterator[dict]:
    links = (a for nav in page_text.elements(page, "nav") for li in page_text.elements(nav, "li") for a in page_text.elements(li, "a"))
    for place, link in enumerate(links):
        yield {"url": url, "link": place, "href": link.get("href"), "text": page_text.text(link)}


def page_links(pages: DataFrame, base_url: str) -> DataFrame:
    """One row per menu link of a page, in document order."""
    links = _read(pages, _menu_links, LINK_TYPE, LINK_DDL)
    return links.select("url", "link", absolute_url(F.col("href"), base_url).alias("target"), "text")


def _next(url: str, page: Element) -> Iterator[dict]:
    current = page_text.first(page, "li", CURRENT_PAGE)
    later = [] if current is None else page_text.following(current, "li")
    link = page_text.first(later[1], "a") if len(later) > 1 else None
    yield {"url": url, "href": None if link is None else link.get("href")}


def next_pages(pages: DataFrame, base_url: str) -> DataFrame:
    """``url`` and ``next_url`` per page: the link of the second item after the current one, else NULL."""
    return _read(pages, _next, NEXT_TYPE, NEXT_DDL).select("url", F.concat(F.lit(base_url), F.col("href")).alias("next_url"))


def frontier(chain: DataFrame) -> DataFrame:
    """Linked pages that were not collected; a crawl is complete when there are none.

    Both sides are made distinct first, so a page fetched over and over weighs
    no more than one.
    """
    wanted = chain.select(F.col("next_url").alias("url")).na.drop().distinct()
    return wanted.join(chain.select("url").distinct(), "url", "left_anti")


def duplicate_pages(pages: DataFrame) -> DataFrame:
    """Pages that were collected more than once."""
    return pages.groupBy("url").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
