"""Test inputs shaped from the given tables: raw listings and listing pages.

The expressions are plain SQL that Spark and the oracle engine both read, so
both start from the same rows; everything after them is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsubo.operators.cleaning import DUPLICATE_KEY
from tsubo.sources.tables import planned_bytes, spread

BASE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax",
    "CAST(l_quantity AS BIGINT) AS q",
    "CAST(3 * l_quantity + (40 - l_partkey % 40) + floor(l_extendedprice / 5000) AS BIGINT) AS x",
]

MAN_LABEL = "concat(CAST(floor(x / 10) AS BIGINT), '.', x % 10, '万円')"
LISTING_COLUMNS = {
    "title": "CASE WHEN l_partkey % 500 = 0 THEN NULL ELSE concat('T', l_partkey % 500) END",
    "address": "concat('A', l_suppkey)",
    "building_age": (
        "CASE WHEN l_partkey % 40 = 0 THEN '新築' WHEN l_partkey % 40 = 39 THEN '築99年以上' "
        "ELSE concat('築', l_partkey % 40, '年') END"
    ),
    "building_size": (
        "CASE l_suppkey % 4 WHEN 0 THEN '平屋' WHEN 1 THEN concat('地下1地上', q % 9 + 1, '階建') "
        "ELSE concat(q % 14 + 1, '階建') END"
    ),
    "stations": (
        "CASE WHEN l_suppkey % 30 = 0 THEN NULL ELSE concat('線/S', l_suppkey % 30, ' 歩', l_orderkey % 20 + 1, "
        "'分,線/S', l_suppkey % 7, ' 歩', l_orderkey % 20 + 4, '分') END"
    ),
    "nearest_station": "CASE WHEN l_suppkey % 30 = 0 THEN NULL ELSE concat('S', l_suppkey % 30) END",
    "distance_to_nearest_station": "CASE WHEN l_suppkey % 30 = 0 THEN NULL ELSE l_orderkey % 20 + 1 END",
    "avg_distance_to_stations": (
        "CASE WHEN l_suppkey % 30 = 0 THEN NULL "
        "ELSE CAST((l_orderkey % 20 + 1) + (l_orderkey % 20 + 4) AS DOUBLE) / 2 END"
    ),
    "url": "concat('https://example.org/l/', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey)",
    "rent": f"CASE WHEN l_linenumber = 7 AND q = 50 THEN '-' ELSE {MAN_LABEL} END",
    "management_fee": "CASE WHEN q % 5 = 0 THEN '-' ELSE concat(q * 200, '円') END",
    "deposit": f"CASE WHEN l_discount = 0 THEN '-' ELSE {MAN_LABEL} END",
    "key_money": "CASE WHEN l_tax = 0 THEN '-' ELSE concat(CAST(floor(x / 20) AS BIGINT), '万円') END",
    "floor": (
        "CASE l_linenumber WHEN 1 THEN '3階' WHEN 2 THEN 'B1階' WHEN 3 THEN '1-2階' WHEN 4 THEN 'B1-2階' "
        "WHEN 5 THEN '-' WHEN 6 THEN '5-3階' ELSE concat(q, '階') END"
    ),
    "floor_plan": (
        "CASE CAST(floor(q / 7) AS BIGINT) WHEN 0 THEN 'ワンルーム' WHEN 1 THEN '1K' WHEN 2 THEN '1DK' "
        "WHEN 3 THEN '1LDK' WHEN 4 THEN '2DK' WHEN 5 THEN '2LDK' WHEN 6 THEN '3LDK' ELSE '4LDK' END"
    ),
    "area": "concat(q + 10, '.', l_partkey % 10, 'm2')",
}
RAW_COLUMNS = list(LISTING_COLUMNS)
AGAIN = "?again"
# Of the file of line items; some 450,000 of them.
BYTES_PER_TASK = 8 << 20
BASE_URL = "https://example.org/"


def _copies_together(base: DataFrame, size: int) -> DataFrame:
    """Line items dealt out by the duplicate key of their listings, while they are narrow.

    A listing is some twenty times as wide as its line item in the file, so a
    file split of line items is too many listings for one task to sort.
    """
    key = F.xxhash64(*(F.expr(LISTING_COLUMNS[c]) for c in DUPLICATE_KEY))
    return base.repartition(max(base.sparkSession.sparkContext.defaultParallelism, -(-size // BYTES_PER_TASK)), key)


def once_listed(lineitem: DataFrame, copies_together: bool = False) -> DataFrame:
    if copies_together:
        base = _copies_together(lineitem.selectExpr(*BASE_COLUMNS), planned_bytes(lineitem))
    else:
        base = spread(lineitem).selectExpr(*BASE_COLUMNS)
    return base.selectExpr(*(f"{sql} AS {name}" for name, sql in LISTING_COLUMNS.items()))


def raw_listings(lineitem: DataFrame, copies_together: bool = False) -> DataFrame:
    """Every line item as a listing; those three minutes from a station are listed twice.

    With ``copies_together`` listings of one duplicate key are made in one task.
    """
    again = F.col("distance_to_nearest_station") == 3
    urls = F.when(again, F.array("url", F.concat("url", F.lit(AGAIN)))).otherwise(F.array("url"))
    return once_listed(lineitem, copies_together).withColumn("url", F.explode(urls)).select(RAW_COLUMNS)


def _text(name: str) -> str:
    return f"coalesce({name}, '')"


UNIT_HTML = (
    "'<tr class=\"js-cassette_link\"><td></td><td> </td><td> ', {floor}, '</td>"
    '<td><span class="cassetteitem_price cassetteitem_price--rent">\', {rent}, \'</span>'
    '<span class="cassetteitem_price cassetteitem_price--administration">\', {management_fee}, \'</span></td>'
    '<td><span class="cassetteitem_price cassetteitem_price--deposit">\', {deposit}, \'</span>'
    '<span class="cassetteitem_price cassetteitem_price--gratuity">\', {key_money}, \'</span></td>'
    '<td><span class="cassetteitem_madori">\', {floor_plan}, \'</span>'
    '<span class="cassetteitem_menseki">\', {area}, \'</span></td>'
    '<td class="ui-text--midium ui-text--bold"><a href="\', {href}, \'">detail</a></td></tr>\''
)


def _unit(href: str) -> str:
    return UNIT_HTML.format(href=href, **{c: _text(c) for c in RAW_COLUMNS})


def listing_pages(lineitem: DataFrame, listed: bool = False, extra: list[str] | None = None) -> DataFrame:
    """One listing page per line item, holding exactly the rows of ``raw_listings``.

    The page has the listing's building, with a second unit where the listing
    appears twice, and a building without units, which must leave no row.
    """
    path = f"substr(url, {len(BASE_URL)})"
    building = (
        "concat('<div class=\"cassetteitem\">', "
        "coalesce(concat('<div class=\"cassetteitem_content-title\">', title, '</div>'), ''), "
        "'<ul><li class=\"cassetteitem_detail-col1\">', address, '\\n</li><li class=\"cassetteitem_detail-col2\">', "
        "coalesce(concat('<div class=\"cassetteitem_detail-text\">', "
        "replace(stations, ',', '</div><div class=\"cassetteitem_detail-text\">'), '</div>'), ''), "
        "'<li class=\"cassetteitem_detail-col3\"><div>', building_age, '</div><div>', building_size, '</div></li></ul><table>', "
        f"{_unit(path)}, "
        f"CASE WHEN distance_to_nearest_station = 3 THEN concat({_unit(f'concat({path}, {AGAIN!r})')}) ELSE '' END, "
        "'</table></div>')"
    )
    empty = "'<div class=\"cassetteitem\"><div class=\"cassetteitem_content-title\">No units</div></div>'"
    rows = lineitem if listed else once_listed(lineitem)
    return rows.selectExpr("url", *(extra or []), f"concat('<html><body>', {building}, {empty}, '</body></html>') AS html")


# A building has its picture in the second of two boxes, which is the first with an image; A1, A11, A21, ... have none.
IMAGE = "CASE WHEN address LIKE '%1' THEN NULL ELSE concat('/img/', address, '.jpg') END"


def pictured_pages(lineitem: DataFrame) -> DataFrame:
    """The listing pages with a picture of the building, where it has one."""
    box = "<div class=\"cassetteitem_object\">"
    image = f"concat('{box}</div>{box}<img src=\"x.gif\" rel=\"', image, '\"><img rel=\"second.jpg\"></div>')"
    opened = "<div class=\"cassetteitem\">"
    pages = listing_pages(once_listed(lineitem).withColumn("image", F.expr(IMAGE)), listed=True, extra=["image"])
    return pages.selectExpr("url", f"concat(substr(html, 1, instr(html, '{opened}') + {len(opened) - 1}), coalesce({image}, ''), substr(html, instr(html, '{opened}') + {len(opened)})) AS html")


PAGE_URL = f"{BASE_URL}/p/"


def crawled_pages(pages: DataFrame) -> DataFrame:
    """The given pages as one crawl: each with the pagination list of its page number."""
    pagination = (
        "concat('<ol><li class=\"pagination-current\">', page_id, '</li><li><a href=\"/p/', page_id + 1, '\">next</a></li>"
        "<li><a href=\"/p/', page_id + 2, '\">after</a></li></ol>')"
    )
    return pages.selectExpr("page_id", f"concat('{PAGE_URL}', page_id) AS url", f"concat({pagination}, html) AS html")
