import subprocess
import sys

import pytest
from pyspark import cloudpickle

from tsubo.functions import page_text
from tsubo.operators import pages
from tsubo.sources import tables
from tsubo.streaming import intake

BASE = "https://example.org/"
BUILDING = """<div class="cassetteitem">
  <div class="cassetteitem_object"><img rel="/i/1.png" src="x"></div>
  <div class="cassetteitem_content-title"> Building &amp; T1 </div>
  <ul><li class="cassetteitem_detail-col1">Address 1</li>
      <li class="cassetteitem_detail-col2">
        <div class="cassetteitem_detail-text">A線/甲駅 歩5分</div>
        <div class="cassetteitem_detail-text">B線/乙駅 歩8分</div></li>
      <li class="cassetteitem_detail-col3"><div>築12年</div><div>3階建</div></li></ul>
  <table>UNITS</table>
</div>"""
UNIT = """<tr class="js-cassette_link extra">
    <td></td><td></td><td>　2階 </td>
    <td><span class="cassetteitem_price cassetteitem_price--rent">8.3万円</span>
        <span class="cassetteitem_price cassetteitem_price--administration">5000円</span></td>
    <td><span class="cassetteitem_price cassetteitem_price--deposit">8.3万円</span>
        <span class="cassetteitem_price cassetteitem_price--gratuity">-</span></td>
    <td><span class="cassetteitem_madori">ワン<script>x()</script>ルーム</span>
        <span class="cassetteitem_menseki">25.5m<sup>2</sup></span></td>
    <td class="ui-text--midium ui-text--bold"><a href="/l/1">detail</a></td></tr>"""
BARE_UNIT = '<tr class="js-cassette_link"><td>1<td>2</tr>'
BARE_BUILDING = '<div class="cassetteitem"><li class="cassetteitem_detail-col3"><div>新築</div><table>UNITS</table></div>'
PAGINATION = '<ol><li class="pagination-current">1</li><li><a href="/p/2">2</a></li><li><a href="/p/3">3</a></li></ol>'


def page_table(spark, *html):
    return spark.createDataFrame([(f"p{i}", h) for i, h in enumerate(html)], "url STRING, html STRING")


def test_listing_golden(spark):
    row = pages.extract_listings(page_table(spark, BUILDING.replace("UNITS", UNIT) + PAGINATION), BASE, with_image=True).collect()
    assert [r.asDict() for r in row] == [
        {
            "img": "/i/1.png", "title": "Building & T1", "address": "Address 1", "building_age": "築12年", "building_size": "3階建",
            "stations": "A線/甲駅 歩5分,B線/乙駅 歩8分", "nearest_station": "甲駅", "distance_to_nearest_station": 5,
            "avg_distance_to_stations": 6.5, "url": "https://example.org/l/1", "rent": "8.3万円", "management_fee": "5000円",
            "deposit": "8.3万円", "key_money": "-", "floor": "2階", "floor_plan": "ワンルーム", "area": "25.5m2",
        }
    ]


def test_variants(spark):
    html = BUILDING.replace("UNITS", UNIT + BARE_UNIT) + BARE_BUILDING.replace("UNITS", BARE_UNIT) + BUILDING.replace("UNITS", "")
    table = page_table(spark, html, "<html>nothing here", "", None)
    found = pages.extract_listings(table, BASE)
    assert found.columns == pages.RAW_COLUMNS
    rows = sorted((r.asDict() for r in found.collect()), key=str)
    assert len(rows) == 3
    bare = [r for r in rows if r["title"] is None]
    assert len(bare) == 1 and bare[0]["building_age"] == "新築"
    assert all(bare[0][c] is None for c in pages.RAW_COLUMNS if c != "building_age")
    assert sorted(str(r["floor"]) for r in rows) == ["2階", "None", "None"]
    counts = pages.block_rejects(pages.building_blocks(table)).first()
    assert tuple(counts) == (3, 1, 3)


@pytest.mark.parametrize(
    "html, expected",
    [
        (PAGINATION, "https://example.org//p/3"),
        ("<li class='pagination-current'>9</li><li><a href='/p/10'>10</a></li>", None),
        ("<li class='x'>1</li><li><a href='/p/2'>2</a></li><li><a href='/p/3'>3</a></li>", None),
        ("<ul><li class=pagination-current>1<li>2<li>3</ul>", None),
        ("<ul><li class=pagination-current>1<li>2<li><a>3</a></ul>", None),
        ("<ul><li class=pagination-current>1<li>2<li><a href=/n>3</a></ul>", "https://example.org//n"),
    ],
)
def test_next_page(spark, html, expected):
    assert pages.next_pages(page_table(spark, html), BASE).first()["next_url"] == expected


def test_frontier_and_duplicates(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "c"), ("d", None)], "url STRING, next_url STRING")
    assert [r["url"] for r in pages.frontier(chain).collect()] == ["c"]
    assert [tuple(r) for r in pages.duplicate_pages(chain).collect()] == [("b", 2)]


def test_a_page_with_very_many_buildings(spark):
    html = BUILDING.replace("UNITS", UNIT) * (pages.ROWS_PER_BATCH + 5)
    assert pages.extract_listings(page_table(spark, html), BASE).count() == pages.ROWS_PER_BATCH + 5


def test_stream_appends_new_pages_only(spark, tmp_path):
    source, output, progress = (str(tmp_path / n) for n in ("pages", "listings", "progress"))
    batch = page_table(spark, BUILDING.replace("UNITS", UNIT)).selectExpr("0L AS page_id", "url", "html")
    for expected in (1, 2):
        batch.write.mode("append").parquet(source)
        stream = intake.read_page_stream(spark, source)
        intake.append_listings(stream, BASE, output, progress).awaitTermination()
        assert spark.read.schema(tables.LISTINGS_RAW_SCHEMA).parquet(output).count() == expected


def test_page_functions_need_no_installed_package():
    load = (
        "import sys\nfrom pyspark import cloudpickle\nblocks, read = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "assert 'tsubo' not in sys.modules\nprint(len(list(blocks('u', read('<div class=cassetteitem>x</div>')))))"
    )
    job = cloudpickle.dumps((pages._blocks, page_text.read_page))
    done = subprocess.run([sys.executable, "-c", load], input=job, capture_output=True, cwd="/", check=True)
    assert done.stdout.strip() == b"1"


def test_unmatched_end_tags_change_nothing_and_cost_linear_time():
    import time

    from tsubo.functions import page_text

    def taken(n):
        began = time.process_time()
        root = page_text.read_page("<div>" * n + "</b>" * n + "x</div>y")
        assert len(root.page.elements) == n + 1 and page_text.text(root) == "xy"
        return time.process_time() - began

    taken(2000)
    # 16 times the size: a quadratic scan would take 256 times as long
    assert taken(32000) < 80 * max(taken(2000), 0.005)


def test_tokens_of_broken_pages_equal_one_plain_expression():
    """Reading step by step finds what trying the whole expression at every place finds."""
    import random
    import re

    from tsubo.functions.page_text import Tokens

    tag = r"""<(?:(/)?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*+>)"""
    plain = re.compile(tag, re.S)
    rng = random.Random(7)
    parts = ["<", "<", "a", "</", ">", "'", '"', " x=", "!", "--", "-->", "<!--", "<b", "?", "/", " "]
    for _ in range(20_000):
        html = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))
        assert list(Tokens(html).read(0)) == [(m.start(), m.end(), *m.groups()) for m in plain.finditer(html)], html


@pytest.mark.parametrize("unit", ["<a x='", "<a x=\"'", "<a ", "<!", "<a '<b \"", "</a x=\"", "<a'\"'", "</", "<script></script><a '", "<a b='<c\" "])
def test_broken_tags_cost_linear_time(unit):
    import time

    from tsubo.functions import page_text

    def taken(n):
        began = time.process_time()
        page_text.read_page(unit * n + "'")
        return time.process_time() - began

    taken(1000)
    assert taken(32000) < 80 * max(taken(2000), 0.005)


def seen(root):
    return [(e.tag, e.parent and e.parent.place, e.place, e.end, page_text.text(e), e.get("href"), sorted(e.classes)) for e in root.page.elements]


def test_pages_of_one_make_share_their_tree_and_read_the_same():
    import random

    rng = random.Random(11)
    reader = page_text.Reader()
    parts = [
        "<div class='a b'>", "<div class=a>", "</div>", "<li>", "<a class=x href=/l/%d>", "<A HREF='/%d' CLASS='x y'>", "</a>", "<img class='&amp;'>",
        "<script>%d<li></scriptx></SCRIPT >", "<style>", "</style>", "<!-- <li> -->", "&am", "p;%d", "万%d", " ", "<br/>", "<script src=x/>", "<rt>", "</rt>", "<td>", "<tr>", "<a x='", "</",
    ]
    for _ in range(8000):
        html = "".join(p.replace("%d", str(rng.randrange(100))) for p in rng.choices(parts, k=rng.randrange(5)))
        assert seen(reader.read(html)) == seen(page_text.read_page(html)), html
    one = page_text.Reader()
    for i in range(50):
        page = one.read(BUILDING.replace("UNITS", UNIT.replace("/l/1", f"/l/{i}").replace("8.3", f"{i}.3")))
        found = next(pages._blocks("u", page))["units"][0]
        assert (found["href"], found["rent"]) == (f"/l/{i}", f"{i}.3万円")
    assert len(one.trees) == 1


def test_a_reader_forgets_trees_and_keeps_its_bound(monkeypatch):
    monkeypatch.setattr(page_text, "ELEMENTS_HELD", 100)
    reader = page_text.Reader()
    for i in range(100):
        html = "<b>" * (i % 60) + "x"
        assert seen(reader.read(html)) == seen(page_text.read_page(html))
        assert sum(len(t.page.elements) for t in reader.trees.values()) <= 100


@pytest.mark.parametrize("unit", ["<a x='", "<!", "<script></script><a '", "<script>", "<script ", "<style>x"])
def test_a_reader_of_broken_pages_costs_linear_time(unit):
    import time

    def taken(n):
        began = time.process_time()
        page_text.Reader().read(unit * n + "'")
        return time.process_time() - began

    taken(1000)
    assert taken(32000) < 80 * max(taken(2000), 0.005)


@pytest.mark.parametrize("name", ["html_block_rejects", "html_images", "html_roundtrip_listings", "html_strict_stations"])
def test_pages_made_of_dealt_rows_are_not_dealt_again(spark, tmp_path, name):
    from tsubo.plans import registry

    line = "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_suppkey LONG, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE"
    spark.createDataFrame([(1, 1, 1, 1, 1.0, 9.0, 0.1, 0.1)], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = registry.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") <= 1


class Pages:
    """A table of pages for ``pages._read`` without a session: its function over Arrow batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, ddl):
        return run


def all_elements(url, root):
    for e in root.page.elements[1:]:
        below = [*page_text.elements(e, "a"), *page_text.elements(e, "a", "x")]
        yield {"url": url, "place": e.place, "text": page_text.text(e), "href": e.get("href"), "css": e.get("class"), "below": [page_text.text(a) for a in below], "links": [{"h": a.get("href"), "x": a.get("x")} for a in below]}


def read_rows(html, rows, schema, urls=None):
    import pyarrow as pa

    table = pa.table({"url": urls or [str(i) for i in range(len(html))], "html": pa.array(html, pa.string())})
    found = pa.Table.from_batches(pages._read(Pages(), rows, schema, "", deal=False)(iter(table.slice(1).to_batches(700) + table.slice(0, 1).to_batches())), schema)
    found.validate(full=True)
    return sorted(found.to_pylist(), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_pages_that_fit_a_form_read_the_same(monkeypatch, seed):
    import random

    import pyarrow as pa

    text, links = pa.string(), pa.list_(pa.struct([("h", pa.string()), ("x", pa.string())]))
    schema = pa.schema([("url", text), ("place", pa.int64()), ("text", text), ("href", text), ("css", text), ("below", pa.list_(text)), ("links", links)])
    rng = random.Random(seed)
    parts = [
        "<div class='a b'>%t", "<div class=a id=%w>%t", "</div>%t", "<li>%t", "%t", "<a class=x href=\"%v\" x='%v'>%t", "<A x HREF='%v' href='%v' CLASS='x y'>%t", "<a href=%w>%t", "</a>%t",
        "<img class='&amp;' src=\"%v\">", "<script x='%v'>%t</scriptx></SCRIPT >%t", "<script>", "<style>b</style>", "<!-- <li> -->", "<!-->", "<!--%t", "-->", "<!doctype %w>", "<rt>%t</rt>",
        "<a class='%c' href='%v'>%t", "<td>%t", "<tr>%t", "<br/>%t", "<a x='", "</", "<a b\"x=\" href=\"%w\">%t", "<a 'href=' x='%v'>", "<p title=\"%v\" y>%t</p>",
    ]
    texts = ["", "", " ", "\u3000万\x1f", "a", "&", "&am", "p;", "&nbsp;b", "1 < 2", "<", ">", "x='", '"', "-->", "</a>", "é"]
    values = ["", "/l/1", " 万 ", "&amp;", "a>b", "<li>", "'", '"', "é"]

    def page(shape):
        for name, choices in (("%t", texts), ("%v", values), ("%w", ["w", "1", "万"]), ("%c", ["x", "y", "x y", ""])):
            while name in shape:
                # most pages of a make have plain values
                shape = shape.replace(name, rng.choice(choices) if rng.random() < 0.3 else rng.choice(choices[:4]), 1)
        return shape

    shapes = ["".join(rng.choices(parts, k=rng.randrange(6))) for _ in range(120)]
    html = [page(rng.choice(shapes)) for _ in range(6000)] + [None, ""]
    monkeypatch.setattr(pages, "FORMS_HELD", 0)
    expected = read_rows(html, all_elements, schema)
    for name, value in (("FORMS_HELD", 10_000), ("FORMS_TRIED", 10_000), ("FORM_PAGES", 2), ("ROWS_PER_BATCH", 50)):
        monkeypatch.setattr(pages, name, value)
    made = []
    monkeypatch.setattr(pages, "_make", lambda *given, make=pages._make: made.append(make(*given)) or made[-1])
    assert read_rows(html, all_elements, schema) == expected
    assert sum(make is not None for make in made) > 50


@pytest.mark.parametrize(
    "page, other",
    [
        ('<a b"x=" href="w">t</a>', '<a b"x=">"w">t</a>'),
        ("<p>a<!-->", "<p>a<!-->b"),
        ("<p>a<!-- b", "<p>a<!-- b-->c"),
        ("<p><script>x", "<p><script>xy"),
        ("<p><script>x</script>a", "<p><script>xy</script>a"),
        ("<p><script>x</script>a", "<p><script></script>x</script>a"),
        ("<p><a class='x'>t</a>", "<p><a class='y'>t</a>"),
        ("<p><a class=x href='1'>t</a>", "<p><a class=x href='1' class='y'>t</a>"),
        ("<p><a href='1' class='x'>t</a>", "<p><a href='1' class='' class='x'>t</a>"),
        ("<p><a href=1>t</a>", "<p><a href=2>t</a>"),
        ("<p>1 < 2<b>", "<p>1 <i<b>"),
        ("", "x"),
    ],
)
def test_a_form_takes_no_page_of_another_tree(monkeypatch, page, other):
    import pyarrow as pa

    text, links = pa.string(), pa.list_(pa.struct([("h", pa.string()), ("x", pa.string())]))
    schema = pa.schema([("url", text), ("place", pa.int64()), ("text", text), ("href", text), ("css", text), ("below", pa.list_(text)), ("links", links)])
    monkeypatch.setattr(pages, "FORM_PAGES", 2)
    for first, second in ((page, other), (other, page)):
        html = [first] * 4 + [second] * 2
        plain = [row for i, h in enumerate(html) for row in all_elements(str(i), page_text.read_page(h))]
        assert read_rows(html, all_elements, schema) == sorted(plain, key=str)


def test_most_pages_of_a_make_are_read_without_a_tree(monkeypatch):
    read = []
    monkeypatch.setattr(page_text.Reader, "read", lambda self, html, plain=page_text.Reader.read: read.append(html) or plain(self, html))
    units = [UNIT.replace("/l/1", f"/l/{i}").replace("8.3", f"{i} &amp; {i}.3") for i in range(3000)]
    html = [BUILDING.replace("UNITS", unit if i % 3 else unit + unit) for i, unit in enumerate(units)]
    found = read_rows(html, pages._blocks, pages.BLOCK_TYPE)
    assert len(read) == 2 * pages.FORM_PAGES
    assert sorted(u["href"] for b in found for u in b["units"]) == sorted(f"/l/{i}" for i in range(3000) for _ in range(1 if i % 3 else 2))
    assert {b["units"][0]["rent"] for b in found} == {f"{i} & {i}.3万円" for i in range(3000)}
    assert {(b["title"], b["units"][0]["floor_plan"], b["units"][0]["cells"][2]) for b in found} == {("Building & T1", "ワンルーム", "2階")}


def test_the_most_common_make_comes_to_be_tried(monkeypatch):
    read = []
    monkeypatch.setattr(page_text.Reader, "read", lambda self, html, plain=page_text.Reader.read: read.append(html) or plain(self, html))
    rare = [f"<li>{i}" * n for n in range(1, 9) for i in range(pages.FORM_PAGES)]
    read_rows(rare + [BUILDING.replace("UNITS", UNIT)] * 3000, pages._blocks, pages.BLOCK_TYPE)
    assert len(read) < 8 * pages.FORM_PAGES + 2 * pages.FORM_PAGES


def test_invalid_utf8_is_still_refused():
    import pyarrow as pa

    html = pa.array([b"<p>\xff</p>"], pa.binary()).view(pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(["u"]), html], names=["url", "html"])
    with pytest.raises((UnicodeDecodeError, pa.ArrowInvalid)):
        list(pages._read(Pages(), pages._blocks, pages.BLOCK_TYPE, "", deal=False)(iter([batch])))


@pytest.mark.parametrize("strict", [False, True])
def test_every_station_pattern_is_searched_for_once(spark, strict):
    from tsubo.functions import stations

    found = pages.extract_listings(page_table(spark, BUILDING.replace("UNITS", UNIT)), BASE, strict_stations=strict)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(stations.STATION_NAME) == 1
    assert plan.count(stations.WALK_MINUTES if strict else stations.DIGIT_RUN) == 1
