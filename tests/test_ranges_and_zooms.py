"""CSV by byte ranges, nested elements, inferred date formats, zoom levels and merged day bitmaps."""

import datetime as dt
import os
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tamarind.functions.dates import inferred_format, parse_inferred
from tamarind.operators import places
from tamarind.plans import loyalty
from tamarind.sources import files, html
from tamarind.sources.csv_ranges import _lines, read_csv_ranges

PAGES = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001") + "/pages.parquet"


@pytest.fixture
def cut(spark):
    """Sets the bytes of a range; the session's own value comes back afterwards."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, f"{size}b")
    spark.conf.set(key, before)


def _values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [61, 100, 509])
def test_ranges_cut_through_cells(spark, tmp_path, cut, size):
    rows = [(i, "x" * (i % 5) or None, f'two\nlines "{i}"\r\n,\n' * (i % 3) or None, 'a"\n"b') for i in range(60)]
    # One record longer than many ranges, with ranges that lie wholly inside its cell.
    rows.append((99, "long", "\n".join(["é" * 20] * 30), "end"))
    df = spark.createDataFrame(rows, "id int, a string, b string, c string").repartition(2)
    path = str(tmp_path / "out")
    files.write_csv(df, path)
    want = _values(files.read_csv(spark, path, df.schema))
    cut(size)
    assert _lines(spark, path).rdd.getNumPartitions() > 6
    assert _values(read_csv_ranges(spark, path, df.schema)) == want == _values(df)


def test_every_cut_of_a_small_file(spark, tmp_path, cut):
    path = tmp_path / "in.csv"
    path.write_bytes('"k\n""ey",v\r\n1,"a\n\n""b"""\r\n\r\n2,\r\n"3","\n"'.encode())
    for size in range(4, 40, 5):
        cut(size)
        assert _values(read_csv_ranges(spark, str(path), "k int, v string")) == [(1, 'a\n\n"b"'), (2, None), (3, "\n")]


@pytest.mark.parametrize("content", ["", "k,v\n"])
def test_a_file_without_rows(spark, tmp_path, content):
    path = tmp_path / "in.csv"
    path.write_text(content)
    assert read_csv_ranges(spark, str(path), "k int, v string").collect() == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<t>a<t>b</t>c</t><t class='x'>d</t>", ["a<t>b</t>c", "b", "d"]),
        ("</t>x<t>1</t>", ["1"]),
        ("<t>open<t>b</t>", ["open<t>b</t>", "b"]),
        ("<T\n>1</T ><tt>no</tt>", ["1"]),
        ("none", []),
        ("", []),
        (None, None),
        ("<t>" * 700 + "x" + "</t>" * 700, ["<t>" * i + "x" + "</t>" * i for i in range(699, -1, -1)]),
        ("<t>z</t>" * 1000, ["z"] * 1000),
    ],
)
def test_elements(spark, text, expected):
    df = spark.createDataFrame([(text,)], "h string")
    assert df.select(html.elements(F.col("h"), "t").alias("e")).first().e == expected


def test_table_inside_a_cell(spark):
    inner = "<table><tr><td>i1</td><td>i2</td></tr></table>"
    page = (
        f"<table><tr><td>first</td></tr></table><!-- <table> --><script>'<table>'</script>"
        f"<table><tr><td>a</td><td>{inner}</td></tr><tr><td>b</td><td>c</td></tr></table>"
    )
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string")
    rows = html.table_rows(df, container="table", row="tr", cell="td", position=1, cells=("x", "y")).orderBy("row_no").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a", "i1i2"), (1, 1, "i1", "i2"), (1, 2, "b", "c")]
    rows = html.table_rows(df, container="table", row="tr", cell="td", position=2, cells=("x", "y")).collect()
    assert [tuple(r) for r in rows] == [(1, 0, "i1", "i2")]


class _Depths(HTMLParser):
    """Text length of every element of a tag, by a stack."""

    def __init__(self, tag):
        super().__init__(convert_charrefs=False)
        self.tag, self.open, self.lengths = tag, [], []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.open.append(len(self.lengths))
            self.lengths.append(0)

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.open.pop()

    def handle_data(self, data):
        for i in self.open:
            self.lengths[i] += len(data)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="test tables are missing")
@pytest.mark.parametrize("tag", ["div", "ul", "p"])
def test_elements_of_real_pages(spark, tag):
    page = F.regexp_replace("html", html._SILENT, "")
    found = spark.read.parquet(PAGES).filter("html is not null").select(
        page.alias("page"),
        F.transform(html.elements(page, tag), lambda e: F.length(F.regexp_replace(e, r"(?s)<[^>]*>|&#?[A-Za-z0-9]+;", ""))).alias("n"),
    )
    for r in found.collect():
        parser = _Depths(tag)
        parser.feed(r.page)
        parser.close()
        assert r.n == parser.lengths


FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy-M-d")


def test_format_of_a_column(spark):
    data = [("us", "03/04/2021"), ("us", "03/25/2021"), ("eu", "03/04/2021"), ("eu", " 25/03/2021 "), ("eu", "junk"),
            ("iso", "2021-03-04"), ("open", "03/04/2021"), ("open", "05/05/2021"), ("none", None), ("none", " "), (None, "13/01/2021")]
    df = spark.createDataFrame(data, "src string, day_text string")
    found = {r.src: tuple(r)[1:] for r in inferred_format(df, "day_text", FORMATS, ["src"]).collect()}
    assert found == {
        "us": ("M/d/yyyy", 2, 0, False), "eu": ("d/M/yyyy", 2, 1, False), "iso": ("yyyy-M-d", 1, 0, False),
        "open": ("M/d/yyyy", 2, 0, True), "none": (None, 0, 0, False), None: ("d/M/yyyy", 1, 0, False),
    }
    days = parse_inferred(df, "day_text", FORMATS, "day", ["src"])
    assert days.columns == ["src", "day_text", "day"] and days.count() == len(data)
    read = {(r.src, r.day_text): r.day for r in days.collect()}
    assert read["us", "03/04/2021"] == dt.date(2021, 3, 4) and read["eu", "03/04/2021"] == dt.date(2021, 4, 3)
    assert read["eu", "junk"] is None and read["none", None] is None and read[None, "13/01/2021"] == dt.date(2021, 1, 13)


def test_one_format_for_a_whole_column(spark):
    df = spark.createDataFrame([(i, f"0{i}/04/2021") for i in range(1, 10)] + [(10, "25/04/2021")], "id int, t string")
    days = {r.id: r.day for r in parse_inferred(df, "t", FORMATS, "day").collect()}
    assert days == {**{i: dt.date(2021, 4, i) for i in range(1, 10)}, 10: dt.date(2021, 4, 25)}
    assert parse_inferred(df.filter("id < 0"), "t", FORMATS, "day").collect() == []


def test_zooms_add_up(spark):
    data = [(None, 1.0, 1), (95.0, 1.0, 1), (90.0, 180.0, 1), (-90.0, -180.0, 0), (0.0, 0.0, None)]
    data += [((i * 37) % 160 - 80 + i / 1000, (i * 61) % 350 - 175.0, i % 2) for i in range(300)] + [(28.5, -80.6, 1)] * 500
    df = spark.createDataFrame(data, "lat double, lon double, class int")
    rows = places.zoom_clusters(df, deepest=6).collect()
    tiles = {(r.zoom, r.tile_x, r.tile_y): r for r in rows}
    assert len(tiles) == len(rows) and tiles[0, 0, 0].records == 803
    for r in rows:
        assert 0 <= r.tile_x < 1 << r.zoom and 0 <= r.tile_y < 1 << r.zoom
        if r.zoom == 6:
            assert r.children is None
            continue
        below = [tiles.get((r.zoom + 1, 2 * r.tile_x + i, 2 * r.tile_y + j)) for i in (0, 1) for j in (0, 1)]
        below = [b for b in below if b]
        assert r.children == len(below) and r.records == sum(b.records for b in below)
        assert r.successes == sum(b.successes for b in below)
    assert places.zoom_clusters(df.filter("lat > 1000")).collect() == []


def test_visit_days_from_stored_months(spark):
    day = dt.date(1969, 12, 1)
    data = [(i % 3, day + dt.timedelta(days=(i * 7) % 90)) for i in range(400)] + [(1, dt.date(2090, 5, 5)), (7, None)]
    sales = spark.createDataFrame(data, "customer_id int, order_date date")
    partials = loyalty.visit_day_partials(sales)
    # Months that were stored twice, as after a repeated load, count once.
    merged = {r.customer_id: r.total_days for r in loyalty.visit_days_of(partials.unionByName(partials)).collect()}
    assert merged == {r.customer_id: r.total_days for r in loyalty.visit_days(sales.filter("customer_id < 7")).collect()}
