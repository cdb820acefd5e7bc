"""Files and pages with awkward content."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tamarind.plans import launches
from tamarind.sources import files, html


def test_csv_with_quoted_line_breaks_bom_and_blank_header(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("﻿Basket,,Outcome\nSữa - Phấn,1,\"Success\n\"\n\"a \"\"b\"\"\",2,\"5,000–6,000 kg\"\n".encode("utf-8"))
    df = files.read_csv(spark, str(path))
    assert df.columns == ["Basket", "_c1", "Outcome"]
    assert [tuple(r) for r in df.orderBy("_c1").collect()] == [("Sữa - Phấn", 1, "Success\n"), ('a "b"', 2, "5,000–6,000 kg")]


def test_csv_types_are_inferred(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("n,d,f,b\n1,2010-06-04,1.5,True\n2,,,\n")
    df = files.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["int", "date", "double", "boolean"]


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16"])
def test_csv_round_trip(spark, tmp_path, encoding):
    data = [(1, "x,y", None), (2, 'say "hi"', "two\nlines"), (3, "  blanks  ", ""), (4, "đường\\", "\r\n"), (5, None, "'")]
    df = spark.createDataFrame(data, "id int, a string, b string")
    files.write_csv(df, str(tmp_path / "out"), encoding, rows_per_file=2)
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema, encoding)
    # An empty cell is a missing value, quoted or not.
    expected = [(i, a, b or None) for i, a, b in data]
    assert [tuple(r) for r in back.orderBy("id").collect()] == expected


def test_json_arrays_and_structs(spark, tmp_path):
    core = {"core": "c1", "flight": 1, "gridfins": True, "legs": False, "reused": False, "landing_success": None, "landing_type": "ASDS"}
    records = [
        {"flight_number": 1, "date_utc": "2020-11-13T10:00:00.000Z", "rocket": "r", "payloads": ["p"], "cores": [core]},
        {"flight_number": 2, "date_utc": "2020-11-14T00:00:00.000Z", "rocket": "r", "payloads": ["p"], "cores": [core]},
        {"flight_number": 3, "date_utc": "2010-01-01T00:00:00.000Z", "rocket": "r", "payloads": ["p", "q"], "cores": [core]},
        {"flight_number": 4, "date_utc": "2010-01-01T00:00:00.000Z", "rocket": "r", "payloads": ["p"], "cores": []},
        {"flight_number": 5, "date_utc": "2010-01-01T00:00:00.000Z", "rocket": "r", "payloads": ["p"]},
    ]
    path = tmp_path / "launches.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    documents = spark.read.text(str(path)).withColumnRenamed("value", "launch")
    kept = launches.single_core_launches(launches.from_documents(documents), dt.date(2020, 11, 13))
    assert [r.flight_number for r in kept.collect()] == [1]
    assert [tuple(r) for r in launches.core_outcomes(kept).collect()] == [(1, "c1", "None ASDS", 1, True, False, False, None)]
    nested = files.read_json(spark, str(path), "flight_number int, rocket string, cores array<struct<core:string>>")
    assert nested.count() == 5


def test_flatten_names_leaves_by_path(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("b"), F.struct(F.lit(2).alias("d.e")).alias("c")).alias("a"), F.array(F.lit(3)).alias("f")
    )
    assert files.flatten_structs(df).columns == ["a.b", "a.c.d.e", "f"]
    assert files.flatten_structs(df, "_").columns == ["a_b", "a_c_d.e", "f"]


def test_trimming_knows_unicode_blanks(spark):
    df = spark.createDataFrame([("\u3000 \t a\u00a0b \u2009\n",), ("",), (None,)], "x string")
    assert [r.v for r in df.select(html.plain_text(F.col("x")).alias("v")).collect()] == ["a\u00a0b", "", None]


PAGE = """<html><title> A &amp; B </title><table><TBODY><tr><td>x</td><td>y</td></tr></TBODY></table>
<table><tbody class="q"><tr><td>2020-12-31</td><td>$10,744</td></tr>
<tr><td><b>2019-12-31</b></td><td></td></tr></tbody></table></html>"""


def test_second_table_of_a_page(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<tbody><tr><td>only</td></tr></tbody>"), (3, None)], "page_id int, html string")
    got = [tuple(r) for r in html.table_rows(pages).orderBy("row_no").collect()]
    assert got == [(1, 0, "2020-12-31", "$10,744"), (1, 1, "2019-12-31", "")]
    titles = {r.page_id: r.t for r in pages.select("page_id", html.element_text(F.col("html"), "title").alias("t")).collect()}
    assert titles == {1: "A & B", 2: None, 3: None}


def test_unknown_ids_keep_their_rows(spark):
    ids = spark.createDataFrame([(1, 1, 1, 1, 1), (2, 1, None, 7, None)], "n int, rocket_id int, launchpad_id int, payload_id int, core_id int")
    def dim(key, attribute):
        return spark.createDataFrame([(1, attribute)], f"{key} int, {attribute} string")
    got = launches.resolve_ids(ids, dim("rocket_id", "v"), dim("launchpad_id", "s"), dim("payload_id", "o"), dim("core_id", "c"))
    assert [tuple(r) for r in got.orderBy("n").select("n", "v", "s", "o", "c").collect()] == [
        (1, "v", "s", "o", "c"), (2, "v", None, None, None)
    ]


def test_tables_for_sql(spark):
    files.publish(spark.range(3), "three_rows")
    assert spark.sql("select count(*) from three_rows").first()[0] == 3
    files.publish(spark.range(4), "three_rows")
    assert spark.sql("select count(*) from three_rows").first()[0] == 4
    for n in (5, 6):
        files.save_table(spark.range(n), "stored_rows")
        assert spark.table("stored_rows").count() == n
    spark.sql("drop table stored_rows")


def test_text_cleaning_runs_on_a_stream(spark, tmp_path):
    from tamarind.functions.text import clean_comment

    source, sink = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame([("Hay!!!",), ("KO",)], "text string").write.parquet(str(source))
    stream = spark.readStream.schema("text string").parquet(str(source)).select(clean_comment(F.col("text")).alias("clean"))
    job = (
        stream.writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    job.awaitTermination(60)
    assert sorted(r.clean for r in spark.read.parquet(str(sink)).collect()) == ["hay", "không"]


def test_entities_scripts_and_comments(spark):
    from tamarind.sources.html import plain_text

    page = "<style>a{}</style>A&#38;B &#x20AC; &copy; &middot; &amp;#65; &#0; &bogus; <!-- <b>no</b> --><script>var t='<p>';</script>z"
    row = spark.createDataFrame([(page,), (None,)], "html string").select(plain_text(F.col("html")).alias("t")).collect()
    assert [r.t for r in row] == ["A&B € © · &#65; &#0; &bogus; z", None]
