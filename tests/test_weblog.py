"""DOM-9 weblog parsing: good lines, header line, junk, tags."""

from pyspark.sql import functions as F

from conftest import ts
from tidemark.functions.dates import lit_ts
from tidemark.plans import weblog
from tidemark.sources.files import read_weblog

INGEST = ts("2024-02-01 00:00:00")


def views(spark, rows):
    df = spark.createDataFrame(rows, "IP string, Time string, URL string, Status string")
    return {r["IP"]: r for r in weblog.page_views(df, lit_ts(INGEST)).collect()}


def test_weblog_cases(spark):
    v = views(spark, [
        ("good", "[13/Mar/2024:10:11:12", "GET /login.php?x=1&y=[2] HTTP/1.1", " 2 00 "),
        ("noparam", "[13/Mar/2024:10:11:12", "POST /a/b-c_d.html HTTP/1.1", "404"),
        ("header", "Time", "URL", "Status"),
        ("nobracket", "13/Mar/2024:10:11:12", "GET / HTTP/1.1", "200"),
        ("badmonth", "[13/Foo/2024:10:11:12", "ReadInput", ""),
    ])
    g = v["good"]
    assert (g["page_visited"], g["page_params"], g["Status"], g["URL"]) == ("/login.php", "?x=1&y=[2]", 200, None)
    assert g["event_time"] == ts("2024-03-13 10:11:12") and g["tags"] == [] and g["type"] == "weblog"
    n = v["noparam"]
    assert (n["page_visited"], n["page_params"], n["Status"]) == ("/a/b-c_d.html", None, 404)
    h = v["header"]
    assert h["URL"] == "URL" and h["page_visited"] is None and h["Status"] is None
    assert h["tags"] == ["_grokparsefailure", "_dissectfailure", "_convertfailure", "_dateparsefailure"]
    assert h["event_time"] == INGEST
    nb = v["nobracket"]
    assert nb["tags"] == ["_dissectfailure"] and nb["event_time"] == ts("2024-03-13 10:11:12")
    assert nb["page_visited"] == "/"
    b = v["badmonth"]
    assert b["tags"] == ["_grokparsefailure", "_dateparsefailure"] and b["Status"] is None


def test_clean_view_and_counts(spark):
    df = spark.createDataFrame([("a", "[01/Jan/2024:00:00:01", "GET /x.php HTTP/1.1", "200"),
                                ("b", "[01/Jan/2024:00:00:02", "GET /x.php HTTP/1.1", "200"),
                                ("c", "Time", "URL", "Status")], "IP string, Time string, URL string, Status string")
    v = weblog.page_views(df, lit_ts(INGEST))
    assert weblog.clean_views(v).count() == 2
    c = {(r["page_visited"], r["Status"]): r["views"] for r in weblog.page_view_counts(v).collect()}
    assert c == {("/x.php", 200): 2, (None, None): 1}


def test_keyword_copies_only_short_values(spark):
    df = spark.createDataFrame([("x" * 256, "y" * 257)], "a string, b string")
    r = weblog.keyword_fields(df, ("a", "b")).first()
    assert r["a_keyword"] == "x" * 256 and r["b_keyword"] is None


def test_weblog_csv_reader_keeps_header_as_event(spark, tmp_dir):
    path = f"{tmp_dir}/weblog.csv"
    with open(path, "w") as fh:
        fh.write("IP,Time,URL,Status\n10.0.0.1,[01/Jan/2024:00:00:01,GET /x.php HTTP/1.1,200\n")
    v = weblog.page_views(read_weblog(spark, path), lit_ts(INGEST))
    assert v.count() == 2 and v.filter(F.size("tags") > 0).count() == 1
