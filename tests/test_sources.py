"""Landed CSV and JSON, caps, stop rules, pages, sinks."""

import json

import pytest
from pyspark.sql import types as T

from corpusmill.sources import collect, html, landed, sinks

RECORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])


def put(path, body):
    path.write_text(body, encoding="utf-8")
    return str(path)


@pytest.fixture()
def csvs(tmp_path):
    a = put(tmp_path / "a.csv", 'text,label\n"He said ""hi"",\nthen left",1\n nan ,0\nnan,1\n,NA\n')
    b = put(tmp_path / "b.csv", "text,label,extra\nx,1,e\ny,,e\nz,0,e\n")
    return a, b


def test_csv_quotes_newlines_and_missing(spark, csvs):
    rows = landed.read_csv_in_order(spark, [csvs[0]]).orderBy("row_no").collect()
    assert [(r.text, r.label) for r in rows] == [
        ('He said "hi",\nthen left', "1"), (" nan ", "0"), (None, "1"), (None, None)]
    raw = landed.read_csv(spark, csvs[0], missing=None).collect()
    assert "nan" in [r.text for r in raw]


def test_cap_runs_over_files_in_order(spark, csvs):
    both = landed.read_csv_in_order(spark, list(csvs))
    got = landed.capped_concat(both, 5).orderBy("file_no", "row_no").collect()
    assert [(r.file_no, r.text) for r in got][-1] == (1, "x") and len(got) == 5
    assert landed.capped_concat(both, 2).select("file_no").distinct().count() == 1


def test_normalise(spark, csvs):
    df = landed.normalise(landed.read_csv(spark, csvs[1]), "src", "at", label_map={"1": "pos", "0": "neg"})
    assert df.columns == landed.UNIFIED_COLUMNS
    assert sorted(((r.text, r.label) for r in df.collect()), key=str) == [("x", "pos"), ("y", None), ("z", "neg")]
    bare = landed.normalise(spark.createDataFrame([("  ",)], "text string"), "s", "at").head()
    assert (bare.text, bare.label) == (None, "unknown")


def test_merge(spark):
    a = spark.createDataFrame([("t", "l", 1)], "text string, label string, other int")
    out = landed.merge([a, a.select("label")])
    assert out.columns == landed.UNIFIED_COLUMNS and out.count() == 2
    assert landed.merge([], spark=spark).columns == landed.UNIFIED_COLUMNS


def test_allow_list_has_both_bounds(spark):
    df = spark.createDataFrame([(i, "keep" if i >= 14 else "drop") for i in range(40)], "i int, label string")
    got = [r.i for r in landed.allow_listed(df, "label", ["keep"], 2, "i").collect()]
    assert sorted(got) == [14, 15]
    late = spark.createDataFrame([(i, "keep" if i >= 16 else "drop") for i in range(40)], "i int, label string")
    assert landed.allow_listed(late, "label", ["keep"], 2, "i").count() == 0


def test_split_spec(spark):
    assert landed.parse_split("train[:500]") == ("train", 500) and landed.parse_split(" test ") == ("test", None)
    with pytest.raises(ValueError):
        landed.parse_split("dev[:3]")
    df = spark.createDataFrame([(i, "train" if i % 2 else "test") for i in range(10)], "i int, split string")
    assert [r.i for r in landed.take_split(df, "train[:2]", "i").orderBy("i").collect()] == [1, 3]


def pages(spark, sizes):
    body = lambda p, n: json.dumps({"d": {"r": [{"text": f"{p}.{i}", "label": "x"} for i in range(n)]}})
    return spark.createDataFrame([(p, body(p, n)) for p, n in enumerate(sizes, 1)], "page int, payload string")


@pytest.mark.parametrize("sizes, page_size, cap, want", [
    ([3, 3, 2, 3], 3, 100, 8), ([3, 3, 0, 3], 3, 100, 6), ([3, 3, 2, 3], None, 100, 11),
    ([3, 0, 3], None, 100, 3), ([3, 3, 3], 3, 4, 4), ([0, 5], 5, 10, 0)])
def test_paging_stops(spark, sizes, page_size, cap, want):
    got = landed.paged_records(pages(spark, sizes), RECORD, cap, page_size, "d.r")
    assert got.count() == want


def test_json_roots(spark):
    df = spark.createDataFrame([('[{"text":"a"},{"text":"b"}]',), ('  {"text":"c"}',)], "p string")
    assert sorted(len(r[0]) for r in df.select(landed.json_records(df.p, RECORD)).collect()) == [1, 2]
    bad = spark.createDataFrame([("7",)], "p string")
    with pytest.raises(Exception, match="JSON root"):
        bad.select(landed.json_records(bad.p, RECORD)).collect()


def test_envelopes(spark):
    def batch(off, n, wrap):
        rows = [{"text": f"{off + i}", "label": "l"} for i in range(n)]
        return off, json.dumps({"rows": [{"row": r} for r in rows] if wrap else rows})
    df = spark.createDataFrame([batch(0, 100, True), batch(100, 30, False), batch(200, 100, True)],
                               "offset int, payload string")
    got = landed.envelope_rows(df, RECORD, 1000).orderBy("offset", "pos").collect()
    assert [int(r.text) for r in got] == list(range(130))
    assert landed.envelope_rows(df, RECORD, 105).count() == 105


def test_malformed_bodies_are_errors(spark):
    good = json.dumps([{"text": "a", "label": "l"}] * 3)
    cut = spark.createDataFrame([(1, good), (2, good[:-9]), (3, good)], "page int, payload string")
    with pytest.raises(Exception, match="(?i)malformed"):
        landed.paged_records(cut, RECORD, None, 3).collect()
    body = json.dumps({"rows": [{"row": {"text": "a", "label": "l"}}] * 100})
    for bad in (body[:-20], None):
        batches = spark.createDataFrame([(0, body), (100, bad), (200, body)], "offset int, payload string")
        with pytest.raises(Exception, match="(?i)malformed|no body"):
            landed.envelope_rows(batches, RECORD).collect()


def test_no_cap(spark):
    assert landed.paged_records(pages(spark, [3, 3, 3]), RECORD, page_size=3, path="d.r").count() == 9


def test_sequential_ids(spark):
    df = spark.createDataFrame([(i * 7, f"v{i}") for i in range(500)], "k long, v string").repartition(5)
    got = landed.sequential_id(df, "k").orderBy("k").collect()
    assert [r.id for r in got] == [f"item_{i:04d}" for i in range(500)]


def test_first_csv_below(spark, tmp_path):
    (tmp_path / "z").mkdir()
    put(tmp_path / "z" / "1.csv", "text\nlater\n")
    (tmp_path / "b").mkdir()
    put(tmp_path / "b" / "2.csv", "text\none\ntwo\nthree\n")
    assert [r.text for r in landed.first_csv_below(spark, str(tmp_path), 2).collect()] == ["one", "two"]


PAGE = """<html><head><title>no</title></head><body><nav><a href='/x'> One &amp; two </a></nav>
<article id="main" class="big post"><h1>Head<br>line</h1><p>First <b>bold</b>  text<p>Second
<script>var x = "<p>";</script></p></article><div class="ad">Buy</div><p> </p></body></html>"""


@pytest.mark.parametrize("selector, want", [
    ("nav a", ["One & two"]), ("h1", ["Head\nline"]), ("p", ["First bold text", "Second"]),
    (".post h1, .ad", ["Head\nline", "Buy"]), ("#main.big p", ["First bold text", "Second"]), ("article.other p", []),
    ("span", [])])
def test_selectors(selector, want):
    assert html.select_text(PAGE, html.parse_selector(selector)) == want


def test_bad_selector():
    with pytest.raises(ValueError):
        html.parse_selector("a > b")


def test_scrape(spark):
    df = spark.createDataFrame([(1, "https://host.example:8080/a/b", PAGE), (2, "http://x.example/", None)],
                               "page_id int, url string, html string")
    got = html.scrape(df, "p", "at").collect()
    assert {(r.text, r.label, r.source) for r in got} == {
        ("First bold text", "unknown", "scrape:host.example:8080"), ("Second", "unknown", "scrape:host.example:8080")}
    assert html.extract_elements(df, "p").count() == 2


def test_collect_all_kinds(spark, tmp_path, csvs):
    pages(spark, [2, 1]).write.parquet(str(tmp_path / "pages"))
    env = json.dumps({"rows": [{"row": {"text": f"e{i}", "label": i % 2}} for i in range(6)]})
    spark.createDataFrame([(0, env)], "offset int, payload string").write.parquet(str(tmp_path / "env"))
    spark.createDataFrame([(1, "https://h.example/", PAGE)], "page_id int, url string, html string").write.parquet(
        str(tmp_path / "html"))
    specs = [
        {"type": "hf_dataset", "name": "n", "path": csvs[1], "label_map": {"1": "pos"}},
        {"type": "hf_dataset", "loader": "datasets_server", "path": str(tmp_path / "env"), "label_allow": [1],
         "max_rows": 2, "source_id": "env"},
        {"type": "api", "api_kind": "csv_http_concat", "paths": list(csvs), "max_rows": 5},
        {"type": "api", "path": str(tmp_path / "pages"), "records_path": "d.r", "params": {"page_size": 2}},
        {"type": "scrape", "path": str(tmp_path / "html"), "selector": "h1"}]
    out = str(tmp_path / "out")
    df = collect.collect(spark, specs, "2024-01-01T00:00:00Z", out)
    counts = {r.value: r.n for r in collect.summary(df).where("section = 'source'").collect()}
    assert counts == {"hf:n": 3, "env": 2, "api:csv-concat": 5, "api:json": 3, "scrape:h.example": 1}
    assert landed.read_csv(spark, out).count() == 14


def test_bad_specs():
    for spec in ({"type": "ftp"}, {"type": "api", "api_kind": "xml", "path": "p"}, {"type": "hf_dataset"}):
        with pytest.raises(ValueError):
            collect.kind_of(spec)


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<double>")
    assert spark.read.parquet(sinks.export(df, str(tmp_path / "p"), "parquet")).count() == 1
    row = spark.read.option("header", True).option("escape", '"').csv(sinks.export(df, str(tmp_path / "c"))).head()
    assert row.v == "[1.0,2.0]"
    with pytest.raises(ValueError):
        sinks.export(df, str(tmp_path / "x"), "xml")


def test_left_out_end_tags():
    page = "<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td><p>3</table><p><b>x<p>y"
    assert html.select_text(page, html.parse_selector("li")) == ["a", "b\nc", "c", "d"]
    assert html.select_text(page, html.parse_selector("td")) == ["1", "2", "3"]
    assert html.select_text(page, html.parse_selector("p")) == ["3", "x", "y"]


def test_pages_are_parsed_a_hundred_at_a_time(spark):
    df = spark.createDataFrame([(1, "http://x.example/", PAGE)], "page_id int, url string, html string")
    for found in (html.scrape(df, "p", "at"), html.extract_elements(df, "p")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "MapInPandas" not in plan


def test_landed_files_are_bounded(spark, tmp_path):
    """A value with most rows is many files, whose paths follow the order, repeated keys and nulls included."""
    from corpusmill.plans.queries_roundtrip import _by_folder
    rows = [(i, "a" if i < 95 else "b", "x\ny") for i in range(100)] + [(7, "a", "again"), (3, None, "none")]
    df = spark.createDataFrame(rows, "k long, lang string, text string").repartition(3)
    folder = _by_folder(df, "lang", "k", str(tmp_path / "out"), 10)
    files = sorted(p for p in (tmp_path / "out").rglob("*.csv"))
    assert len([p for p in files if "lang=a" in str(p)]) == 10 and len(files) == 12
    found = landed.read_csv_in_order(spark, [folder], recursiveFileLookup=True)
    found = [(r.k, r.text) for r in found.orderBy(*landed.FILE_ORDER).collect()]
    assert [int(k) for k, _ in found] == [3, *sorted([*range(95), 7]), *range(95, 100)]
    first = landed.first_csv_below(spark, str(tmp_path / "out" / "lang=a"), 8, recursiveFileLookup=True).collect()
    assert [int(r.k) for r in first] == [0, 1, 2, 3, 4, 5, 6, 7]
