import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.relational import conform
from hearthline.sources import readers, sinks
from hearthline.streaming import incremental


def rows_of(resource, offset, limit, columns):
    for i in range(offset, min(offset + limit, 25)):
        yield tuple({"id": i, "name": f"{resource}{i}"}[c] for c in columns)


def test_csv_gzip_latin1_and_bad_lines(spark, tmp_path):
    schema = "a int, b string"
    (tmp_path / "x.csv").write_text('a,b\n1,"line\nbreak"\n2,\n')
    got = readers.read_csv(spark, str(tmp_path / "x.csv"), T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])).orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(1, "line\nbreak"), (2, None)]
    with gzip.open(tmp_path / "y.csv.gz", "wt") as f:
        f.write("a,b\n7,q\n")
    assert readers.read_csv(spark, str(tmp_path / "y.csv.gz"), spark.createDataFrame([], schema).schema, columns=["b"]).collect()[0].b == "q"
    (tmp_path / "z.csv").write_bytes("a,b\n1,caf\xe9\nx,bad\n".encode("latin1"))
    got = readers.read_csv(spark, str(tmp_path / "z.csv"), spark.createDataFrame([], schema).schema, encoding="ISO-8859-1", tolerant=True).collect()
    assert [(r.a, r.b) for r in got] == [(1, "café")]


def test_documents_and_polygons(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.html").write_text("<p>one</p><script>no</script>")
    (d / "b.html").write_bytes(b"%PDF-1.4 ...")
    (d / "c.txt").write_text("plain")
    got = {r.file: (r.kind, r.text) for r in readers.read_documents(spark, str(d)).collect()}
    assert got == {"a.html": ("html", "one"), "b.html": ("pdf", None), "c.txt": ("text", "plain")}
    geo = {"features": [{"geometry": {"type": "Polygon", "coordinates": [[[1.0, 2.0], [3.0, 4.0]]]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[[[5.0, 6.0]]]]}}]}
    (tmp_path / "g.json").write_text(json.dumps(geo))
    assert sorted((r.feature, r.lon, r.lat) for r in readers.read_polygons(spark, str(tmp_path / "g.json")).collect()) == [(0, 1.0, 2.0), (0, 3.0, 4.0), (1, 5.0, 6.0)]


def test_crawl_tables(spark):
    anchors = spark.createDataFrame([("http://h/x_min.pdf", "a", ""), ("http://h/x_min.pdf", "b", ""), ("http://h/other", "nothing", ""), ("http://h/q", "Draft minutes", "")], "url string, label string, row_text string")
    links = readers.page_links(anchors)
    assert {r.url: r.kind for r in links.collect()} == {"http://h/x_min.pdf": "pdf", "http://h/q": "html"}
    manifest = spark.createDataFrame([("http://h/q", "ok"), ("http://h/x_min.pdf", "error 500")], "url string, status string")
    assert [r.url for r in readers.not_fetched(links, manifest).collect()] == ["http://h/x_min.pdf"]
    two = readers.merged_by_source(links.withColumn("s", F.lit(1)), links.withColumn("s", F.lit(2)).unionByName(spark.createDataFrame([("http://new", "l", "", "html", 2)], "url string, label string, row_text string, kind string, s int")))
    assert {r.url: r.s for r in two.collect()} == {"http://h/x_min.pdf": 1, "http://h/q": 1, "http://new": 2}
    pages = spark.createDataFrame([("u", "mail jo.doe@plan.example or x.y@z")], "url string, html string")
    assert [(r.name, r.email) for r in readers.emails_in_page(pages).collect()] == [("Jo Doe", "jo.doe@plan.example")]


def test_paged_source(spark):
    spark.dataSource.register(readers.PagedSource)
    df = spark.read.format("paged").schema("id int, name string").option("fetch", "tests.test_sources:rows_of").option("resource", "r").option("rows", "25").option("page", "10").load()
    assert df.rdd.getNumPartitions() == 3 and df.count() == 25 and df.where("id = 24").first().name == "r24"
    reader = spark.read.format("paged").schema("id int, name string").option("fetch", "tests.test_sources:rows_of").option("page", "4")
    for lanes in ("1", "2", "9"):  # without a row count, pages are read until one is short
        assert sorted(r.id for r in reader.option("lanes", lanes).load().collect()) == list(range(25))


def test_conform_and_release(spark, tmp_path):
    df = spark.createDataFrame([("1", "x")], "a string, extra string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    assert conform(df, schema).schema == schema and conform(df, schema).first()["a"] == 1
    sinks.write_release(df, str(tmp_path / "rel"), ["extra", "missing", "a"], gzip=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "rel")).columns == ["extra", "a"]
    sinks.write_stage(df, str(tmp_path / "stage"))
    sinks.write_json(sinks.search_index(df, "a", "extra", "extra", "k"), str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 1


def test_stream_counts_messages_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-02 00:00:00"), ("b", "2024-01-01 00:00:00")], "id string, at string").select("id", F.to_timestamp("at").alias("loaded_at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = incremental.new_files(spark, str(tmp_path / "in"), df.schema)
    incremental.run_available(incremental.messages_once(stream, ["id"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_people_of_pages_and_crawl_plans(spark):
    html = "<table><tr><td>Ann Lee</td><td><a>ann.lee@x.example</a></td><td>Planner &amp; clerk</td></tr><tr><td>total</td><td>5</td></tr><tr><td>Bob Q. Ray</td><td></td></tr></table> mail ann.lee&#64;x.example or planning.desk@x.example"
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    assert {(r.name, r.email) for r in readers.emails_in_page(pages).collect()} == {("Ann Lee", "ann.lee@x.example")}
    assert {(r.name, r.email, r.title) for r in readers.people_in_tables(pages).collect()} == {("Ann Lee", "ann.lee@x.example", "Planner &amp; clerk"), ("Bob Q. Ray", None, None)}
    anchors = spark.createDataFrame([("p1", "a", "May 3"), ("p1", "b", "About"), ("p2", "c", "June 1")], "page string, url string, label string")
    assert [r.url for r in readers.second_level(spark.createDataFrame([("p1",)], "url string"), anchors).collect()] == ["a"]
    m = spark.createDataFrame([("http://a.x/1", "error 503"), ("http://b.x/2", "ok")], "url string, status string")
    assert [(r.url, r.retry_url) for r in readers.to_retry(m, {"a.x": "m.x"}).collect()] == [("http://a.x/1", "http://m.x/1")]
    assert spark.range(1).select(readers.mirrored("http://m/", F.lit("a?b=c"))).first()[0] == "http://m/a?b%3Dc"
    snaps = spark.createDataFrame([("2020-01-01", "s", "n", 1), ("2020-01-01", "s", "n", 1)], "snapshot string, source string, name string, k int")
    assert readers.snapshots_once(snaps).count() == 1
