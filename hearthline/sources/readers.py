"""Sources: every reader takes a declared schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from hearthline.functions.text import html_text, normal_text, unescape

MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "kind", "label", "row_text", "file", "status")])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, encoding: str = "UTF-8", tolerant: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, quoted line breaks, '' as null; .gz is read as it is. ``tolerant`` drops malformed lines."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "DROPMALFORMED" if tolerant else "PERMISSIVE")
        .csv(path)
    )
    return df.select(*columns) if columns else df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, kind, text) of HTML and text files; PDFs, told by suffix or first bytes, have a null text: their layout is extracted elsewhere."""
    raw = spark.read.format("binaryFile").load(path)
    file = F.element_at(F.split("path", "/"), -1)
    pdf = F.lower(file).endswith(".pdf") | (F.substring("content", 1, 5) == F.lit(b"%PDF-"))
    kind = F.when(pdf, "pdf").when(F.lower(file).rlike(r"\.html?$"), "html").otherwise("text")
    source = F.decode("content", "UTF-8")
    return raw.select(file.alias("file"), kind.alias("kind"), F.when(pdf, F.lit(None).cast("string")).when(kind == "html", normal_text(html_text(source))).otherwise(normal_text(source)).alias("text"))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(feature, part, ring, lon, lat) of a GeoJSON file of polygons and multipolygons."""
    ring = "array<array<array<double>>>"
    raw = spark.read.option("multiLine", True).schema("features array<struct<geometry:struct<type:string,coordinates:string>>>").json(path)
    geo = raw.select(F.posexplode("features").alias("feature", "f")).select("feature", F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("c"))
    parts = F.when(F.col("type") == "Polygon", F.array(F.from_json("c", ring))).otherwise(F.from_json("c", f"array<{ring}>"))
    return geo.select("feature", F.posexplode(parts).alias("part", "p")).select("feature", "part", F.posexplode("p").alias("ring", "r")).select("feature", "part", "ring", F.explode("r").alias("xy")).select("feature", "part", "ring", F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat"))


def page_links(anchors: DataFrame) -> DataFrame:
    """Anchors (url, label, row_text) that lead to minutes, each url once, with its kind."""
    name = F.lower(F.element_at(F.split("url", "/"), -1))
    keep = name.contains("_min") | F.col("url").rlike(r"-minutes(-\d+)?/?$") | F.lower("label").contains("minutes")
    kind = F.when(F.lower("url").rlike(r"\.pdf$"), "pdf").otherwise("html")
    return anchors.where(keep).groupBy("url").agg(F.min("label").alias("label"), F.min("row_text").alias("row_text")).withColumn("kind", kind)


def not_fetched(wanted: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records whose url was not fetched well before: the incremental part of a crawl."""
    return wanted.join(manifest.where(~F.coalesce(F.col("status"), F.lit("error")).startswith("error")).select("url").distinct(), "url", "left_anti")


def merged_by_source(*sources: DataFrame) -> DataFrame:
    """Union of (url, ...) tables in which the first source that has a url wins."""
    tagged = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in ("url", "_src")]
    return out.groupBy("url").agg(F.min_by(F.struct(*rest), "_src").alias("_r")).select("url", "_r.*")


#: Local parts that name an office, not a person.
OFFICES = ["info", "contact", "planning", "commissions", "secretary", "webmaster", "records", "office", "desk", "help", "news", "media", "admin"]


def emails_in_page(pages: DataFrame, source: str = "html") -> DataFrame:
    """(url, name, email): people whose printed address is first.last@host; entities are written out, offices left out."""
    plain = F.lower(unescape(F.col(source)))
    found = pages.select("url", F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(r"([a-z][a-z'-]+\.[a-z][a-z'-]{2,}@[a-z0-9.-]+[a-z])"), 1))).alias("email"))
    parts = F.split(F.element_at(F.split("email", "@"), 1), r"\.")
    return found.where(~F.arrays_overlap(parts, F.array(*[F.lit(x) for x in OFFICES]))).select("url", F.initcap(F.array_join(parts, " ")).alias("name"), "email")


def people_in_tables(pages: DataFrame, source: str = "html") -> DataFrame:
    """(url, name, email, title) of table rows of two cells or more whose first cell is a name of two to four capitalised words."""
    rows = pages.select("url", F.explode(F.regexp_extract_all(source, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)).alias("_row"))
    cells = F.transform(F.regexp_extract_all("_row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " ")))
    rows = rows.select("url", cells.alias("c")).where(F.size("c") >= 2).select("url", "c", F.element_at("c", 1).alias("name"))
    email = F.try_element_at(F.filter("c", lambda c: c.rlike(r"^\S+@\S+\.\S+$")), F.lit(1))
    title = F.try_element_at(F.filter(F.slice("c", 2, 100), lambda c: (F.length(c) <= 60) & (c != "") & ~c.contains("@")), F.lit(1))
    tokens = F.split("name", " ")
    named = F.size(tokens).between(2, 4) & F.forall(tokens, lambda t: t.rlike(r"^\p{Lu}"))
    return rows.where(named).select("url", "name", email.alias("email"), title.alias("title"))


MONTH_LABEL = r"(?i)^(?:january|february|march|april|may|june|july|august|september|october|november|december)\b|^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}$"


def second_level(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(url, label) of the links on pages that an index leads to, where the label looks like a month or date: one self-join on the page."""
    return anchors.join(index.select(F.col("url").alias("page")).distinct(), "page", "left_semi").where(F.col("label").rlike(MONTH_LABEL)).groupBy("url").agg(F.min("label").alias("label"))


def mirrored(base: str, url: Column) -> Column:
    """Address of a page on a mirror."""
    return F.concat(F.lit(base), F.replace(url, F.lit("="), F.lit("%3D")))


def to_retry(manifest: DataFrame, hosts: dict[str, str]) -> DataFrame:
    """Rows of a manifest that failed, with ``retry_url`` on another host where one is known."""
    target = F.col("url")
    for old, new in hosts.items():
        target = F.replace(target, F.lit(f"://{old}"), F.lit(f"://{new}"))
    return manifest.where(F.col("status").startswith("error")).withColumn("retry_url", target)


def snapshot_dates(spans: DataFrame, first: str, last: str, months: int) -> DataFrame:
    """``spans`` with one row and date ``at`` for every so many months from first to last; empty spans give none."""
    known = spans.where(F.col(first) <= F.col(last))
    return known.withColumn("at", F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"), F.expr(f"INTERVAL {months} MONTH"))))


def snapshots_once(found: DataFrame) -> DataFrame:
    """Rows (snapshot, source, name, ...) once: several dates asked for may lead to one snapshot."""
    return found.dropDuplicates(["snapshot", "source", "name"])


class _Page(InputPartition):
    """Every ``step``-th page from ``offset`` on; with no step, that page only."""

    def __init__(self, offset: int, limit: int, step: int = 0):
        super().__init__(offset)
        self.offset, self.limit, self.step = offset, limit, step


class PagedSource(DataSource):
    """A paged table service as a Spark source: one partition per page, columns pruned at the service.

    Options: ``fetch`` ("module:function" called with (resource, offset, limit, columns), returning rows), ``resource``,
    ``page``, and ``rows`` if it is known how many there are; else ``lanes`` partitions read on by turns until a page is
    short. The network call itself is the deployment's.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("give a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        options = self.options

        class Reader(DataSourceReader):
            def partitions(self):
                page, lanes = int(options.get("page", "50000")), int(options.get("lanes", "4"))
                if "rows" in options:
                    return [_Page(at, page) for at in range(0, int(options["rows"]), page)]
                return [_Page(k * page, page, lanes * page) for k in range(lanes)]

            def read(self, partition):
                import importlib

                module, function = options["fetch"].split(":")
                fetch, at = getattr(importlib.import_module(module), function), partition.offset
                while True:
                    rows = list(fetch(options.get("resource", ""), at, partition.limit, [f.name for f in schema.fields]))
                    yield from rows
                    if not partition.step or len(rows) < partition.limit:
                        return
                    at += partition.step

        return Reader()
