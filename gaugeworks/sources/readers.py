"""Readers: header CSV, cached HTML, JSON documents, text trees, spec tables, deny lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import netloc
from gaugeworks.operators.relational import GateError
from gaugeworks.session import materialise

BANK = "slug string, url string, category string"
INVENTORY = "`Original Url` string, Slug string, `Title 1` string, `Meta Description 1` string, `Meta Keywords 1` string, `H1-1` string, `H2-1` string, `H2-2` string, `Unique Inlinks` long"
GSC = "`Top pages` string, Clicks long, Impressions long, CTR string, Position double"
FOCUS = "`Doc No` string, slug string, focus_keyword string, focus_intent string, refocus string, focus_prompt string, fan_out_1 string, fan_out_2 string, fan_out_3 string, fan_out_4 string, connected_entities string, notes string"
SKUS = "ProductName string, ProductCategory string, CentralCategory string, SKU string, URL string, Details string"
INDEX = "variant_group string, product_name string, sku string, url string, category string, current_screenshot string, sections_json string, layout_template string, cosmo_score string, priority string, edit_docx string, after_image string, status string"
SECTIONS = (
    "variant_group string, url string, variant_urls array<string>, http_status int, captured date, title string, meta_description string, h1 string, canonical string, "
    "jsonld_types array<string>, microdata_types array<string>, related_products array<string>, excluded_sections struct<related_product_cards:long,reviews:long>, "
    "sections array<struct<index:int,heading:string,level:string,visible:boolean,y_top:double,y_bottom:double,text:string,screenshot:string>>"
)


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Header CSV by an explicit schema, columns by name; without one, all strings.  Empty cells are null, a byte order mark is skipped."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
    if schema is None:
        return reader.csv(path)
    names = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    raw = reader.csv(path)
    missing = [n for n in names if n not in raw.columns]
    if missing:
        raise GateError(f"missing columns: {missing}")
    return raw.select(*[F.col(f"`{n}`").try_cast(k).alias(n) for n, k in names.items()])


def numbered_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string rows with `row_no`, their order in the file; one split for each file keeps it."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumn("row_no", F.monotonically_increasing_id())


def html_cache(spark: SparkSession, folder: str) -> DataFrame:
    """(slug, html) of cached pages, one file each; the slug is the file's stem."""
    df = spark.read.text(f"{folder}/*.html", wholetext=True)
    return df.select(F.regexp_extract("_metadata.file_name", r"^(.*)\.html$", 1).alias("slug"), F.col("value").alias("html"))


def with_pages(posts: DataFrame, cache: DataFrame, key: str = "slug", on_missing: str = "null") -> DataFrame:
    """Left join of cached pages; `fail` stops at a page that isn't cached, `null` leaves it null."""
    out = posts.join(cache.select(key, "html"), key, "left")
    if on_missing == "fail":
        lost = [r[key] for r in out.where("html is null").select(key).orderBy(key).limit(20).collect()]
        if lost:
            raise GateError(f"not in the cache: {lost}")
    return out


def fetch_missing(posts: DataFrame, cache: DataFrame, fetch: Callable[[str], str | None] | None, attempts: int = 2, pause: float = 2.0, pacing: float = 1.5, key: str = "slug", write_to: str | None = None) -> DataFrame:
    """(slug, html) of pages that the cache lacks, by an injected fetch function.

    Pages are dealt out by host, so that the pacing holds for each site and sites go side by side.  Without a function
    nothing is fetched (offline).  A page that fails all attempts is null.  With `write_to`, pages that
    came are added to a cache table there before they are returned: see `cached_pages`.
    """
    todo = posts.join(cache.select(key), key, "left_anti").select(key, "url")
    if fetch is None:
        return todo.select(key, F.lit(None).cast("string").alias("html"))

    def run(batches):
        import time

        import pandas as pd

        due: dict[str, float] = {}
        for pdf in batches:
            out = []
            for url, host in zip(pdf["url"], pdf["_host"]):
                time.sleep(max(0.0, due.get(host, 0.0) - time.monotonic()))
                page = None
                for k in range(attempts):
                    try:
                        page = fetch(url)
                        break
                    except OSError:
                        if k + 1 < attempts:
                            time.sleep(pause)
                due[host] = time.monotonic() + pacing
                out.append(page)
            yield pd.DataFrame({key: pdf[key], "html": out})

    hosts = todo.withColumn("_host", F.coalesce(netloc(F.col("url")), F.lit("")))
    got = hosts.repartition(int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_host").mapInPandas(run, f"{key} string, html string")
    if write_to is None:
        return got
    got = materialise(got)
    got.where("html is not null").write.mode("append").parquet(write_to)
    return got


def cached_pages(spark: SparkSession, path: str, key: str = "slug") -> DataFrame:
    """(slug, html) of a cache table that fetches were added to; any one where a page came twice."""
    return spark.read.schema(f"{key} string, html string").parquet(path).dropDuplicates([key])


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document for each file: its columns, `file` (the stem), `raw` (the text) and `parsed`."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("file"), "value")
    return parse_json(raw.withColumnRenamed("value", "raw"), "raw", schema)


def parse_json(df: DataFrame, text: str, schema: str) -> DataFrame:
    """Adds `parsed` and the columns of a schema, read from JSON texts; a text that isn't JSON has nulls."""
    read = df.withColumn("_j", F.from_json(text, T.StructType.fromDDL(schema), {"mode": "PERMISSIVE"})).withColumn("parsed", F.try_parse_json(text).isNotNull())
    return read.select(*df.columns, "parsed", "_j.*")


def workbook_rows(books: DataFrame) -> DataFrame:
    """Rows of the first sheet of each spreadsheet (binary `content`) as maps from its header to text, with `row_no` (from 1); empty cells are left out."""

    def run(batches):
        import io
        import zipfile
        from xml.etree import ElementTree

        import pandas as pd

        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = z.namelist()
                    shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in s.iter(f"{ns}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
                    sheet = ElementTree.fromstring(z.read(min(n for n in names if n.startswith("xl/worksheets/sheet"))))
                rows = []
                for row in sheet.iter(f"{ns}row"):
                    cells = {}
                    for cell in row:
                        kind, value = cell.get("t"), cell.find(f"{ns}v")
                        text = "".join(t.text or "" for t in cell.iter(f"{ns}t")) if kind == "inlineStr" else None if value is None else value.text
                        if text is not None:
                            cells[cell.get("r").rstrip("0123456789")] = shared[int(text)] if kind == "s" else ("false", "true")[int(text)] if kind == "b" else text
                    rows.append(cells)
                head = rows[0] if rows else {}
                yield pd.DataFrame({"row_no": range(1, len(rows)), "cells": [{head[k]: v for k, v in x.items() if k in head} for x in rows[1:]]})

    return books.select("content").mapInPandas(run, "row_no long, cells map<string,string>")


def workbook(books: DataFrame, schema: str) -> DataFrame:
    """Spreadsheets' columns by name and type; what can't be cast is null.  Sheets with none of the columns are an error.

    `books` has their bytes in `content`, as `spark.read.format("binaryFile")` gives them.
    """
    rows = workbook_rows(books)
    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    seen = {r.k for r in rows.select(F.explode(F.map_keys("cells")).alias("k")).distinct().collect()}
    if rows.head(1) and not seen & set(kinds):
        raise GateError(f"none of the columns {sorted(kinds)}")
    return rows.select("row_no", *[F.try_element_at("cells", F.lit(n)).try_cast(k).alias(n) for n, k in kinds.items()])


def text_tree(spark: SparkSession, folder: str, skip: Sequence[str] = (".git", "node_modules", "__pycache__")) -> DataFrame:
    """(path, text) of all files below a folder, without those in skipped folders."""
    df = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    for s in skip:
        df = df.where(~F.contains("path", F.lit(f"/{s}/")))
    return df


def deny_terms(spark: SparkSession, path: str) -> list[str]:
    """All terms of a deny list; an empty list is an error, as nothing could be certified by it."""
    df = spark.read.text(path).select(F.btrim("value").alias("term")).where("term <> '' and not startswith(term, '#')")
    terms = [r.term for r in df.distinct().orderBy("term").collect()]
    if not terms:
        raise GateError("the deny list is empty")
    return terms


def deny_list(spark: SparkSession, path: str) -> DataFrame:
    """The distinct terms of a deny list as a frame `term`, however many; an empty list is an error, as nothing could be certified by it."""
    terms = spark.read.text(path).select(F.btrim("value").alias("term")).where("term <> '' and not startswith(term, '#')").distinct()
    if terms.isEmpty():
        raise GateError("the deny list is empty")
    return terms


def labelled_text(spark: SparkSession, paths: Sequence[str]) -> str:
    """Files' texts one after another, each under its name: a prompt's spec data."""
    parts = []
    for p in paths:
        r = spark.read.text(p, wholetext=True).select(F.col("_metadata.file_name").alias("n"), "value").first()
        parts.append(f"### {r.n}\n{r.value}")
    return "\n\n".join(parts)
