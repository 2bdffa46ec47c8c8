"""Writers: stage CSV, versioned state, spreadsheets, Markdown documents, quarantine, read-back."""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterable, Sequence
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.relational import GateError
from gaugeworks.sources import state


def stage_csv(df: DataFrame, path: str) -> None:
    """Header CSV; arrays are joined by '; '."""
    flat = df.select(*[F.array_join(F.col(f"`{n}`").cast("array<string>"), "; ").alias(n) if k.startswith("array") else F.col(f"`{n}`") for n, k in df.dtypes])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_back(df: DataFrame, spark: SparkSession, path: str) -> int:
    """Rows of what was written; raises if they aren't those of the frame."""
    n, want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count(), df.count()
    if n != want:
        raise GateError(f"{path}: wrote {want} rows, read {n}")
    return n


def write_version(df: DataFrame, base: str, read_version: int | None = None) -> int:
    """A new version of a state table beside the old ones, as a plan may still read those; returns its number.  See `state.replace`."""
    return state.replace(df, base, read_version)


def has_version(spark: SparkSession, base: str) -> bool:
    """Whether a version was written."""
    return state.latest(spark, base) is not None


def read_version(spark: SparkSession, base: str) -> DataFrame:
    return state.read(spark, base)


def json_lines(df: DataFrame, path: str, each: bool = False) -> None:
    """JSON, a document in a line; with `each`, a document in a file."""
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", 1) if each else writer).json(path)


def quarantine(df: DataFrame, ok: F.Column, path: str) -> DataFrame:
    """Writes the rows that aren't ok and returns the others."""
    df.where(~F.coalesce(ok, F.lit(False))).write.mode("append").parquet(path)
    return df.where(ok)


def column_widths(df: DataFrame, most: int = 60) -> list[int]:
    """min(longest text + 2, most) of each column, header included: one aggregate."""
    r = df.agg(*[F.max(F.char_length(F.col(f"`{c}`").cast("string"))).alias(f"w{i}") for i, c in enumerate(df.columns)]).first()
    return [min(max(r[i] or 0, len(c)) + 2, most) for i, c in enumerate(df.columns)]


def _letter(i: int) -> str:
    out = ""
    while i >= 0:
        i, k = divmod(i, 26)
        out, i = chr(65 + k) + out, i - 1
    return out


def workbook(df: DataFrame, sheet: str = "worklist", most_rows: int = 100_000) -> bytes:
    """A spreadsheet: one sheet, first row frozen, widths by content.  For reports of bounded size; more rows are an error."""
    rows = df.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise GateError(f"a worksheet takes {most_rows} rows at most")
    return sheet_bytes(df.columns, map(tuple, rows), column_widths(df), sheet)


def workbooks(df: DataFrame, key: str, per_book: int = 20_000, sheet: str = "worklist") -> DataFrame:
    """(book, content): spreadsheets of about `per_book` rows each, by ranges of a key and in its order, made on the executors.

    All books have the same columns and widths; `book` counts from 0.  No rows pass the driver.
    """
    n, names, widths = df.count(), df.columns, column_widths(df)
    dealt = df.repartitionByRange(max(1, -(-n // per_book)), key).sortWithinPartitions(key)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        rows = (tuple(r.values()) for batch in batches for r in batch.to_pylist())
        first = next(rows, None)
        if first is not None:
            content = sheet_bytes(names, itertools.chain([first], rows), widths, sheet)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([content], pa.binary())], ["book", "content"])

    return dealt.mapInArrow(run, "book int, content binary")


def sheet_bytes(columns: Sequence[str], rows: Iterable[tuple], widths: Sequence[int], sheet: str) -> bytes:
    """The bytes of a spreadsheet of one sheet."""

    def cell(i: int, k: int, v) -> str:
        at = f"{_letter(i)}{k}"
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{at}"><v>{v!r}</v></c>'
        text = "; ".join(map(str, v)) if isinstance(v, list) else str(v)
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    body = [f'<row r="{k}">' + "".join(cell(i, k, v) for i, v in enumerate(r)) + "</row>" for k, r in enumerate(itertools.chain([columns], rows), 1)]
    cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
    ns = "http://schemas.openxmlformats.org"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{ns}/spreadsheetml/2006/main" xmlns:r="{ns}/officeDocument/2006/relationships"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet xmlns="{ns}/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>{"".join(body)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


#: Fixed value: colour of a target above the score of now, which stands in bold.
RAISED_COLOUR = "1E7B34"


def _raised(table: list[list[str]], now: str = "now", target: str = "target") -> set[tuple[int, int]]:
    """(row, column) of cells under `target` whose leading number is above that under `now`; none in a table without both."""
    head = [x.lower() for x in table[0]]
    if now not in head or target not in head:
        return set()
    a, b = head.index(now), head.index(target)
    number = lambda r, i: re.match(r"\d+", r[i]) if i < len(r) else None
    pairs = ((i, number(r, a), number(r, b)) for i, r in enumerate(table[1:], 1))
    return {(i, b) for i, x, y in pairs if x and y and int(y[0]) > int(x[0])}


def document(markdown: str) -> bytes:
    """A word-processing document of a Markdown text: headings, bullets, paragraphs, and tables with a shaded head row, targets above the score of now in bold and colour."""
    ns = "http://schemas.openxmlformats.org"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    paragraphs: list[str] = []
    table: list[list[str]] = []

    def close_table() -> None:
        if table:
            edges = "".join(f'<w:{e} w:val="single" w:sz="4" w:color="999999"/>' for e in ("top", "left", "bottom", "right", "insideH", "insideV"))
            shade = '<w:tcPr><w:shd w:val="clear" w:fill="E7E6E6"/></w:tcPr>'
            raised = _raised(table)
            bold = lambda up: "<w:rPr><w:b/>" + (f'<w:color w:val="{RAISED_COLOUR}"/>' if up else "") + "</w:rPr>"
            cell = lambda text, head, up: f'<w:tc>{shade if head else ""}<w:p><w:r>{bold(up) if head or up else ""}<w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p></w:tc>'
            rows = "".join("<w:tr>" + "".join(cell(x, not i, (i, j) in raised) for j, x in enumerate(r)) + "</w:tr>" for i, r in enumerate(table))
            paragraphs.append(f"<w:tbl><w:tblPr><w:tblBorders>{edges}</w:tblBorders></w:tblPr>{rows}</w:tbl><w:p/>")
            table.clear()

    for line in markdown.split("\n"):
        if line.startswith("|") and line.rstrip().endswith("|"):
            cells = [x.strip() for x in line.strip().strip("|").split("|")]
            if not all(set(x) <= set("-: ") and x for x in cells):
                table.append(cells)
            continue
        close_table()
        level = len(line) - len(line.lstrip("#"))
        style = f"Heading{level}" if 0 < level <= 6 and line[level : level + 1] == " " else "ListBullet" if line.startswith("- ") else ""
        text = line[level + 1 :] if style.startswith("H") else line[2:] if style else line
        props = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
        paragraphs.append(f'<w:p>{props}<w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>')
    close_table()
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>',
        "word/document.xml": f'{head}<w:document xmlns:w="{ns}/wordprocessingml/2006/main"><w:body>{"".join(paragraphs)}</w:body></w:document>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def documents(df: DataFrame, name: str, markdown: str) -> DataFrame:
    """(file, content): a document for each row, made on the executors."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"file": pdf["file"] + ".docx", "content": [document(x) for x in pdf["markdown"]]})

    return df.select(F.col(name).alias("file"), F.col(markdown).alias("markdown")).mapInPandas(run, "file string, content binary")


def layout_report(templates: DataFrame, steps: DataFrame, differences: DataFrame, category: str = "category") -> DataFrame:
    """(category, markdown): each template's size, steps, groups and difference from the first."""
    lines = steps.groupBy("template").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "line"))), lambda x: x.line), "\n").alias("_lines"))
    total = templates.groupBy(category).agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_templates"))
    rows = templates.join(lines, "template").join(differences, "template", "left").join(total, category)
    diff = F.when(F.col("difference").isNotNull(), F.concat(F.lit("Differs from T-"), F.col(category), F.lit("-1: "), F.col("difference"), F.lit("\n")))
    part = F.concat_ws("\n", F.concat(F.lit("### "), "template", F.lit(": "), "n", F.lit(" of "), "_all", F.lit(" groups\n")), F.col("_lines"), F.concat(F.lit("\nGroups: "), F.array_join("members", ", "), F.lit("\n")), diff)
    whole = rows.groupBy(category, "_all", "_templates").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", part.alias("t")))), lambda x: x.t), "\n").alias("_body"))
    title = F.concat(F.lit("## "), F.col(category), F.lit(" ("), "_all", F.lit(" groups, "), "_templates", F.when(F.col("_templates") == 1, " template)").otherwise(" templates)"))
    return whole.select(category, F.concat(title, F.lit("\n\n"), "_body").alias("markdown"))


def console(df: DataFrame, columns: Sequence[str], n: int = 50) -> str:
    """The first rows of a report as text lines."""
    return "\n".join(["\t".join(columns), *("\t".join("" if v is None else str(v) for v in r) for r in df.select(*columns).limit(n).collect())])
