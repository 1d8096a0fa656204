"""Writers: delimited text, summaries, JSON documents, spreadsheets, reports; and the check of what was written."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.operators.entities import labelled

BOM = "﻿"
REQUIRED = ("Hindi Name", "English Name", "Page Number")


def write_csv(df: DataFrame, path: str, *, delimiter: str = ",", encoding: str = "utf-8-sig", labels: bool = True, single: bool = True) -> None:
    """Minimal quoting, quotes doubled, blanks kept; with utf-8-sig the first header carries the mark."""
    out = labelled(df) if labels else df
    if encoding == "utf-8-sig" and out.columns:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    writer = (out.coalesce(1) if single else out).write.mode("overwrite")
    writer.options(header=True, sep=delimiter, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_csv(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Strings under their labels; a mark before the header is dropped."""
    df = spark.read.options(header=True, sep=delimiter, escape='"', multiLine=True).csv(path)
    return df.withColumnsRenamed({c: c.lstrip(BOM) for c in df.columns})


def validate_rows(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, whether it is valid, and the errors."""
    missing = [c for c in REQUIRED if c not in df.columns]
    there = "Hindi Name" in df.columns
    script = F.count_if(F.col("Hindi Name").rlike("[ऀ-ॿ]")) if there else F.lit(0)
    out = df.agg(F.count(F.lit(1)).alias("row_count"), script.cast("long").alias("devanagari_rows"))
    errors = F.concat_ws(
        "; ",
        F.lit(f"Missing columns: {', '.join(missing)}" if missing else None),
        F.when(F.col("row_count") == 0, "No data rows"),
        F.when((F.col("row_count") > 0) & F.lit(there) & (F.col("devanagari_rows") == 0), "No Devanagari text"),
    )
    return out.withColumn("column_count", F.lit(len(df.columns))).withColumn("errors", errors).withColumn("valid", F.col("errors") == "")


def json_documents(extracted: DataFrame, filename, at, *keys: str, page_col: str = "page_number") -> DataFrame:
    """(keys, document): a JSON text per group with its pages and entities in order."""
    page = F.struct(
        F.col(page_col).cast("int").alias("page_number"),
        F.col("processing_method"),
        F.length("text").alias("raw_text_length"),
        F.length("cleaned_text").alias("cleaned_text_length"),
        F.col("entities"),
    )
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    rows = extracted.select(*keys, F.coalesce(filename, F.lit("unknown")).alias("_f"), stamp.alias("_at"), page.alias("_p"))
    grouped = rows.groupBy(*keys, "_f", "_at").agg(F.sort_array(F.collect_list("_p")).alias("pages"))
    return grouped.select(*keys, F.to_json(F.struct(F.col("_f").alias("filename"), F.col("_at").alias("processing_timestamp"), "pages")).alias("document"))


def write_json(documents: DataFrame, path: str) -> None:
    documents.select(F.col("document").alias("value")).write.mode("overwrite").text(path)


def write_excel(sheets: dict[str, DataFrame], path: str, limit: int = 1_048_576) -> None:
    """A workbook made of plain cells; a sheet holds at most the format's own number of rows, more is an error.

    Rows are streamed from the executors a partition at a time.
    """
    kind = "http://schemas.openxmlformats.org"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i, _ in enumerate(names, 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{kind}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{kind}/package/2006/relationships"><Relationship Id="r1" Type="{kind}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{kind}/spreadsheetml/2006/main" xmlns:r="{kind}/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{kind}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(names, 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{kind}/package/2006/relationships">{links}</Relationships>')
        for i, name in enumerate(names, 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                cell = lambda v: f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) and not isinstance(v, bool) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>'
                line = lambda row: f"<row>{''.join(map(cell, row))}</row>".encode()
                f.write(f'<worksheet xmlns="{kind}/spreadsheetml/2006/main"><sheetData>'.encode() + line(sheets[name].columns))
                for n, row in enumerate(sheets[name].toLocalIterator(), 2):
                    if n > limit:
                        raise ValueError(f"sheet {name} has more than {limit} rows")
                    f.write(line(row))
                f.write(b"</sheetData></worksheet>")


def write_formats(rows: DataFrame, summary: DataFrame, documents: DataFrame, folder: str, name: str, formats: tuple[str, ...] = ("csv", "excel", "json")) -> dict[str, str]:
    """{format: path} of those that could be written; one that fails does not stop the others."""
    writers = {
        "csv": (f"{folder}/{name}.csv", lambda p: write_csv(rows, p)),
        "excel": (f"{folder}/{name}.xlsx", lambda p: write_excel({"Extracted Data": labelled(rows), "Summary": summary}, p)),
        "json": (f"{folder}/{name}.json", lambda p: write_json(documents, p)),
    }
    done = {}
    for kind in formats:
        path, write = writers[kind]
        try:
            write(path)
            done[kind] = path
        except OSError:
            continue
    return done


def export_records(ledger: DataFrame, path: str, status: str | None = None) -> None:
    (ledger.filter(F.col("processing_status") == status) if status else ledger).write.mode("overwrite").json(path)
