"""Bytes to pages: pluggable extractors run per file in ``mapInPandas``.

An extractor is a function bytes -> iterable of page texts with a method name and
a confidence.  The first one that gives any text wins for the whole file.  The
plain-text one is always there; those of optional libraries are used if installed.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lipiflow.schemas import PAGE, PDF_METADATA


@dataclass(frozen=True)
class Extractor:
    method: str
    confidence: float
    pages: Callable[[bytes], Iterable[str]]
    needs: str | None = None
    metadata: Callable[[bytes], dict] = field(default=lambda content: {})

    def usable(self) -> bool:
        return self.needs is None or importlib.util.find_spec(self.needs) is not None


def _plain(content: bytes) -> list[str]:
    return content.decode("utf-8", "replace").split("\f")


def _plumber(content: bytes) -> Iterator[str]:
    import io

    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for page in pdf.pages:
            yield page.extract_text() or ""


def _mupdf(content: bytes) -> Iterator[str]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as pdf:
        for page in pdf:
            yield page.get_text()


def _pypdf(content: bytes) -> Iterator[str]:
    import io

    import PyPDF2

    for page in PyPDF2.PdfReader(io.BytesIO(content)).pages:
        yield page.extract_text() or ""


PLAIN = Extractor("direct_text", 0.95, _plain)
EXTRACTORS = (
    Extractor("direct_pdfplumber", 0.95, _plumber, "pdfplumber"),
    Extractor("direct_pymupdf", 0.9, _mupdf, "fitz"),
    Extractor("direct_pypdf2", 0.85, _pypdf, "PyPDF2"),
)


def extract_pages(files: DataFrame, extractors: tuple[Extractor, ...] = EXTRACTORS) -> DataFrame:
    """Page rows of ``files(file_id, content)``; an extractor that fails gives way to the next, a blank page has confidence 0."""
    usable = tuple(e for e in extractors if e.usable())

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for file_id, content in zip(pdf["file_id"], pdf["content"]):
                for e in usable:
                    try:
                        pages = list(e.pages(bytes(content)))
                    except Exception:  # the format is another extractor's
                        continue
                    if any(p.strip() for p in pages):
                        rows += [(file_id, i, p, e.confidence if p.strip() else 0.0, e.method, len(p.split()), None) for i, p in enumerate(pages, 1)]
                        break
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGE.split(", ")])

    return files.select("file_id", "content").mapInPandas(run, PAGE)


def ocr_pages(files: DataFrame, wanted: DataFrame, recognise: Callable[[bytes, int], tuple[str, float]]) -> DataFrame:
    """Recognised text of the wanted pages only: ``recognise(content, page number) -> (text, confidence)``.

    One page is in memory at a time; a page that fails becomes an empty one.
    """
    import pandas as pd
    from pyspark.sql import functions as F

    numbers = wanted.groupBy("file_id").agg(F.sort_array(F.collect_set("page_number")).alias("numbers"))
    rows = files.select("file_id", "content").join(numbers, "file_id")

    def run(batches):
        for pdf in batches:
            for file_id, content, pages in zip(pdf["file_id"], pdf["content"], pdf["numbers"]):
                out = []
                for n in pages:
                    try:
                        text, sure = recognise(bytes(content), int(n))
                    except Exception:  # the page stays empty
                        text, sure = "", 0.0
                    out.append((file_id, int(n), text, sure, "ocr_tesseract", len(text.split()), None))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in PAGE.split(", ")])

    return rows.mapInPandas(run, PAGE)


def pdf_metadata(files: DataFrame, extractors: tuple[Extractor, ...] = EXTRACTORS) -> DataFrame:
    """Metadata of ``files(filename, path, file_size, modified_time, content)``; what cannot be read is zero or null."""
    usable = tuple(e for e in extractors if e.usable())

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for f in pdf.itertuples():
                pages, more = 0, {}
                for e in usable:
                    try:
                        pages, more = len(list(e.pages(bytes(f.content)))), e.metadata(bytes(f.content))
                        break
                    except Exception:  # the format is another extractor's
                        continue
                rows.append((f.filename, f.path, pages, f.file_size, None, f.modified_time, more.get("author"), more.get("title"), more.get("subject")))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PDF_METADATA.split(", ")]).astype({"creation_date": "datetime64[ns]"})

    return files.select("filename", "path", "file_size", "modified_time", "content").mapInPandas(run, PDF_METADATA)


def first_table(rows: list[list[str | None]]) -> list[list[str]]:
    """Preview of a table: three rows, cells on one line, long ones cut to 50 characters and dots."""
    tidy = [[" ".join((c or "").split()) for c in row] for row in rows[:3]]
    return [[c if len(c) <= 50 else c[:50] + "..." for c in row] for row in tidy]
