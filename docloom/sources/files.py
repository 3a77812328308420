"""Files as tables: listing, dispatch by suffix, and text from TXT, DOCX and (through a pluggable extractor) PDF."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.arrow import appended
from docloom.functions.text import file_extension

#: Pages of a PDF: for each, its embedded text and, where that is blank, what character recognition reads.
PdfPages = Callable[[bytes], Iterable[tuple[str, str]]]
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def list_files(spark: SparkSession, path: str, suffix: str = ".pdf", any_case: bool = True) -> DataFrame:
    """path, file, length and content of the files with this suffix; Spark lists and reads them, wherever they are stored."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" if any_case and c.isalpha() else c for c in suffix)
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{letters}").option("recursiveFileLookup", "true").load(path)
    return found.withColumn("file", F.element_at(F.split("path", "/"), -1))


def docx_text(data: bytes) -> str:
    """Paragraphs of a DOCX file, joined by line feeds."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    paragraphs = []
    for p in root.iter(f"{_WORD}p"):
        runs = []
        for node in p.iter():
            if node.tag == f"{_WORD}t":
                runs.append(node.text or "")
            elif node.tag == f"{_WORD}tab":
                runs.append("\t")
            elif node.tag in (f"{_WORD}br", f"{_WORD}cr"):
                runs.append("\n")
        paragraphs.append("".join(runs))
    return "\n".join(paragraphs).strip()


def pdf_text(pages: Iterable[tuple[str, str]]) -> tuple[str, str | None]:
    """Each page's own text, or the recognised one where it is blank, a line feed after each; stripped. And the error that
    ended the reading, if one did: the pages before it are kept."""
    read, error = [], None
    try:
        read.extend((own if own.strip() else seen) + "\n" for own, seen in pages)
    except Exception as e:
        error = f"{type(e).__name__}: {e}"
    return "".join(read).strip(), error


def extract_texts(files: DataFrame, pdf_pages: PdfPages | None = None) -> DataFrame:
    """The files (`file`, `content`) with `text` and `error`. Suffixes count in any case; an extractor may yield its pages.

    A file that can't be read keeps what was read of it and tells the error; an unknown suffix, or PDF without an
    extractor, is an error of the row, never of the job.
    """
    names = files.columns
    f, c = names.index("file"), names.index("content")

    def one(name: str, data: bytes) -> tuple[str | None, str | None]:
        kind = name.lower().rpartition(".")[2] if "." in name else ""
        try:
            if kind == "txt":
                return data.decode("utf-8").strip(), None
            if kind == "docx":
                return docx_text(data), None
            if kind == "pdf" and pdf_pages:
                return pdf_text(pdf_pages(data))
        except Exception as e:
            return "", f"{type(e).__name__}: {e}"
        return None, f"unsupported file type: {name}"

    def run(batches):
        for batch in batches:
            out = [one(n.as_py() or "", d.as_py() or b"") for n, d in zip(batch.column(f), batch.column(c), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())], names=[*names, "text", "error"])

    return files.mapInArrow(run, appended(files, "text string, error string"))


def supported(name: Column) -> Column:
    return F.lower(file_extension(name)).isin(".txt", ".docx", ".pdf")


def is_pdf(content: Column) -> Column:
    """Whether the bytes begin as a PDF's do."""
    return F.startswith(content, F.lit(b"%PDF"))


def first_pdf(embedded: Column, own: Column) -> Column:
    """Of an array of embedded files the first PDF, which replaces the portfolio; else the file itself."""
    return F.coalesce(F.get(F.filter(embedded, is_pdf), F.lit(0)), own)
