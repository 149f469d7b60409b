"""Files to rows of their parts, as an Arrow table function over a table of files: a file is opened once and yields what is in it, errors as rows.

A file that can't be read is a row with an error, so that it loses no other; a part is a page of a PDF, a paragraph, table row or header of a word
processor document. What isn't asked for isn't taken out of the file.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("paragraph", "row", "header")
_SCHEMA = "kind string, page int, position int, text string, error string"
_TYPES = {"kind": pa.string(), "page": pa.int32(), "position": pa.int32(), "text": pa.string(), "error": pa.string()}
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _said(node) -> str:
    return "".join(t.text or "" for t in node.iter(_W + "t"))


def _table_rows(root) -> Iterator[str]:
    """A table's rows as cells between pipes, a cell's paragraphs as lines."""
    for table in root.iter(_W + "tbl"):
        for row in table.findall(_W + "tr"):
            yield " | ".join("\n".join(_said(p) for p in cell.findall(_W + "p")).strip() for cell in row.findall(_W + "tc"))


def docx_parts(blob: bytes, kinds: list[str]) -> Iterator[tuple[str, None, int, str]]:
    """(kind, page, position, text): body paragraphs, table rows, and each different header of a section, in order; word processor files have no pages."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
        if body is None:
            raise ValueError("a document without a body")
        if "paragraph" in kinds:
            yield from (("paragraph", None, i, _said(p)) for i, p in enumerate(body.findall(_W + "p")))
        if "row" in kinds:
            yield from (("row", None, i, x) for i, x in enumerate(_table_rows(body)))
        if "header" in kinds and "word/_rels/document.xml.rels" in z.namelist():
            names = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("word/_rels/document.xml.rels"))}
            seen: dict[str, None] = {}
            for section in body.iter(_W + "sectPr"):
                held = {h.get(_W + "type"): names.get(h.get(_REL)) for h in section.findall(_W + "headerReference")}
                for name in (held.get(k) for k in ("first", "default", "even")):
                    if name:
                        root = ET.fromstring(z.read("word/" + name))
                        seen.setdefault("\n".join([x for p in root.findall(_W + "p") if (x := _said(p)).strip()] + list(_table_rows(root))))
            yield from (("header", None, i, x) for i, x in enumerate(x for x in seen if x))


def pdf_parts(blob: bytes, layout: bool, first: int | None, last: int | None, seconds: int = 300) -> Iterator[tuple[str, int, int, str]]:
    """(page, number, 0, text) of a PDF's pages first to last, both included, by the pdftotext program, which ends each page with a form feed."""
    import shutil
    import subprocess

    if not shutil.which("pdftotext"):
        raise RuntimeError("pdftotext isn't installed on this executor")
    span = [x for flag, n in (("-f", first), ("-l", last)) if n for x in (flag, str(n))]
    made = subprocess.run(["pdftotext", "-layout" if layout else "-raw", *span, "-", "-"], input=blob, capture_output=True, timeout=seconds, check=True)
    for i, text in enumerate(made.stdout.decode("utf-8", "replace").split("\f")[:-1]):
        yield "page", i + (first or 1), 0, text


def _format(blob: bytes) -> str:
    return "pdf" if blob[:5] == b"%PDF-" else "docx" if blob[:2] == b"PK" else ""


def _of(blob: bytes | None, kinds: list[str], layout: bool, first: int | None, last: int | None) -> list[tuple]:
    """(kind, page, position, text, error) of a file's parts; whatever a broken file brings up is its own row."""
    try:
        kind = _format(blob or b"")
        if kind == "docx":
            return [(*x, None) for x in docx_parts(blob, kinds)]
        if kind == "pdf":
            return [(*x, None) for x in pdf_parts(blob, layout, first, last)]
        raise ValueError("neither a PDF nor a word processor document" if blob else "an empty file")
    except Exception as e:  # noqa: BLE001
        return [(None, None, None, None, f"{type(e).__name__}: {e}")]


def parts(files: DataFrame, content: str = "content", kinds: tuple[str, ...] = KINDS, layout: bool = True, first: int | None = None, last: int | None = None) -> DataFrame:
    """files' other columns with (kind, page, position, text, error) of each part.

    kinds: which parts of word processor files; first, last: which pages of PDFs, both included: what isn't asked for isn't taken out. A file that
    can't be read, an empty or null one among them, has one row with an error; one without parts of these kinds has none. The table function takes
    files' partitions as they are; columns of a part's names are not allowed beside them.
    """
    if unknown := set(kinds) - set(KINDS):
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    keep = [f for f in files.schema if f.name != content]
    asked = list(kinds)

    class Parts:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            names = [n for n in batch.schema.names if n != content]
            for i, blob in enumerate(batch.column(content).to_pylist()):
                rows = _of(blob, asked, layout, first, last)
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(_TYPES)
                same = pa.array([i] * len(rows), pa.int64())
                yield pa.table([*(batch.column(n).take(same) for n in names), *(pa.array(c, t) for c, t in zip(cols, _TYPES.values(), strict=True))], names=[*names, *_TYPES])

    made = F.arrow_udtf(Parts, returnType=", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), _SCHEMA]))
    return made(files.select(*[f"`{f.name}`" for f in keep], content).asTable())


def build_docx(paragraphs: list[str], rows: list[list[str]] | None = None, headers: list[str] | None = None) -> bytes:
    """A word processor file of paragraphs, one table and one header a section: what a test or a round trip reads back."""
    from xml.sax.saxutils import escape

    p = lambda x: f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>"
    w, r = _W[1:-1], _REL[1 : _REL.index("}")]
    table = "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>" if rows else ""
    heads = [f'<w:sectPr><w:headerReference w:type="default" r:id="h{i}"/></w:sectPr>' for i in range(len(headers or []))]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}" xmlns:r="{r}"><w:body>' + "".join(map(p, paragraphs)) + table + "".join(heads) + "</w:body></w:document>")
        if headers:
            z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="h{i}" Target="header{i}.xml"/>' for i in range(len(headers))) + "</Relationships>")
            for i, x in enumerate(headers):
                z.writestr(f"word/header{i}.xml", f'<w:hdr xmlns:w="{w}">{p(x)}</w:hdr>')
    return out.getvalue()
