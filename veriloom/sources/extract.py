"""From fetched bytes to filtered text: which extractor, filters and slice a recipe's source names, applied to each row."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.sources import files, html

# What parts the headers of a word processor file from its body.
HEADER_MARK = "=== section header text of this source, distinct blocks in document order ==="
BODY_MARK = "=== body of this source ==="
# End of fixed values.


def _structured(extractor: Column, scope: Column, content: Column, text: Column, icon_space: Column, sr_only: Column) -> Column:
    """Texts that need a parser: by structure of a page, at JSON paths, of word processor files; others are null. One Arrow batch at a time."""

    def paths(scope: str) -> list[str]:
        return json.loads(scope) if scope.startswith("[") else [scope]

    def at(doc, path: str) -> str:
        for step in path.replace("[", ".").replace("]", "").split("."):
            doc = doc[int(step)] if isinstance(doc, list) else doc[step]
        if doc is None:
            raise ValueError(f"nothing at {path}")
        return doc if isinstance(doc, str) else "\n".join(html.json_lines(doc))

    def one(kind, scope, blob, text, icons, sr) -> str | None:
        if kind == "html-text":
            return html.page_text(text, scope, bool(icons), bool(sr))
        if kind == "json-doc":
            return "\n\n".join(at(json.loads(text), p) for p in paths(scope))
        if kind == "next-data":
            data = html.text_of(html.parse(text), "#__NEXT_DATA__")
            if data is None:
                raise ValueError("the page has no data island")
            return "\n\n".join(at(json.loads(data), p) for p in paths(scope))
        if kind == "docx":
            body = html.docx(blob, "tables" in (scope or "tables"))
            head = html.docx_headers(blob) if (scope or "").startswith("headers") else ""
            return f"{HEADER_MARK}\n{head}\n{BODY_MARK}\n{body}" if head else body
        return None

    @F.pandas_udf("string")
    def run(kind: pd.Series, scope: pd.Series, blob: pd.Series, text: pd.Series, icons: pd.Series, sr: pd.Series) -> pd.Series:
        return pd.Series([one(*r) for r in zip(kind, scope, blob, text, icons, sr, strict=True)], dtype="object")

    return run(extractor, scope, content, text, icon_space, sr_only)


def extract(fetched: DataFrame, content: str = "content") -> DataFrame:
    """fetched(..., s struct of a recipe's source, content binary) with body: extracted, then sliced, then filtered.

    Bytes that don't decode fail the query if they are left in the body. PDF files need pdf_text(), whose program may be absent, and are
    passed through here as text that was extracted before. Slices are cut by anchors taken from each row; lists of filters are few, so that each
    that occurs becomes one branch of an expression. A source without an extractor's text has a null body.
    """
    s = F.col("s")
    plain, western = files.decode(F.col(content)), files.decode(F.col(content), "cp1252")
    decoded = F.when(s["encoding"] == "cp1252", western).otherwise(plain)
    d = fetched.withColumn("__d", decoded)
    body = _structured(s["extractor"], s["scope"], F.col(content), F.col("__d.text"), s["drop_icon_space"], s["drop_sr_only"])
    d = d.withColumn("__b", F.coalesce(body, F.col("__d.text")))
    binary = F.when(s["extractor"] == "docx", F.col("__b")).otherwise(files.refuse_lossy(F.col("__d"), F.col("__b")))
    d = d.withColumn("__b", binary)
    once = lambda f: F.coalesce(s["slice"][f], F.lit(1))
    sliced = T.slice_of(F.col("__b"), s["slice"]["from"], s["slice"]["to"], once("from_occurrence"), once("to_occurrence"))
    d = d.withColumn("__b", F.when(s["slice"].isNull(), F.col("__b")).otherwise(sliced))
    out = F.when(F.coalesce(F.size(s["filters"]), F.lit(0)) < 1, T.form_feed_to_line(F.col("__b")))
    for (names,) in d.select(s["filters"]).distinct().collect():
        if names:
            out = out.when(s["filters"] == F.array(*[F.lit(n) for n in names]), T.apply_filters("__b", names))
    return d.select(*fetched.columns, out.alias("body"))
