"""Language identification by Bayesian evidence fusion.

The posterior of a language is proportional to a prior of the row's host times the likelihoods of
its text, of the language that its markup declares, and of its address suffix:

* text: byte trigrams under a smoothed multinomial per language, counted over all labelled texts; the sum is
  scaled to at most EVIDENCE trigrams, as neighbouring trigrams aren't independent;
* declared language and suffix: how often texts of each language declare it or have it, counted over
  all rows and smoothed;
* host prior: counts per host, smoothed towards the site's, the suffix's and then the corpus's shares.

All counts are grouped sums of the text posteriors (soft counts), so that a host with a third of all
rows is summed before it is shuffled.
"""

from __future__ import annotations

import html as html_
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions.text import let
from veriloom.llm import textkit
from veriloom.llm.shared import cut, join_spread

BITS = 15
EVIDENCE = 60.0
#: Languages that a model may have; each has 2**BITS counts.
MOST_LANGUAGES = 256
#: How much an address suffix counts by itself, beside the prior, on a host of which nothing else is known.
SUFFIX = 0.25
U = np.uint64


@dataclass
class Model:
    """languages in order; logp[language, trigram slot]; log shares of the labelled texts."""

    languages: list[str]
    logp: np.ndarray
    share: np.ndarray


def _trigrams(data: np.ndarray) -> np.ndarray:
    d = textkit._LOWER[data].astype(np.uint32)
    k = d[:-2] * np.uint32(65599 * 65599 & 0xFFFFFFFF) + d[1:-1] * np.uint32(65599) + d[2:]
    return ((k * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


def _inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which trigrams lie in one text."""
    ok = np.ones(max(0, n - 2), bool)
    for back in (1, 2):
        at = offsets[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from all rows with a text and a language. Only grouped counts, at most 2**BITS a language, reach the driver."""
    src = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.lower(F.col(lang_col).cast("string")).alias("lang"))

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_numpy(zero_copy_only=False)
            for row, n, offsets, data in textkit.slices(b.column(0)):
                if len(data) < 3:
                    continue
                k = _trigrams(data)
                names, code = np.unique(langs[row : row + n].astype(str), return_inverse=True)
                of = np.repeat(code, np.diff(offsets))[: len(k)]
                ok = _inside(offsets, len(data))
                c = np.bincount(of[ok] << BITS | k[ok], minlength=len(names) << BITS).reshape(len(names), -1)
                for i, name in enumerate(names):
                    held[name] = held[name] + c[i] if name in held else c[i]
                if len(held) > MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages")
        for name, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))], names=["lang", "slot", "n"])

    sums = src.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(languages), 1 << BITS))
    counts[sums["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), sums["slot"].to_numpy(int)] = sums["n"].to_numpy(float)
    logp = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * (1 << BITS))) if languages else counts
    share = (counts.sum(1) + 1) / (counts.sum() + max(1, len(languages)))
    return Model(languages, logp, np.log(share))


_RAW = re.compile(r"(?i)<(script|style)\b")
_RAW_ENDS = {k: re.compile(rf"(?i)</{k}\s*>") for k in ("script", "style")}
_ROOT = re.compile(r"(?i)<(?:html|body)\b")
_DECLARED = re.compile(r"""(?i)(?<![\w:.-])(?:xml:)?lang\s*=\s*["']?\s*([a-z]{2,3})\b""")


def visible(markup: str) -> str:
    """Text of a page without tags, scripts, styles and comments, each one blank.

    One scan forward: an end mark that was looked for and isn't there isn't looked for again, so that a page of nothing but open marks takes
    no longer than another. What has no end is text: an open comment or script is a tag if it has a ">", else its "<" stands for itself.
    """
    out: list[str] = []
    at, absent = 0, set()

    def end_of(mark: str, start: int) -> int:
        """The place after the next end mark, or -1."""
        if mark in absent:
            return -1
        m = _RAW_ENDS[mark].search(markup, start) if mark in _RAW_ENDS else None
        k = (m.end() if m else -1) if mark in _RAW_ENDS else markup.find(mark, start)
        if k < 0:
            absent.add(mark)
            return -1
        return k if m else k + len(mark)

    while (i := markup.find("<", at)) >= 0:
        out.append(markup[at:i])
        end = -1
        if markup.startswith("<!--", i):
            end = end_of("-->", i + 4)
        elif m := _RAW.match(markup, i):
            end = end_of(m[1].lower(), m.end())
        if end < 0:
            end = end_of(">", i + 1)
        out.append(" " if end >= 0 else "<")
        at = end if end >= 0 else i + 1
    out.append(markup[at:])
    t = "".join(out)
    return html_.unescape(t) if "&" in t else t


def declared(markup: str) -> str | None:
    """The language that a page's html or body tag declares by lang or xml:lang, lower-cased: the first that does."""
    at = 0
    while m := _ROOT.search(markup, at):
        end = markup.find(">", m.end())
        end = len(markup) if end < 0 else end
        if d := _DECLARED.search(markup, m.end(), end):
            return d[1].lower()
        at = end
    return None


def evidence(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """rows(keys..., host, body, is_markup) -> (keys..., host, declared, text array<double>): log-likelihoods of the text by language.

    A null or empty body has likelihood 0 in the log for every language, that is, no evidence.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    n_keys = len(keys)
    src = rows.select(*keys, "host", "body", "is_markup")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[: n_keys + 1]) + ", declared string, text array<double>"

    def run(batches):
        m = shared.value
        for b in batches:
            said: list[str | None] = []
            texts = []
            for x, markup in zip(b.column(n_keys + 1), b.column(n_keys + 2).to_pylist(), strict=True):
                x = x.as_py() or ""
                said.append(declared(x) if markup else None)
                texts.append(visible(x) if markup else x)
            out = np.zeros((b.num_rows, len(m.languages)))
            for row, n, offsets, data in textkit.slices(pa.array(texts, pa.large_string())):
                if len(data) < 3 or not m.languages:
                    continue
                k, ok = _trigrams(data), _inside(offsets, len(data))
                of = np.repeat(np.arange(n), np.diff(offsets))[: len(k)][ok]
                k = k[ok]
                size = np.bincount(of, minlength=n)
                scale = np.minimum(size, EVIDENCE) / np.maximum(size, 1)
                for i in range(len(m.languages)):
                    out[row : row + n, i] = np.bincount(of, m.logp[i][k], n) * scale
            flat = pa.array(out.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, max(1, len(m.languages)), dtype=np.int32)) if len(m.languages) else pa.array(np.zeros(b.num_rows + 1, np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*b.columns[: n_keys + 1], pa.array(said, pa.string()), lists], names=[*keys, "host", "declared", "text"])

    return src.mapInArrow(run, schema)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def _posterior(log: Column) -> Column:
    """Normalised probabilities of an array of logs, in time linear in it."""
    powers = lambda log, top: F.transform(log, lambda x: F.exp(x - top))
    shares = lambda e, total: F.transform(e, lambda x: x / total)
    return let(log, lambda log: let(F.array_max(log), lambda top: let(powers(log, top), lambda e: let(_total(e), lambda total: shares(e, total)))))


def _sums(p: Column, n: int) -> Column:
    """An array of the n sums of an array column over a group: map-side combined."""
    return F.array(*[F.sum(p[i]) for i in range(n)])


def _counts(rows: DataFrame, key: Column, name: str, n: int) -> DataFrame:
    """(name, counts array<double>, rows): sums of p over the rows of a key, and how many they are. A null key has no row."""
    return rows.where(key.isNotNull()).groupBy(key.alias(name)).agg(_sums(F.col("p"), n).alias("counts"), F.count("*").alias("rows"))


def site_of(host: Column) -> Column:
    """The last two labels of a host: what its pages share a prior with first."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def identify(seen: DataFrame, model: Model, keys: list[str], strength: float = 8.0) -> DataFrame:
    """evidence rows -> (keys..., lang, confidence, text_lang, declared, host).

    lang: the language of the largest posterior, ties to the first name; confidence: that posterior.
    text_lang: the same by text alone. strength: the weight of a parent's shares, in rows. Rows with a
    null host or no declaration lack that evidence only; repeated rows are repeated. Without any
    labelled text there are no languages: lang is null and confidence 0.
    """
    n = len(model.languages)
    if not n:
        return seen.select(*keys, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    names = F.array(*[F.lit(x) for x in model.languages])
    share = F.array(*[F.lit(float(x)) for x in model.share])
    own = seen.withColumn("p", _posterior(F.zip_with("text", share, lambda a, b: a + b)))
    small = own.select("host", site_of(F.col("host")).alias("site"), suffix_of(F.col("host")).alias("suffix"), "declared", "p")
    def smoothed(counts: Column, parent: Column) -> Column:
        return let(_total(counts), lambda total: F.zip_with(counts, parent, lambda c, q: (c + strength * q) / (strength + total)))

    corpus_counts = small.agg(_sums(F.col("p"), n)).first()[0]
    corpus_counts = [c or 0.0 for c in corpus_counts]
    corpus = [(c + 1 / n) / (sum(corpus_counts) + 1) for c in corpus_counts]
    top = F.array(*[F.lit(x) for x in corpus])
    by_host = cut(_counts(small, F.col("host"), "host", n).withColumn("site", site_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    above = lambda key: by_host.groupBy(key).agg(_sums(F.col("counts"), n).alias("more"), F.count("*").alias("hosts"))
    suffixes = cut(above("suffix").select("suffix", smoothed(F.col("more"), top).alias("by_suffix"), "hosts"), "suffixes")
    sites = cut(above("site"), "sites")
    placed = join_spread(by_host, suffixes, ["suffix"], "hosts").drop("hosts")
    placed = join_spread(placed, sites, ["site"], "hosts")
    hosts = cut(placed.select("host", "counts", smoothed(F.col("more"), F.col("by_suffix")).alias("parent"), "by_suffix", "rows"), "priors")
    said = cut(_counts(small, F.col("declared"), "declared", n).select("declared", F.col("counts").alias("told"), F.col("rows").alias("declaring")), "declared")
    zero = F.array(*[F.lit(0.0)] * n)
    logs = lambda a: F.transform(a, lambda x: F.log(x))
    fused = join_spread(join_spread(own, hosts, ["host"], "rows", "left").withColumnRenamed("rows", "of_host"), said, ["declared"], "declaring", "left")
    # A row is no evidence for itself: its own posterior is left out of its host's counts and of its declaration's.
    others = lambda c: F.zip_with(c, "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    prior = F.when(F.col("counts").isNotNull(), smoothed(others("counts"), F.col("parent"))).otherwise(top)
    # P(declared | language) from counts of language given what is declared: Bayes' rule up to a factor of the row.
    told = F.when(F.col("told").isNotNull(), F.zip_with(smoothed(others("told"), top), top, lambda a, b: F.log(a) - F.log(b))).otherwise(zero)
    # P(suffix | language) / P(suffix) is by_suffix / corpus. The host prior has it through its parents already, the less so the more rows the host has
    # (smoothed() gives the parents strength / (strength + rows)), so that the suffix counts by itself by what is left of SUFFIX.
    weight = SUFFIX * strength / (strength + F.col("of_host") - 1)
    suffix = F.when(F.col("by_suffix").isNotNull(), F.zip_with("by_suffix", top, lambda a, b: weight * (F.log(a) - F.log(b)))).otherwise(zero)
    parts = ["text", logs(prior), told, suffix]
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    log = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), cols)
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    return fused.withColumn("post", _posterior(log)).select(*keys, best(F.col("post")).alias("lang"), F.array_max("post").alias("confidence"), best(F.col("p")).alias("text_lang"), "declared", "host")


def of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Input rows of evidence() from pages: the host is lower-cased, null where the address has none."""
    host = F.nullif(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    return pages.select(F.col(id_col), host.alias("host"), F.col(html_col).cast("string").alias("body"), F.lit(True).alias("is_markup"))


def of_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Input rows of evidence() from plain documents: their source stands for a host; they declare nothing."""
    return docs.select(F.col(id_col), F.nullif(F.lower(F.col(source_col).cast("string")), F.lit("")).alias("host"), F.col(text_col).cast("string").alias("body"), F.lit(False).alias("is_markup"))


def detect(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """evidence() and identify(); the small evidence table is written once, as three grouped counts read it."""
    return identify(cut(evidence(rows, model, keys), "langid"), model, keys)
