"""Text of web pages and documents whose structure SQL can't follow: Arrow-batched functions over small parsers."""

from __future__ import annotations

import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tags by their role, and what marks hidden or disclosed parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(("script", "style", "noscript", "svg"))
BLOCK = frozenset("p div br li h1 h2 h3 h4 h5 h6 section article header footer table ul ol".split())
ICON_STOP = BLOCK | frozenset("tr td th main body html nav aside dl dt dd blockquote pre".split())
SR_ONLY = frozenset(("visually-hidden", "sr-only"))
HIDDEN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
DISCLOSURE = re.compile(r"(?i)accordion|collaps|tab-pane|tabpanel|disclosure|expander|toggle-content")
PUNCTUATION = ",.;:)!?"
# End of fixed values.


OPEN, CLOSE, TEXT = 0, 1, 2
#: Start tags that end an element which is still open, the elements that they end, and what they don't reach beyond.
_PARAGRAPH = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
_CELLS = frozenset("table td th caption html object template".split())
_ENDS: dict[str, list[tuple[tuple[str, ...], frozenset[str]]]] = {
    "li": [(("li",), frozenset(("ul", "ol", "table", "td", "th")))],
    "dt": [(("dt", "dd"), frozenset(("dl", "table", "td", "th")))],
    "dd": [(("dt", "dd"), frozenset(("dl", "table", "td", "th")))],
    "td": [(("td", "th"), frozenset(("table",)))],
    "th": [(("td", "th"), frozenset(("table",)))],
    "tr": [(("tr",), frozenset(("table",))), (("td", "th"), frozenset(("table",)))],
    "tbody": [(("tbody", "thead", "tfoot"), frozenset(("table",))), (("tr",), frozenset(("table",)))],
    "option": [(("option",), frozenset(("select",)))],
    "optgroup": [(("optgroup",), frozenset(("select",))), (("option",), frozenset(("select",)))],
}
_ENDS |= {"thead": _ENDS["tbody"], "tfoot": _ENDS["tbody"]}


class _Reader(HTMLParser):
    """Markup as a flat list of (OPEN, name, attributes), (CLOSE, name, None) and (TEXT, string, None), every element closed.

    Comments and declarations are left out. An element that isn't closed ends where HTML says (p, li, dt, dd, td, th, tr, tbody, option), else with
    its parent. Each tag costs a bounded number of lookups beside the elements that it ends, however many are open.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tokens: list[tuple] = []
        self.open: list[str] = []
        self.places: dict[str, list[int]] = {}

    def _place(self, name: str) -> int:
        at = self.places.get(name)
        return at[-1] if at else -1

    def _end_at(self, place: int) -> None:
        while len(self.open) > place:
            name = self.open.pop()
            self.places[name].pop()
            self.tokens.append((CLOSE, name, None))

    def _end_one_of(self, names, beyond: frozenset[str]) -> None:
        place = max(self._place(n) for n in names)
        if place >= 0 and place > max(self._place(n) for n in beyond):
            self._end_at(place)

    def handle_starttag(self, tag, attrs):
        for names, beyond in _ENDS.get(tag, ()):
            self._end_one_of(names, beyond)
        if tag in _PARAGRAPH:
            self._end_one_of(("p",), _CELLS)
        self.tokens.append((OPEN, tag, {k: v or "" for k, v in attrs}))
        if tag in VOID:
            self.tokens.append((CLOSE, tag, None))
        else:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.tokens += [(OPEN, tag, {k: v or "" for k, v in attrs}), (CLOSE, tag, None)]

    def handle_endtag(self, tag):
        place = self._place(tag)
        if place >= 0:
            self._end_at(place)

    def handle_data(self, data):
        self.tokens.append((TEXT, data, None))


def parse(markup: str) -> list[tuple]:
    r = _Reader()
    r.feed(markup)
    r.close()
    r._end_at(0)
    return r.tokens


def decode_email(code: str) -> str:
    """An address whose bytes are XORed with the first one; raises ValueError if malformed."""
    b = bytes.fromhex(code)
    if not b:
        raise ValueError("empty")
    return "".join(chr(c ^ b[0]) for c in b[1:])


def disclosed(attrs: dict[str, str]) -> bool:
    """A panel that is hidden only because it starts closed."""
    return attrs.get("role", "").strip().lower() == "region" or bool(attrs.get("aria-labelledby")) or bool(DISCLOSURE.search(attrs.get("class", "")))


def unseen(name: str, attrs: dict[str, str]) -> bool:
    """Whether no reader sees an element."""
    hidden = "hidden" in attrs or HIDDEN.search(attrs.get("style", ""))
    return name in DROPPED or bool(hidden and name not in ("html", "body") and not disclosed(attrs))


def seen(tokens: list[tuple]) -> list[tuple]:
    """Tokens without what no reader sees, and with coded addresses shown."""
    out: list[tuple] = []
    depth = 0  # inside an element that is left out
    for token in tokens:
        kind, name, attrs = token
        if depth:
            depth += (kind == OPEN) - (kind == CLOSE)
            continue
        if kind == OPEN:
            if unseen(name, attrs):
                depth = 1
                continue
            if "data-cfemail" in attrs:
                try:
                    out.append((TEXT, decode_email(attrs["data-cfemail"]), None))
                    depth = 1
                    continue
                except ValueError:
                    pass
        out.append(token)
    return out


def closes(tokens: list[tuple]) -> list[int]:
    """For each OPEN the place of its CLOSE."""
    out, stack = [0] * len(tokens), []
    for i, (kind, _, _) in enumerate(tokens):
        if kind == OPEN:
            stack.append(i)
        elif kind == CLOSE:
            out[stack.pop()] = i
    return out


def _step(step: str):
    m = re.fullmatch(r"([a-zA-Z][\w-]*)?((?:[#.][\w-]+)*)", step)
    if not m or not step:
        raise ValueError(f"selector not understood: {step!r}")
    tag, marks = (m[1] or "").lower(), re.findall(r"([#.])([\w-]+)", m[2])

    def fits(name: str, attrs: dict[str, str]) -> bool:
        return (not tag or name == tag) and all(v == attrs.get("id", "") if k == "#" else v in attrs.get("class", "").split() for k, v in marks)

    return fits


def find(tokens: list[tuple], selector: str) -> int | None:
    """The place of the first element under a selector of steps like main, #id, div.class, parted by blanks."""
    *steps, last = [_step(s) for s in selector.split()]
    met = [0]  # how many steps the open elements have met, in order
    for i, (kind, name, attrs) in enumerate(tokens):
        if kind == OPEN:
            n = met[-1]
            if n == len(steps) and last(name, attrs):
                return i
            met.append(n + 1 if n < len(steps) and steps[n](name, attrs) else n)
        elif kind == CLOSE:
            met.pop()
    return None


def text_of(tokens: list[tuple], selector: str) -> str | None:
    """All strings of the first element under a selector, as they are; None if there is none."""
    at = find(tokens, selector)
    return None if at is None else "".join(value for kind, value, _ in tokens[at : closes(tokens)[at]] if kind == TEXT)


def target(attrs: dict[str, str]) -> str | None:
    """What a link cites: a web address as it is, a mail address alone; other schemes and relative links cite nothing."""
    address = attrs.get("href", "").strip()
    scheme, colon, rest = address.partition(":")
    if not colon:
        return None
    if scheme == "mailto":
        return rest.partition("?")[0]
    return address if scheme in ("http", "https") and rest.startswith("//") else None


def cell(tokens: list[tuple], links: bool) -> str:
    """A table cell's strings, trimmed and joined by one space; then the targets of its links that their own text doesn't show, each once.

    One pass: a link's text is what was collected between its ends.
    """
    words: list[str] = []
    opened: list[tuple[str, dict, int]] = []
    cited: list[tuple[str, str]] = []  # target and text of each link, in order of its begin
    for kind, value, attrs in tokens:
        if kind == TEXT:
            words += value.split()
        elif kind == OPEN:
            opened.append((value, attrs, len(words)))
            if links and value == "a":
                opened[-1] = (value, {"at": len(cited)}, len(words))
                cited.append((target(attrs) or "", ""))
        else:
            name, attrs, start = opened.pop()
            if links and name == "a":
                cited[attrs["at"]] = (cited[attrs["at"]][0], " ".join(words[start:]))
    plain = lambda x: x.casefold().rstrip("/")
    shown = dict.fromkeys(to for to, said in cited if to and not (said and plain(said) == plain(to)))
    return " ".join([*words, *(f"<{to}>" for to in shown)])


def trim_icons(tokens: list[tuple]) -> None:
    """No blank between a text and punctuation where only an empty element (an icon) stands between. In one pass from the front."""
    end = closes(tokens)
    chars = [0]
    for kind, value, _ in tokens:
        chars.append(chars[-1] + (len(value) if kind == TEXT else 0))
    text, blanks, icon = None, [], False  # the last text, the blank ones after it, and whether an empty element stands after it
    for i, (kind, value, _) in enumerate(tokens):
        if kind == OPEN:
            if value in ICON_STOP:
                text, blanks, icon = None, [], False
            elif chars[end[i]] == chars[i]:
                icon = True
        elif kind == TEXT and value.strip():
            if value[0] in PUNCTUATION and icon and text is not None:
                for j in blanks:
                    tokens[j] = (TEXT, "", None)
                tokens[text] = (TEXT, tokens[text][1].rstrip(), None)
            text, blanks, icon = i, [], False
        elif kind == TEXT:
            blanks.append(i)


def page_text(markup: str, scope: str = "body", icon_space: bool = False, sr_only: bool = False, links: bool = False) -> str:
    """Visible text under a selector: blocks on their own lines, table rows as cells between pipes. A selector without match fails."""
    tokens = seen(parse(markup))
    at = find(tokens, scope)
    if at is None:
        raise ValueError(f"scope matched nothing: {scope!r}")
    tokens = tokens[at : closes(tokens)[at] + 1]
    if icon_space:
        inner = tokens[1:-1]
        trim_icons(inner)
        tokens[1:-1] = inner
    end = closes(tokens)
    out: list[str] = []
    i = 0
    while i < len(tokens):
        kind, value, attrs = tokens[i]
        if kind == TEXT:
            out.append(value)
        elif kind == OPEN and i and sr_only and SR_ONLY & set(attrs.get("class", "").split()):
            i = end[i]
        elif kind == OPEN and i and value == "tr":
            cells = (j for j in range(i + 1, end[i]) if tokens[j][0] == OPEN and tokens[j][1] in ("td", "th"))
            out.append("\n" + " | ".join(cell(tokens[j + 1 : end[j]], links) for j in cells) + "\n")
            i = end[i]
        elif value in BLOCK:
            out.append("\n")
        i += 1
    return re.sub(r"[ \t]+", " ", "".join(out))


def html_text(c: Column, scope: str = "body", **options) -> Column:
    """page_text of a column; null stays null, and a page that the scope doesn't match fails the query."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else page_text(x, scope, **options))

    return run(c)


def html_text_or_error(c: Column, scope: str = "body", **options) -> Column:
    """struct(text, error) of a column: a page that can't be read has an error and loses no other. Both are null where the page is."""

    def one(x: str | None) -> dict:
        try:
            return {"text": None if x is None else page_text(x, scope, **options), "error": None}
        except ValueError as e:
            return {"text": None, "error": str(e)}

    @F.pandas_udf("text string, error string")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x) for x in s], columns=["text", "error"])

    return run(c)


def visible_text(c: Column) -> Column:
    """Text of a page by expressions alone: scripts, styles, comments and tags as line ends or blanks. No nesting is understood."""
    bare = F.regexp_replace(c, r"(?is)<(script|style|noscript|svg)\b.*?</\1\s*>|<!--.*?-->", "")
    lines = F.regexp_replace(bare, r"(?i)</?(?:p|div|br|li|h[1-6]|section|article|header|footer|table|ul|ol|tr)\b[^>]*>", "\n")
    return F.regexp_replace(F.regexp_replace(lines, "<[^>]+>", ""), "[ \t]+", " ")


def json_lines(node, prefix: str = "") -> list[str]:
    """Data as indented "key: value" lines, in order, without null and empty values of objects."""
    pairs = [(k, v) for k, v in node.items() if v is not None and v != "" and v != [] and v != {}] if isinstance(node, dict) else [(f"[{i}]", v) for i, v in enumerate(node)] if isinstance(node, list) else None
    if pairs is None:
        return [f"{prefix}{node}"]
    out: list[str] = []
    for name, v in pairs:
        if isinstance(v, (dict, list)):
            out.append(f"{prefix}{name}" + ":" * isinstance(node, dict))
            out += json_lines(v, prefix + "  ")
        else:
            out.append(f"{prefix}{name}: {v}")
    return [x for x in out if x.strip()]


def flatten_json(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else "\n".join(json_lines(json.loads(x))))

    return run(c)


def canonical_digest(c: Column) -> Column:
    """SHA-256 of a JSON text with sorted keys and no blanks, in hex: what a hash chain's entries are hashed as."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        import hashlib

        return s.map(lambda x: None if x is None else hashlib.sha256(json.dumps(json.loads(x), sort_keys=True, separators=(",", ":")).encode()).hexdigest())

    return run(c)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _paragraphs(root) -> list[str]:
    return ["".join(t.text or "" for t in p.iter(_W + "t")) for p in root.findall(_W + "p")]


def _rows(root) -> list[str]:
    return [" | ".join("\n".join(_paragraphs(c)).strip() for c in r.findall(_W + "tc")) for t in root.findall(_W + "tbl") for r in t.findall(_W + "tr")]


def docx(blob: bytes, tables: bool = True) -> str:
    """Paragraphs in order, then table rows with cells between pipes."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
    return "\n".join(_paragraphs(body) + (_rows(body) if tables else []))


def docx_headers(blob: bytes) -> str:
    """Distinct section headers in document order: first-page, default, even pages of each section."""
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        body = ET.fromstring(z.read("word/document.xml"))
        names = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("word/_rels/document.xml.rels"))} if "word/_rels/document.xml.rels" in z.namelist() else {}
        out: list[str] = []
        for section in body.iter(_W + "sectPr"):
            refs = {h.get(_W + "type"): h.get(rel) for h in section.findall(_W + "headerReference")}
            for kind in ("first", "default", "even"):
                if refs.get(kind) in names:
                    root = ET.fromstring(z.read("word/" + names[refs[kind]]))
                    text = "\n".join([p for p in _paragraphs(root) if p.strip()] + _rows(root))
                    if text and text not in out:
                        out.append(text)
    return "\n\n".join(out)


def docx_text(files: DataFrame, tables: bool = True, headers: bool = False) -> DataFrame:
    """(path, body, headers) of files(path, content), one Arrow batch at a time."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "body": [docx(x, tables) for x in pdf["content"]], "headers": [docx_headers(x) if headers else None for x in pdf["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, body string, headers string")


def pdf_text(files: DataFrame, layout: bool = True, first: int | None = None, last: int | None = None) -> DataFrame:
    """(path, body) of PDF files by the pdftotext program, which must be on the executors; pages first to last, both included."""
    import shutil
    import subprocess

    def run(batches):
        if not shutil.which("pdftotext"):
            raise RuntimeError("pdftotext isn't installed on this executor")
        args = ["pdftotext", "-layout" if layout else "-raw", *(["-f", str(first)] if first else []), *(["-l", str(last)] if last else []), "-", "-"]
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "body": [subprocess.run(args, input=x, capture_output=True, timeout=300, check=True).stdout.decode() for x in pdf["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, body string")
