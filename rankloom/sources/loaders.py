"""Pages from a file's bytes, by kind of file.

Each loader takes bytes and a file name and gives (text, metadata) per page.  Formats that need a library which
isn't there raise LookupError; a loader of one's own can be registered for any ending.
"""

from __future__ import annotations

import csv
import importlib.util
import io
import json
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

from rankloom.functions.text import CHUNK, chunks

FILE_TYPES = (".pdf", ".docx", ".xlsx", ".xls", ".pptx", ".txt", ".csv", ".json", ".doc")
SHEET_CHARS, CSV_ROWS = 5000, 50
Page = tuple[str, dict[str, str]]
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def decoded(data: bytes) -> str:
    """UTF-8, or Latin-1 where it isn't, with line ends as \\n."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _empty(kind: str) -> list[Page]:
    return [("", {"format_note": kind})]


def _cut(text: str, method: str, size: int = CHUNK) -> list[Page]:
    return [(c, {"chunk_method": method}) for c in chunks(text, size)]


def load_txt(data: bytes, name: str) -> list[Page]:
    return _cut(decoded(data), "text_split_3k") or _empty("empty_txt")


def load_json(data: bytes, name: str) -> list[Page]:
    raw = decoded(data)
    if not raw.strip():
        return _empty("empty_json")
    try:
        pretty = json.dumps(json.loads(raw), indent=2, ensure_ascii=False)
    except ValueError:
        return [(raw[: 2 * CHUNK], {"format_note": "invalid_json"})]
    return [(pretty, {})] if len(pretty) <= 2 * CHUNK else _cut(pretty, "json_text_split")


def load_csv(data: bytes, name: str) -> list[Page]:
    """CSV_ROWS rows to a page below the header; a file of a header alone has it as its one row too."""
    raw = decoded(data)
    try:
        dialect = csv.Sniffer().sniff(raw[:4096]) if raw.strip() else csv.excel
    except csv.Error:
        dialect = csv.excel
    rows = list(csv.reader(io.StringIO(raw), dialect)) if raw.strip() else []
    if not rows:
        return _empty("empty_csv")
    title = " | ".join(rows[0])
    head = [title, "-" * min(len(title), 80)] if rows[0] else []
    body = rows[1:] or rows
    return [
        ("\n".join([*head, *(" | ".join(r) for r in body[at : at + CSV_ROWS])]), {"row_range": f"{at + 1}-{min(at + CSV_ROWS, len(body))}", "chunk_method": "csv_rows"})
        for at in range(0, len(body), CSV_ROWS)
    ]


def load_doc(data: bytes, name: str) -> list[Page]:
    """Runs of at least four printable ASCII characters: all that can be had without a reader for the old format."""
    found = b"\n".join(re.findall(rb"[\x20-\x7e]{4,}", data)).decode("ascii")
    return _cut(found, "text_split_3k") or _empty("empty_or_unreadable_doc")


def _xml(archive: zipfile.ZipFile, path: str) -> ElementTree.Element | None:
    try:
        return ElementTree.fromstring(archive.read(path))
    except KeyError:
        return None


def load_docx(data: bytes, name: str) -> list[Page]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = _xml(z, "word/document.xml")
    lines = []
    for p in body.iter(f"{_W}p") if body is not None else ():
        own = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n"}
        lines.append("".join(own.get(e.tag, e.text or "" if e.tag == f"{_W}t" else "") for e in p.iter()))
    return _cut("\n\n".join(lines), "text_split_3k") or _empty("empty_docx")


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref).group():
        n = 26 * n + ord(c) - 64
    return max(n - 1, 0)


def _cell(c: ElementTree.Element, strings: list[str]) -> str:
    kind, value = c.get("t"), c.findtext(f"{_S}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_S}t"))
    if value is None:
        return ""
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    return value


def load_xlsx(data: bytes, name: str) -> list[Page]:
    """A page per sheet: its rows that aren't empty, cells parted by bars; a long sheet is cut."""
    out: list[Page] = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = _xml(z, "xl/sharedStrings.xml")
        strings = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in shared] if shared is not None else []
        links = {e.get("Id"): e.get("Target") for e in _xml(z, "xl/_rels/workbook.xml.rels")}
        for sheet in _xml(z, "xl/workbook.xml").iter(f"{_S}sheet"):
            target = links[sheet.get(f"{_R}id")]
            root = _xml(z, target.lstrip("/") if target.startswith("/") else f"xl/{target}")
            grid = []
            for row in root.iter(f"{_S}row") if root is not None else ():
                cells: list[str] = []
                for c in row.iter(f"{_S}c"):
                    at = _column(c.get("r", "")) if c.get("r") else len(cells)
                    cells += [""] * (at - len(cells)) + [_cell(c, strings)]
                grid.append(cells)
            width = max(map(len, grid), default=0)
            lines = [" | ".join(r + [""] * (width - len(r))) for r in grid if any(x.strip() for x in r)]
            if lines:
                title = sheet.get("name")
                text = f"[Sheet: {title}]\n" + "\n".join(lines)
                parts = [(text, {})] if len(text) <= SHEET_CHARS else [(c, {"sheet_part": str(i + 1), "chunk_method": "sheet_split"}) for i, c in enumerate(chunks(text, SHEET_CHARS))]
                out += [(t, {"sheet_name": title, **m}) for t, m in parts]
    return out or _empty("empty_xlsx")


def load_xls(data: bytes, name: str) -> list[Page]:
    """Old workbooks need the xlrd library; a file that can't be read gives a placeholder, as others go on."""
    if importlib.util.find_spec("xlrd") is None:
        raise LookupError("XLS files need the xlrd library")
    import pandas as pd

    try:
        book = pd.read_excel(io.BytesIO(data), sheet_name=None, engine="xlrd")
    except Exception:
        return [(f"[Could not read XLS file: {name}]", {"format_note": "xls_read_error"})]
    out: list[Page] = []
    for title, frame in book.items():
        if not frame.empty:
            text = f"[Sheet: {title}]\n{frame.to_string(index=False)}"
            out += [(t, {"sheet_name": str(title)}) for t in (chunks(text, SHEET_CHARS) if len(text) > SHEET_CHARS else [text])]
    return out or _empty("empty_xls")


def load_pptx(data: bytes, name: str) -> list[Page]:
    """A page per slide: paragraphs that aren't blank, and table rows with cells parted by bars."""
    out: list[Page] = []
    words = lambda e: "".join(t.text or "" for t in e.iter(f"{_A}t")).strip()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        links = {e.get("Id"): e.get("Target") for e in _xml(z, "ppt/_rels/presentation.xml.rels")}
        for i, ref in enumerate(_xml(z, "ppt/presentation.xml").iter(f"{_P}sldId")):
            slide = _xml(z, f"ppt/{links[ref.get(f'{_R}id')]}")
            lines = []
            tree = slide.find(f"{_P}cSld/{_P}spTree") if slide is not None else None
            for shape in tree if tree is not None else ():
                if shape.tag == f"{_P}sp":
                    lines += [t for p in shape.iter(f"{_A}p") if (t := words(p))]
                for row in shape.iter(f"{_A}tr"):
                    cells = [words(c) for c in row.iter(f"{_A}tc")]
                    if any(cells):
                        lines.append(" | ".join(cells))
            out.append(("\n".join(lines), {"slide_number": str(i + 1)}))
    return out or _empty("empty_pptx")


def load_pdf(data: bytes, name: str) -> list[Page]:
    """The text layer of each page, by the pypdf library where it is installed."""
    try:
        from pypdf import PdfReader
    except ImportError:
        raise LookupError("PDF files need the pypdf library or a loader registered for .pdf") from None
    return [(p.extract_text() or "", {}) for p in PdfReader(io.BytesIO(data)).pages]


LOADERS: dict[str, Callable[[bytes, str], list[Page]]] = {
    ".pdf": load_pdf, ".docx": load_docx, ".xlsx": load_xlsx, ".xls": load_xls, ".pptx": load_pptx,
    ".txt": load_txt, ".csv": load_csv, ".json": load_json, ".doc": load_doc,
}


def load_pages(data: bytes, name: str, loaders: dict[str, Callable[[bytes, str], list[Page]]] | None = None) -> list[tuple[int, str, dict[str, str]]]:
    """(number from 1, text, metadata) of each page of a file, by the ending of its name."""
    ext = "." + name.lower().rpartition(".")[2]
    loader = {**LOADERS, **(loaders or {})}.get(ext)
    if loader is None:
        raise ValueError(f"files of kind {ext!r} aren't supported: {name}")
    return [(i, text, {"page": str(i - 1), **meta}) for i, (text, meta) in enumerate(loader(data, name), 1)]
