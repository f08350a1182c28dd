"""Markdown tables, pseudocode, equations and HTML tables."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PIPE_LINE = r"^\s*[|].*[|]\s*$"
SEPARATOR = r"^\s*\|[-:|\s]+\|\s*$"
PLACEHOLDER = "^Col[0-9]+$"
MAX_COLUMNS = 25
TABLE_CAPTION = r"^\s*(Tab\.|TABLE|Table)\s*(\d+|[CILVX]+)"
CODE_CAPTION = r"(?i)^\s*(procedure|alg\.|algorithm)\s*(\d+|[civlx]+)?\b"
_NUMBERED = r"^\s*\d+\s*[.:]\s+\S"
_KEYWORD = r"(?i)\b(end\s+(function|procedure|if|while|for)|for\s+each|input|output|ensure|require|return|function|procedure|until|repeat|while)\b"
_OPERATORS = "[=≠≡≤≥≈∝±∓·×∑∏∫√∂∇←→↦⊕⊗⊙∈∉⊂⊆∃∀]"
_NUMBER = r"[(]\s*[0-9]+\s*[)]\s*$"


def split_row(line: Column) -> Column:
    """Cells of a pipe row, trimmed; one empty cell goes at each edge; an escaped pipe separates too."""
    cells = F.transform(F.split(F.trim(line), r"\|", -1), lambda c: F.trim(c))
    cells = F.when((F.size(cells) > 0) & (cells[0] == ""), F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))).otherwise(cells)
    return F.when((F.size(cells) > 0) & (F.try_element_at(cells, F.lit(-1)) == ""), F.slice(cells, F.lit(1), F.size(cells) - 1)).otherwise(cells)


def clean_cell(cell: Column) -> Column:
    """Breaks become spaces, pipes are escaped, white space collapses."""
    t = F.regexp_replace(F.coalesce(cell, F.lit("")), r"(?i)<br\s*/?>", " ")
    t = F.replace(t, F.lit("|"), F.lit(r"\|"))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def is_separator(line: Column) -> Column:
    return line.rlike(SEPARATOR)


def render_rows(rows: Column) -> Column:
    """A rectangular pipe table: rows are padded to the widest, the first is the head."""
    width = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, clean_cell), F.array_repeat(F.lit(""), (width - F.size(r)).cast("int"))), " | "), F.lit(" |"))
    lines = F.transform(rows, line)
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.when(F.size(rows) == 0, "").otherwise(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))), "\n"))


def strip_placeholders(columns: Column) -> Column:
    return F.filter(columns, lambda c: (c != "") & ~c.rlike(PLACEHOLDER))


def is_degenerate(rows: Column, max_columns: int = MAX_COLUMNS) -> Column:
    """Fewer than two rows, all blank, too wide, a head of placeholders, or under 15 % filled."""
    cells = F.flatten(rows)
    filled = F.size(F.filter(cells, lambda c: F.trim(c) != ""))
    head = F.try_element_at(rows, F.lit(1))
    named = F.size(F.filter(head, lambda c: c.rlike(PLACEHOLDER)))
    return (
        (F.size(rows) < 2)
        | (filled == 0)
        | (F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)) > max_columns)
        | F.coalesce((F.size(head) > 0) & (named >= 0.6 * F.size(head)), F.lit(False))
        | (filled < 0.15 * F.size(cells))
    )


def looks_like_pseudocode(rows: Column, caption: Column) -> Column:
    """By its caption, or narrow with at least three lines, half numbered or three with keywords."""
    lines = F.filter(F.transform(rows, lambda r: F.trim(F.array_join(r, " "))), lambda x: x != "")
    numbered = F.size(F.filter(lines, lambda x: x.rlike(_NUMBERED)))
    keyed = F.size(F.filter(lines, lambda x: x.rlike(_KEYWORD)))
    narrow = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)) <= 2
    by_caption = F.coalesce(caption.rlike(CODE_CAPTION), F.lit(False))
    return by_caption | (narrow & (F.size(lines) >= 3) & ((numbered >= 0.5 * F.size(lines)) | (keyed >= 3)))


def render_pseudocode(rows: Column) -> Column:
    lines = F.filter(F.transform(rows, lambda r: F.rtrim(F.array_join(r, " "))), lambda x: F.trim(x) != "")
    return F.concat(F.lit("```text\n"), F.array_join(lines, "\n"), F.lit("\n```"))


def looks_like_display_equation(line: Column) -> Column:
    """Does a line of 3 to 200 characters hold an operator and read like mathematics, not prose?

    Emphasis marks don't count; what is left needs six characters, no three words in a row, no closing
    point unless it is numbered, under three quarters letters and at most 25 parts.
    """
    t = F.trim(line)
    core = F.trim(F.regexp_replace(t, r"[\[\]`~*_]+", ""))
    letters = F.length(F.regexp_replace(core, r"[^\p{L}]", ""))
    return (
        F.length(t).between(3, 200)
        & ~t.rlike("^[-*#>|]|^```")
        & (F.length(core) >= 6)
        & core.rlike(_OPERATORS)
        & ~core.rlike(r"\b[a-zA-Z]{3,}\b[, ]+\b[a-zA-Z]{3,}\b[, ]+\b[a-zA-Z]{3,}\b")
        & (core.rlike(_NUMBER) | ~core.rlike("[.:;?]$"))
        & (letters < 0.75 * F.length(core))
        & (F.size(F.split(core, r"\s+")) <= 25)
    )


def link_markers(body: Column, link: Column, has_tables: Column) -> Column:
    """[[TABLE:n]] becomes a link into the tables file, if there is one."""
    parts = F.split(body, r"\[\[TABLE:")
    linked = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.when(p.rlike(r"^\d+\]\]"), F.concat(F.lit("[[TABLE:"), F.regexp_extract(p, r"^(\d+)\]\]", 1), F.lit("]]("), link, F.lit("#table-"), F.regexp_extract(p, r"^(\d+)\]\]", 1), F.lit(")"), F.regexp_replace(p, r"^\d+\]\]", ""))).otherwise(F.concat(F.lit("[[TABLE:"), p)))
    return F.when(has_tables, F.concat(parts[0], F.array_join(linked, ""))).otherwise(body)


def table_block(index: Column, caption: Column, page: Column, columns: Column, n_rows: Column, markdown: Column) -> Column:
    """The self-contained section of one table in a tables file."""
    return F.concat_ws(
        "\n",
        F.format_string("## Table %d", index),
        F.when(F.coalesce(caption, F.lit("")) != "", F.concat(F.lit("**"), caption, F.lit("**"))),
        F.format_string("Page %d, %d rows", page, n_rows),
        F.when(F.size(strip_placeholders(columns)) > 0, F.concat(F.lit("Columns: "), F.array_join(strip_placeholders(columns), ", "))),
        F.lit(""),
        markdown,
    )


_FLAGS = re.IGNORECASE | re.DOTALL
_TABLE, _ROW = (re.compile(rf"<{tag}\b[^>]*>(.*?)</{tag}\s*>", _FLAGS) for tag in ("table", "tr"))
_CELL = re.compile(r"<t([dh])(?=[\s>])(?P<attributes>[^>]*)>(?P<body>.*?)</t\1\s*>", _FLAGS)
_SPAN = re.compile(r"\b(?:row|col)span[\s=\"']+(\d+)", _FLAGS)
_WIDEST = 16


def _shown(cell: re.Match[str]) -> list[str]:
    text = html.unescape(re.sub("<[^<>]*>", " ", cell["body"]))
    times = next((int(n) for n in _SPAN.findall(cell["attributes"])), 1)
    return [" ".join(text.split())] * max(1, min(times, _WIDEST))


def html_rows(table: str) -> list[list[str]]:
    """Rows of an HTML table; the first span attribute of a cell repeats it, up to 16 times."""
    found = ([s for cell in _CELL.finditer(row[1]) for s in _shown(cell)] for row in _ROW.finditer(table))
    return [r for r in found if r]


def _pipe(found: re.Match[str]) -> str:
    rows = [r for r in html_rows(found[0]) if "".join(r)]
    if len(rows) < 2:
        return found[0]
    width = max(map(len, rows))
    line = lambda cells: f"| {' | '.join(cells)} |"
    body = [line([c.replace("|", r"\|") for c in r] + [""] * (width - len(r))) for r in rows]
    body.insert(1, line(["---"] * width))
    return "\n".join(["", "", *body, "", ""])


def html_tables_to_pipe(text: Column) -> Column:
    """Replace each HTML table of at least two rows by a pipe table (a computed replacement: an Arrow function)."""
    import pandas as pd

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None else _TABLE.sub(_pipe, t))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(text)
