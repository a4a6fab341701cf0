"""Statistics tables in captured web pages, read into records.

Pages are a table ``(page_id, url, html)``. Spark spreads them over tasks and
each task parses its own pages; a page is one row, so nothing is gathered.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Send this parser along with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What marks the table, its repeated header rows, its cells and the player's cell.
TABLE_ID = "totals_stats"
HEADER_CLASS = "thead"
CELL_NAME = "data-stat"
PLAYER_CELLS = ("player", "name_display")

ROWS_AT_ONCE = 5000

# A whole tag whose attribute values are closed quotes or hold no quote: nearly all tags. No part
# gives back what it has read, so what does not match is known soon and is read state by state.
_SOUND_TAG = re.compile(
    r"""<(/?)([a-z][^\s/>]*+)((?:[\s/]*+[^\s/>="']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>=]++))?+)*+)[\s/]*+>""",
    re.IGNORECASE,
)
_TAG_START = re.compile(r"</?[a-z]|<!--", re.IGNORECASE)
_TAG_NAME = re.compile(r"<(/?)([a-z][^\s/>]*+)", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# A whole cell that holds text alone and whose attributes are all quoted twice: nearly all cells.
_PLAIN_CELL = re.compile(
    r"""[^<]*+<(t[dh])((?:\s++[a-z][^\s/>="'<]*+="[^"]*+")*+)\s*+>([^<]*+)</\1>""", re.IGNORECASE
)

# The states between the parts of a tag: before a name, in a name, before a value, in a bare value.
_GAP = re.compile(r"[\s/]*+")
_NAME = re.compile(r"=?[^\s/>=]*+")
_EQUALS = re.compile(r"\s*+=\s*+")
_BARE = re.compile(r"[^\s>]++")


class Damaged(ValueError):
    """A page ends inside a tag, a comment or a script; what stood behind it is lost."""


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes that begin at ``at``, the first of each name, and where their tag ends.

    A value is quoted twice, once or not at all, and ends with its own quote, or, bare, with white
    space or the tag; a quote inside a bare value is text, and a quote that is not closed goes on to
    the next one, wherever that is.
    """
    found: dict[str, str] = {}
    while True:
        at = _GAP.match(page, at).end()
        if page[at : at + 1] == ">":
            return found, at + 1
        named = _NAME.match(page, at)
        if at == len(page):
            raise Damaged("the page ends inside a tag")
        at, value = named.end(), ""
        if equals := _EQUALS.match(page, at):
            at = equals.end()
            quote = page[at : at + 1]
            if quote in ('"', "'"):
                close = page.find(quote, at + 1)
                if close < 0:
                    raise Damaged("the page ends inside a quoted attribute")
                at, value = close + 1, page[at + 1 : close]
            elif bare := _BARE.match(page, at):
                at, value = bare.end(), bare.group()
        found.setdefault(named.group().lower(), value)


def _attribute(inside: str | dict[str, str], wanted: str) -> str | None:
    """Value of one attribute of a tag, from its text or from its attributes."""
    if isinstance(inside, dict):
        return _plain(inside[wanted]) if wanted in inside else None
    for name, double, single, bare in _ATTRIBUTE.findall(inside):
        if name.lower() == wanted:
            return _plain(double or single or bare)
    return None


@lru_cache(4096)
def _cell_name(inside: str) -> str | None:
    """Name of a cell from its tag's text; a page has few different ones."""
    return _attribute(inside, CELL_NAME)


def _tags(page: str, at: int = 0) -> Iterator[tuple[int, int, str, str, str | dict[str, str]]]:
    """(start, end, closing slash, name, attributes) of every tag outside comments, from left to right."""
    while found := _TAG_START.search(page, at):
        start = found.start()
        if found.group() == "<!--":
            at = page.find("-->", start + 4) + 3
            if at < 3:
                raise Damaged("the page ends inside a comment")
            yield start, at, "", "", ""
            continue
        if tag := _SOUND_TAG.match(page, start):
            at = tag.end()
            yield start, at, tag.group(1), tag.group(2).lower(), tag.group(3)
        else:
            tag = _TAG_NAME.match(page, start)
            inside, at = _attributes(page, tag.end())
            yield start, at, tag.group(1), tag.group(2).lower(), inside


def _plain(text: str) -> str:
    return entities.unescape(text) if "&" in text else text


class _Row(dict):
    """One table row; cells are filled in as they close."""

    cell = link = None
    text: list[str]

    def open_cell(self, name: str | None) -> None:
        self.close_cell()
        self.cell, self.link, self.text = name, None, []

    def close_cell(self) -> None:
        if self.cell:
            self.add(self.cell, "".join(self.text))
            if self.cell in PLAYER_CELLS and self.link is not None:
                self["player_url"] = self.link
        self.cell = None

    def add(self, name: str, text: str) -> None:
        value = _plain(text).strip()
        if name in PLAYER_CELLS:
            self["player"] = value
        self[name] = value


def page_rows(page: str) -> list[dict]:
    """Records of the first marked table of a page; none if it has no such table."""
    return read_page(page)[0]


def read_page(page: str) -> tuple[list[dict], str | None]:
    """Records of the first marked table of a page, and what was wrong if the page broke off before
    the table was over: rows may be missing then.

    Rows and cells may lack their closing tags. Header rows repeated in the body, rows
    without a player, and tables inside a cell are passed over.
    """
    rows: list[_Row] = []
    error = None
    try:
        _read_rows(page, rows)
    except Damaged as damage:
        error = str(damage)
    return rows, error


def _read_rows(page: str, rows: list[_Row]) -> None:
    """Add the records to ``rows`` as they are finished."""
    depth, in_body, row, end, skipping = 0, False, None, 0, None

    def finish(row: _Row | None) -> None:
        if row is not None:
            row.close_cell()
            if row.get("player"):
                rows.append(row)

    tags = _tags(page)
    while True:
        if row is not None and not row.cell and depth == 1 and not skipping and (plain := _PLAIN_CELL.match(page, end)):
            while plain:
                if name := _cell_name(plain.group(2)):
                    row.add(name, plain.group(3))
                end = plain.end()
                plain = _PLAIN_CELL.match(page, end)
            tags = _tags(page, end)
        try:
            start, stop, closing, tag, inside = next(tags)
        except StopIteration:
            break
        except Damaged:
            finish(row)
            raise
        if skipping:  # the text of a script or style block may look like tags
            if closing and tag == skipping:
                skipping, end = None, stop
            continue
        if row is not None and row.cell and depth == 1:
            row.text.append(page[end:start])
        end = stop
        if tag in ("script", "style") and not closing:
            skipping = tag
        elif tag == "table":
            if closing:
                depth -= depth > 0
                if depth == 0 and in_body:
                    break
            elif depth or _attribute(inside, "id") == TABLE_ID:
                depth += 1
        elif depth != 1:
            continue
        elif tag == "tbody":
            if closing and in_body:
                break
            in_body = True
        elif tag == "tr" and in_body:
            finish(row)
            header = closing or HEADER_CLASS in (_attribute(inside, "class") or "").split()
            row = None if header else _Row()
        elif row is None:
            continue
        elif tag in ("td", "th"):
            row.close_cell() if closing else row.open_cell(_attribute(inside, CELL_NAME))
        elif tag == "a" and not closing and row.cell and row.link is None:
            row.link = _attribute(inside, "href") or ""
    finish(row)
    if skipping:
        raise Damaged(f"the page ends inside a {skipping}")


def stats_records(pages: DataFrame, stats: list[str], base_url: str, season_year: int) -> DataFrame:
    """One row per player row of every page, values as trimmed text.

    ``stats`` names the cells wanted; one that a row lacks is NULL. A page that cannot be read to the
    end of its table gives the rows found and one more with its ``error``, and the job goes on.
    """
    cells = [s for s in stats if s not in ("season_year", "player_url")]
    texts = [*cells, "player_url", "error"]
    schema = pa.schema([("page_id", pa.int64()), ("row_no", pa.int32()), *[(c, pa.string()) for c in texts]])
    ddl = ", ".join(["page_id bigint", "row_no int", *[f"`{c}` string" for c in texts]])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []

        def part() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({c: [row.get(c) for row in out] for c in schema.names}, schema)
            out.clear()
            return made

        for batch in batches:
            for page_id, page in zip(batch["page_id"].to_pylist(), batch["html"].to_pylist()):
                found, error = read_page(page or "")
                out += [{"row_no": place, **row, "page_id": page_id} for place, row in enumerate(found, 1)]
                if error:
                    out.append({"row_no": 0, "page_id": page_id, "error": error})
                if len(out) >= ROWS_AT_ONCE:
                    yield part()
        yield part()

    return pages.select("page_id", "html").mapInArrow(parse, ddl).select(
        "page_id",
        "row_no",
        F.lit(season_year).alias("season_year"),
        *cells,
        F.concat(F.lit(base_url), F.col("player_url")).alias("player_url"),
        F.current_timestamp().alias("scraped_at"),
        "error",
    )
