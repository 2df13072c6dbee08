"""HTML tables out of pages. The only Python stage: nested tables are beyond regular expressions."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmill.functions.markup import one_pass
from tariffmill.schemas import TABLE_TYPE

_TABLE_TAG = "(?i)<table"
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
_HIDDEN = ("script", "style")


class _TableReader(HTMLParser):
    """Collects the rows and cells of outermost tables; inner ones are read into the outer one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[tuple[str, list[str]]]]] = []
        self.open: list[str] = []
        self.counts: Counter[str] = Counter()
        # What an open tag of a kind adds to, innermost last.
        self.held: dict[str, list[list]] = {"table": [], "tr": [], "td": [], "th": []}
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        self.open.append(tag)
        self.counts[tag] += 1
        self.hidden += tag in _HIDDEN
        if tag not in self.held:
            return
        added: list = []
        if tag == "table" and not self.held["table"]:
            self.tables.append(added)
        elif tag == "tr" and self.held["table"]:
            self.tables[-1].append(added)
        elif tag in ("td", "th"):
            for row in self.held["tr"]:
                row.append((tag, added))
        self.held[tag].append(added)

    def handle_endtag(self, tag):
        if not self.counts[tag]:
            return
        while True:
            closed = self.open.pop()
            self.counts[closed] -= 1
            self.hidden -= closed in _HIDDEN
            if closed in self.held:
                self.held[closed].pop()
            if closed == tag:
                return

    def handle_data(self, data):
        if not self.hidden:
            for cell in self.held["td"]:
                cell.append(data)
            for cell in self.held["th"]:
                cell.append(data)


def _cell_value(text: str) -> tuple[str, float | None]:
    text = text.strip()
    if text.endswith("%"):
        try:
            number = float(text.replace("%", "").replace(",", ".")) / 100
        except ValueError:
            return text, None
        return str(number), number
    return text, None


def _read_table(rows: list[list[tuple[str, list[str]]]]) -> tuple[list[str], list[dict], list[dict]] | None:
    """Headers, text rows and number rows of a table, or None for a layout table."""
    if len(rows) < 2:
        return None
    header_at = next((i for i, row in enumerate(rows[:3]) if any(tag == "th" for tag, _ in row)), 0)
    headers = [" ".join("".join(parts).split()) for _, parts in rows[header_at]]
    texts, numbers = [], []
    for row in rows[header_at + 1:]:
        cells = [(h, *_cell_value("".join(parts))) for h, (_, parts) in zip(headers, row, strict=False) if h]
        # a lone 0 % counts as an empty cell
        if any(text if number is None else number for _, text, number in cells):
            texts.append({h: text for h, text, _ in cells})
            # of a repeated header the last cell counts, for its number as for its text
            numbers.append({h: n for h, n in {h: number for h, _, number in cells}.items() if n is not None})
    return ([h for h in headers if h], texts, numbers) if texts else None


def read_tables(page: str | None) -> list[tuple[list[str], list[dict], list[dict]]]:
    """All data tables of one page."""
    if not page:
        return []
    reader = _TableReader()
    reader.feed(one_pass(page))
    reader.close()
    return [found for found in map(_read_table, reader.tables) if found]


_READ_TYPE = T.ArrayType(T.StructType([
    *TABLE_TYPE.fields, T.StructField("numbers", T.ArrayType(T.MapType(T.StringType(), T.DoubleType()))),
]))
_READ_ARROW = pa.list_(pa.struct([
    ("headers", pa.list_(pa.string())),
    ("rows", pa.list_(pa.map_(pa.string(), pa.string()))),
    ("row_count", pa.int32()),
    ("numbers", pa.list_(pa.map_(pa.string(), pa.float64()))),
]))


def _tables_of(html: Column) -> Column:
    """Data tables of a page. Only pages with a table tag are sent to Python; the others go as NULL."""

    def items(rows: list[dict]) -> list[list[tuple]]:
        return [list(row.items()) for row in rows]

    @F.arrow_udf(_READ_TYPE)
    def read(pages: pa.Array) -> pa.Array:
        found = [
            [
                {"headers": headers, "rows": items(rows), "row_count": len(rows), "numbers": items(numbers)}
                for headers, rows, numbers in read_tables(page)
            ]
            for page in pages.to_pylist()
        ]
        return pa.array(found, type=_READ_ARROW)

    # Not deterministic to the optimizer, or it would read all pages once more to skip empty results.
    return read.asNondeterministic()(F.when(F.rlike(html, F.lit(_TABLE_TAG)), html))


def extract_tables(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per data table: key, place on the page, headers, rows as text, percentages as numbers."""
    found = pages.where(F.rlike(html, F.lit(_TABLE_TAG))).select(key, _tables_of(F.col(html)).alias("tables"))
    return found.select(key, F.posexplode("tables").alias("table_no", "table")).select(
        key, "table_no", "table.headers", "table.rows", "table.numbers", "table.row_count"
    )


def with_tables(df: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML column by ``tables``, the data tables of the page."""
    tables = F.transform("tables", lambda t: F.struct(*[t[name].alias(name) for name in TABLE_TYPE.fieldNames()]))
    return df.withColumn("tables", _tables_of(F.col(html))).drop(html).withColumn("tables", tables)
