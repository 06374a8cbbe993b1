"""Offer lists and price matrices read out of landed HTML pages.

Python only tokenises a page into its tables; picking columns, matching headers,
reading prices and adding placeholders are column expressions on the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake import reference_values as ref
from pricelake.functions.scalars import price_text, safe_number, strip

_TEXT = T.StringType()
CELL_FIELDS = ("tag", "text", "raw", "href", "bold", "para")


# comment | script or style with its content | tag (close, name, attributes) and the text behind it | text | a lone <
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?</\1\s*>"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>([^<]*+)|([^<]++)|(<)",
    re.DOTALL | re.IGNORECASE,
)
#: Longer pages are read token by token, shorter ones in one call.
LONG_PAGE = 1_000_000


def _tokens(html: str) -> Iterable[tuple[str, str, str, str]]:
    """(close, tag, attributes, text behind the tag or without one); comments, scripts and styles are empty."""
    found = _TOKEN.findall(html) if len(html) < LONG_PAGE else (m.groups("") for m in _TOKEN.finditer(html))
    return ((close, tag.lower(), attrs, after or text or lone) for _, close, tag, attrs, after, text, lone in found)


_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def _attribute(attrs: str, wanted: str) -> str:
    if "=" not in attrs:
        return ""
    for name, *values in _ATTRIBUTE.findall(attrs):
        if name.lower() == wanted:
            return unescape("".join(values))
    return ""


class _Cell:
    """One td or th: its text parts and its first link, bold and paragraph."""

    __slots__ = ("tag", "parts", "anchor", "href", "inside", "bold", "para")

    def __init__(self, tag: str) -> None:
        self.tag, self.parts, self.anchor = tag, [], False
        self.href = self.inside = self.bold = self.para = None


def _page_tables(html: str | None) -> list[tuple[list[str], list[list[_Cell]]]]:
    """(classes, rows of cells) of the tables of a page; text belongs to every open cell around it."""
    if not html or "<table" not in html.lower():
        return []
    tables: list[tuple[list[str], list[list[_Cell]]]] = []
    open_tables: list[list] = []  # [rows, current cell]
    state = None  # the innermost open table
    for close, tag, attrs, text in _tokens(html):
        if tag == "table" and not close:
            rows: list[list[_Cell]] = []
            tables.append((_attribute(attrs, "class").split(), rows))
            state = [rows, None]
            open_tables.append(state)
        elif state is None:
            continue
        elif tag == "td" or tag == "th":
            if close:
                state[1] = None
            else:
                if not state[0]:
                    state[0].append([])
                state[1] = cell = _Cell(tag)
                state[0][-1].append(cell)
        elif tag == "tr":
            state[1] = None
            if not close:
                state[0].append([])
        elif tag == "table":
            open_tables.pop()
            state = open_tables[-1] if open_tables else None
        elif tag and state[1] is not None:
            _inline_tag(state[1], tag, close, attrs)
        if text and open_tables:
            if "&" in text:
                text = unescape(text)
            for _, cell in open_tables:
                if cell is not None:
                    cell.parts.append(text)
                    if cell.inside is not None:
                        cell.inside.append(text)
    return tables


def _inline_tag(cell: _Cell, tag: str, close: str, attrs: str) -> None:
    """First link, first bold and first paragraph of a cell."""
    if tag == "a" and not close and not cell.anchor:
        cell.anchor, cell.href = True, _attribute(attrs, "href") or None
    if tag == "b" or tag == "p":
        if close:
            cell.inside = None
        elif tag == "b" and cell.bold is None:
            cell.inside = cell.bold = []
        elif tag == "p" and cell.para is None:
            cell.inside = cell.para = []


def _joined(parts: list[str] | None) -> str | None:
    return None if parts is None else "".join(parts).strip()


def _text(parts: list[str]) -> str | None:
    return _joined(parts) if len(parts) < 2 else " ".join([t for p in parts if (t := p.strip())])


_READ = {
    "tag": lambda cell: cell.tag, "text": lambda cell: _text(cell.parts), "raw": lambda cell: _joined(cell.parts),
    "href": lambda cell: cell.href, "bold": lambda cell: _joined(cell.bold), "para": lambda cell: _joined(cell.para),
}


def _tables_array(pages: list[str | None], fields: Sequence[str] = CELL_FIELDS) -> pa.Array:
    """Tables of some pages as an Arrow array with the named fields of each cell, built column by column."""
    pages_at, tables_at, rows_at, classes_at = [0], [0], [0], [0]
    classes: list[str] = []
    cells: list[_Cell] = []
    for html in pages:
        for names, rows in _page_tables(html):
            classes += names
            classes_at.append(len(classes))
            for row in rows:
                cells += row
                rows_at.append(len(cells))
            tables_at.append(len(rows_at) - 1)
        pages_at.append(len(tables_at) - 1)

    def lists(starts: list[int], values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)

    columns = [pa.array(map(_READ[f], cells), pa.string(), size=len(cells)) for f in fields]
    rows = lists(tables_at, lists(rows_at, pa.StructArray.from_arrays(columns, names=list(fields))))
    tables = pa.StructArray.from_arrays([lists(classes_at, pa.array(classes, pa.string())), rows], names=["classes", "cells"])
    return lists(pages_at, tables)


#: Pages whose tables are held as Python objects at one time.
PAGES_AT_ONCE = 250


def _tables_udf(*fields: str):
    cell = T.StructType([T.StructField(n, _TEXT) for n in fields])
    table = T.StructType(
        [T.StructField("classes", T.ArrayType(_TEXT)), T.StructField("cells", T.ArrayType(T.ArrayType(cell)))]
    )

    @F.arrow_udf(T.ArrayType(table))
    def tables_of(html: pa.Array) -> pa.Array:
        """Every table of a page, in page order."""
        starts = range(0, max(len(html), 1), PAGES_AT_ONCE)
        return pa.concat_arrays([_tables_array(html.slice(at, PAGES_AT_ONCE).to_pylist(), fields) for at in starts])

    return tables_of


tables_of = _tables_udf(*CELL_FIELDS)
offer_tables = _tables_udf("tag", "text", "href")
matrix_tables = _tables_udf("tag", "raw", "bold", "para")


def _paragraphs(html: str | None, wanted: str = "addInfoTextView") -> list[str]:
    """Paragraph texts inside the first ``div`` of one class."""
    depth, inside, found = 0, False, []
    for close, tag, attrs, text in _tokens(html or ""):
        if tag == "div":
            if close and depth:
                depth -= 1
                if depth == 0:
                    break
            elif not close and (depth or wanted in _attribute(attrs, "class").split()):
                depth += 1
        elif tag == "p" and depth:
            inside = not close
            if inside:
                found.append([])
        if text and depth and inside and text.strip():
            found[-1].append(unescape(text).strip())
    return [" ".join(parts) for parts in found]


@F.arrow_udf(T.ArrayType(_TEXT))
def detail_paragraphs(html: pa.Array) -> pa.Array:
    return pa.array((_paragraphs(page.as_py()) for page in html), pa.list_(pa.string()))


def table_cells(pages: DataFrame, *, key: str, html: str = "html") -> DataFrame:
    """Long form: one row per cell with its table, row and column number (0-based)."""
    tables = pages.select(key, F.posexplode(tables_of(html)).alias("table_no", "t"))
    rows = tables.select(key, "table_no", "t.classes", F.posexplode("t.cells").alias("row_no", "cells"))
    return rows.select(key, "table_no", "classes", "row_no", F.posexplode("cells").alias("col_no", "cell")).select(
        key, "table_no", "classes", "row_no", "col_no", "cell.*"
    )


def detail_texts(pages: DataFrame, *, url: str = "detail_url", html: str = "html") -> DataFrame:
    """Non-empty paragraphs of each detail page joined by spaces."""
    text = F.array_join(F.filter(detail_paragraphs(html), lambda p: p != ""), " ")
    return pages.select(F.col(url).alias("detail_url"), text.alias("details"))


def offer_rows(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Offers of list pages ``(page, html, extracted_at)``.

    The first ``items`` table holds one offer per row after the header, in eight or nine
    cells.  A page without content or without offers yields one placeholder row.
    """
    first = F.get(F.filter(offer_tables("html"), lambda t: F.array_contains(t["classes"], "items")), F.lit(0))
    body = F.slice("__first", 2, F.greatest(F.size("__first"), F.lit(1)))
    tds = F.transform(body, lambda row: F.filter(row, lambda c: c["tag"] == "td"))
    offers = F.filter(tds, lambda row: F.size(row) >= 8)
    found = F.coalesce(F.size("__offers") > 0, F.lit(False))
    empty = F.col("html").isNull() | (F.col("html") == "")
    note = (
        F.when(empty, ref.NOTE_PAGE_UNAVAILABLE).when(found, ref.NOTE_OK).otherwise(ref.NOTE_PAGE_EMPTY)
    )
    rows = (
        pages.withColumn("__first", first["cells"])
        .withColumn("__offers", offers)
        .withColumn("note", note)
        .withColumn("__cells", F.explode_outer(F.when(found, F.col("__offers"))))
    )

    def text(i: int) -> Column:
        return F.get("__cells", F.lit(i))["text"]

    href = F.get("__cells", F.lit(0))["href"]
    value, currency = price_text(text(5))
    url = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(ref.OFFER_SITE), href))
    shaped = rows.select(
        F.concat(F.lit(ref.OFFER_LIST_URL), F.col("page").cast("string")).alias("source_url"),
        F.col("page").cast("int").alias("page"),
        text(0).alias("offer_date"), text(1).alias("company"), F.upper(text(2)).alias("offer_type"),
        text(3).alias("crop"), text(4).alias("volume_tons"), text(5).alias("price_raw"),
        value.alias("price_value"), currency.alias("currency"), text(6).alias("delivery_term"),
        text(7).alias("basis"), text(8).alias("location"), url.alias("detail_url"), "note", "extracted_at",
    )
    if details is None:
        joined = shaped.withColumn("details", F.lit(None).cast("string"))
    else:
        known = details.select(F.concat(F.lit("u"), "detail_url").alias("__url"), "details")
        # offers without a link have a key of their own page, so that they do not meet in one task
        own = F.coalesce(F.concat(F.lit("u"), "detail_url"), F.concat(F.lit("n"), "source_url"), F.lit("n"))
        joined = shaped.withColumn("__own", own).join(known, F.col("__own") == F.col("__url"), "left").drop("__own", "__url")
    text_or_empty = F.when(F.col("note") == ref.NOTE_OK, F.coalesce("details", F.lit("")))
    return joined.withColumn("details", text_or_empty)


def crop_name(name: Column) -> Column:
    """English crop name out of the fixed dictionary, else the name itself."""
    entries = F.create_map(*[p for k, v in ref.CROP_NAMES.items() for p in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(entries, name), name)


def elevator_rows(pages: DataFrame, *, header_offset: int = 1) -> DataFrame:
    """Crop prices of company pages ``(company_slug, company_name, html, extracted_at)``.

    Each table is a location by crop matrix titled by its storage type.  Body cell i is
    paired with header cell i + ``header_offset``; 1 is what the source pages need.
    """
    tables = pages.select(
        "company_slug", "company_name", "extracted_at", F.explode(matrix_tables("html")).alias("t")
    )
    header = F.col("t")["cells"][0]
    title = F.get(F.filter(header, lambda c: c["tag"] == "th"), F.lit(0))["raw"]
    typed = tables.filter(F.size(F.col("t")["cells"]) > 0).select(
        "company_slug", "company_name", "extracted_at", title.alias("storage_type"),
        F.transform(header, lambda c: c["raw"]).alias("crops"),
        F.explode(F.slice(F.col("t")["cells"], 2, F.greatest(F.size(F.col("t")["cells"]), F.lit(1)))).alias("row"),
    )
    body = (
        typed.filter(F.col("storage_type").isin(*ref.STORAGE_TYPES))
        .withColumn("row", F.filter("row", lambda c: c["tag"] == "td"))
        .filter(F.size("row") >= 2)
    )
    place = F.col("row")[0]
    cells = body.select(
        "company_slug", "company_name", "extracted_at", "storage_type", "crops",
        F.coalesce(place["bold"], F.lit("")).alias("storage_location"),
        F.coalesce(place["para"], F.lit("")).alias("address_region"),
        F.posexplode("row").alias("col_no", "cell"),
    )
    crop = F.get("crops", F.col("col_no") + header_offset)
    price = F.replace(F.col("cell")["raw"], F.lit(" "), F.lit(""))
    return (
        cells.filter((F.col("col_no") >= 1) & crop.isNotNull())
        .select(
            "company_slug", "company_name", "storage_type", "storage_location", "address_region",
            strip(crop).alias("culture_ua"), crop_name(strip(crop)).alias("category_name"),
            price.alias("price"), safe_number(F.translate(price, ",", ".")).alias("price_uah_per_ton"),
            F.concat(F.lit(ref.COMPANY_PAGE_URL), F.col("company_slug")).alias("source_url"),
            F.lit(ref.NOTE_OK).alias("note"), "extracted_at",
        )
        .filter((F.col("price") != "") & (F.col("price") != "-"))
    )


def with_expected(
    rows: DataFrame, expected: DataFrame, *, keys: list[str], note: str
) -> DataFrame:
    """Add one placeholder row for every expected entity that produced no row."""
    missing = expected.join(rows.select(*keys).distinct(), keys, "left_anti")
    return rows.unionByName(missing.withColumn("note", F.lit(note)), allowMissingColumns=True)


def expected_companies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(slug, name, ref.COMPANY_PAGE_URL + slug) for slug, name in ref.COMPANIES.items()],
        "company_slug string, company_name string, source_url string",
    )
