"""Extraction of repeated elements and tables from a column of HTML pages.

A page is cut into tags and text by one pattern whose loops never go back, so it takes time in proportion to the page,
whatever the length of a tag. What lies inside which element follows from running counts of opening and
closing tags per page, as windows over its tokens: nesting needs no recursion and no limit. Comments, scripts
and styles are taken out first. Cells that span rows or columns are repeated by a grid that is filled
row by row, the one step in Python; it sees a table at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorflow.functions.codes import snake_case_column

# possessive loops: Java repeats them without recursion
_REST_OF_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+>"""
_TOKEN = rf"(?s)</?+[a-zA-Z]{_REST_OF_TAG}|[^<]++|<"
_NAME = r"^</?+([a-zA-Z][^\s>/]*+)"
_ATTRIBUTE = r"""(?s)([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534  # Fixed values: limits of the HTML standard


def _literal(pattern: str) -> Column:
    return F.lit(pattern)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, the first if repeated; '' if it has none, NULL if it is not there."""
    rest = F.regexp_replace(tag, r"^<[a-zA-Z][^\s>/]*+", "")
    names = F.transform(F.regexp_extract_all(rest, _literal(_ATTRIBUTE), F.lit(1)), F.lower)
    at = F.array_position(names, F.lit(name.lower())).cast("int")
    given = F.get(F.regexp_extract_all(rest, _literal(_ATTRIBUTE), F.lit(2)), at - 1)
    bare = F.when(given.rlike("""^["']"""), F.substring(given, 2, F.length(given) - 2)).otherwise(given)
    return F.when(at > 0, bare)


def _has(tag: Column, attrs: dict[str, str] | None) -> Column:
    """Whether an opening tag has all the given attributes.

    A class is looked for among the words of the attribute, any other value is the whole of it.
    """
    out = F.lit(True)
    for name, value in (attrs or {}).items():
        own = _attribute(tag, name)
        if name.lower() == "class":
            out = out & F.coalesce(F.array_contains(F.split(own, r"\s+"), F.lit(value)), F.lit(False))
        else:
            out = out & F.coalesce(own == value, F.lit(False))
    return out


def _tokens(pages: DataFrame, html: str, keys: Iterable[str], wanted: str) -> DataFrame:
    """``_page``, ``_keys``, ``_pos``, ``_token``, ``_tag`` and ``_closes`` of the pages that have a ``wanted`` tag."""
    clean = F.regexp_replace(F.col(html), _HIDDEN, "")
    kept = [F.col(k) for k in keys]
    return (
        pages.filter(F.contains(F.lower(F.col(html)), F.lit(f"<{wanted}")))
        .select(F.monotonically_increasing_id().alias("_page"), F.struct(F.lit(0), *kept).alias("_keys"), clean.alias("_html"))
        .select("_page", "_keys", F.posexplode(F.regexp_extract_all("_html", _literal(_TOKEN), F.lit(0))).alias("_pos", "_token"))
        .withColumn("_tag", F.lower(F.regexp_extract("_token", _NAME, 1)))
        .withColumn("_closes", F.col("_token").startswith("</"))
    )


def _inside(tokens: DataFrame, container: str, attrs: dict[str, str] | None) -> DataFrame:
    """The tokens inside the first matching ``container`` of each page, with ``_level``: how many further
    elements of that kind a token is in. A closing tag without an opening one counts for nothing; an
    element that is not closed ends with the page.
    """
    page = Window.partitionBy("_page")
    upto = page.orderBy("_pos")
    own = F.col("_tag") == container
    step = F.when(own & ~F.col("_closes"), 1).when(own, -1).otherwise(0)
    out = tokens.withColumn("_sum", F.sum(step).over(upto))
    out = out.withColumn("_depth", F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(upto)))
    opens = own & ~F.col("_closes") & _has(F.col("_token"), attrs)
    out = out.withColumn("_start", F.min(F.when(opens, F.struct("_pos", "_depth"))).over(page))
    ends = own & F.col("_closes") & (F.col("_pos") > F.col("_start._pos")) & (F.col("_depth") < F.col("_start._depth"))
    out = out.withColumn("_end", F.min(F.when(ends, F.col("_pos"))).over(page))
    inside = (F.col("_pos") > F.col("_start._pos")) & (F.col("_end").isNull() | (F.col("_pos") < F.col("_end")))
    level = F.col("_depth") - F.col("_start._depth")
    return out.filter(inside).withColumn("_level", level).drop("_sum", "_depth", "_start", "_end")


def _text_of(tokens: DataFrame, group: Sequence[str], first: Sequence[Column]) -> DataFrame:
    """Per group the text tokens in order, joined, and what ``first`` makes of its opening tag."""
    text = F.when(F.col("_tag") == "", F.struct("_pos", "_token"))
    parts = F.sort_array(F.collect_list(text))
    return tokens.groupBy("_page", *group).agg(
        F.array_join(F.transform(parts, lambda p: p["_token"]), "").alias("_text"), *first
    )


def decode_entities(text: Column) -> Column:
    """Numeric character references and the names of ASCII and Latin-1 characters decoded.

    A no-break space becomes a space. References that name no character stay as they are.
    """
    names = [F.lit(x) for n, c in sorted(name2codepoint.items()) if c < 256 for x in (n, chr(c))]
    known = F.create_map(F.lit("apos"), F.lit("'"), *names)
    pattern = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]+[0-9]*);"

    def character(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def decoded(name: Column) -> Column:
        hexadecimal = F.conv(F.substring(name, 3, 6), 16, 10).cast("long")
        number = F.substring(name, 2, 7).try_cast("long")
        found = (
            F.when(name.rlike("^#[xX]"), character(hexadecimal))
            .when(name.startswith("#"), character(number))
            .otherwise(F.try_element_at(known, name))
        )
        return F.coalesce(found, F.concat(F.lit("&"), name, F.lit(";")))

    pieces = F.split(text, pattern)
    marks = F.transform(F.regexp_extract_all(text, _literal(pattern), F.lit(1)), decoded)
    joined = F.array_join(
        F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(marks, i), F.lit("")))), ""
    )
    return F.when(F.contains(text, F.lit("&")), F.replace(joined, F.lit("\u00a0"), F.lit(" "))).otherwise(text)


def element_text(fragment: Column) -> Column:
    """Visible text of an HTML fragment: tags dropped, entities decoded, trimmed."""
    text = decode_entities(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def extract_elements(
    pages: DataFrame,
    container: str,
    element: str,
    attribute: str,
    container_attrs: dict[str, str] | None = None,
    html: str = "html",
    keys: Iterable[str] = (),
) -> DataFrame:
    """Text and one attribute of every ``element`` in the first ``container`` of each page.

    Returns the key columns, ``position`` (from 0), ``text`` and ``value``; ``value`` is NULL
    where the element lacks the attribute. The end tag of an element may be missing.
    """
    keys = list(keys)
    found = _inside(_tokens(pages, html, keys, container), container, container_attrs)
    upto = Window.partitionBy("_page").orderBy("_pos")
    opens = (F.col("_tag") == element) & ~F.col("_closes")
    found = found.withColumn("_number", F.sum(opens.cast("int")).over(upto))
    # of the tags of that kind the last one tells whether a token is in an element
    state = F.last(F.when(F.col("_tag") == element, ~F.col("_closes")), ignorenulls=True).over(upto)
    found = found.withColumn("_in", state).filter("_in and _number > 0")
    tag = F.max(F.when(opens, F.col("_token"))).alias("_element")
    out = _text_of(found, ["_number"], [tag, F.first("_keys").alias("_keys")])
    return out.select(
        *[F.col(f"_keys.{k}").alias(k) for k in keys],
        (F.col("_number") - 1).cast("int").alias("position"),
        element_text(F.col("_text")).alias("text"),
        _attribute(F.col("_element"), attribute).alias("value"),
    )


def _spans(text: str | None, most: int) -> int:
    digits = re.match(r"\s*\+?([0-9]{1,9})", text or "")
    return min(int(digits[1]), most) if digits else 1


def spread_cells(cells: list[tuple[int, str, str | None, str | None]]) -> list[list[str | None]]:
    """Rows of a table whose cells (row, text, rowspan, colspan; in order) are repeated over what they span.

    A cell takes the first place of its row that no cell from above holds. A rowspan of 0 reaches
    the last row; spans end with the table.
    """
    n = max((row for row, *_ in cells), default=-1) + 1
    out: list[list[str | None]] = [[] for _ in range(n)]
    held: dict[int, tuple[int, str]] = {}  # column: rows it is still held for, and by which text
    at = 0
    for row in range(n):
        line = {column: text for column, (_, text) in held.items()}
        held = {column: (left - 1, text) for column, (left, text) in held.items() if left > 1}
        free = 0
        while at < len(cells) and cells[at][0] == row:
            _, text, rows, columns = cells[at]
            at += 1
            down = _spans(rows, MAX_ROWSPAN) or n - row
            while free in line:
                free += 1
            for _ in range(_spans(columns, MAX_COLSPAN) or 1):
                if free in line:
                    break
                line[free] = text
                if down > 1:
                    held[free] = (down - 1, text)
                free += 1
        out[row] = [line.get(c) for c in range(max(line, default=-1) + 1)]
    return out


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _spread(tables: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in tables:
        grids = [spread_cells([tuple(c.values()) for c in cells]) for cells in batch.to_pylist()]
        yield pa.array(grids, pa.list_(pa.list_(pa.string())))


def extract_table(
    pages: DataFrame,
    columns: Iterable[str],
    table_attrs: dict[str, str] | None = None,
    html: str = "html",
    keys: Iterable[str] = (),
) -> DataFrame:
    """Rows of the first matching ``<table>`` of each page, one column per listed header.

    The first row is the header; its cells are turned into snake_case, repeated ones with the
    suffixes _2, _3, ..., and matched with ``columns``. A cell that spans rows or columns counts in each of them; a
    table inside a cell is part of its text. End tags of rows and cells may be missing. A listed header that the
    page lacks, or a short row, gives NULL. Returns the key columns, ``position`` (from 0, header not counted) and the
    listed columns.
    """
    keys = list(keys)
    found = _inside(_tokens(pages, html, keys, "table"), "table", table_attrs)
    upto = Window.partitionBy("_page").orderBy("_pos")
    own, tag = F.col("_level") == 0, F.col("_tag")
    is_cell = own & tag.isin("td", "th")
    found = found.withColumns(
        {
            "_row": F.sum((own & (tag == "tr") & ~F.col("_closes")).cast("int")).over(upto),
            "_cell": F.sum((is_cell & ~F.col("_closes")).cast("int")).over(upto),
            # the last tag of the table's own rows and cells tells whether a token is in a cell
            "_in": F.last(F.when(is_cell, ~F.col("_closes")).when(own & (tag == "tr"), F.lit(False)), ignorenulls=True).over(upto),
        }
    )
    opens = F.max(F.when(is_cell & ~F.col("_closes"), F.col("_token"))).alias("_open")
    cells = _text_of(
        found.filter("_in and _row > 0"), ["_row", "_cell"], [opens, F.first("_keys").alias("_keys")]
    )
    cell_of = F.struct(
        (F.col("_row") - 1).alias("row"), F.col("_text").alias("text"),
        _attribute(F.col("_open"), "rowspan").alias("rowspan"), _attribute(F.col("_open"), "colspan").alias("colspan"),
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_cell", cell_of.alias("c")))), lambda x: x["c"])
    tables = cells.groupBy("_page").agg(F.first("_keys").alias("_keys"), ordered.alias("_table"))
    rows = tables.select(*[F.col(f"_keys.{k}").alias(k) for k in keys], _spread("_table").alias("_rows"))
    titles = F.transform(F.get(F.col("_rows"), F.lit(0)), lambda c: snake_case_column(element_text(c)))

    def numbered(title: Column, i: Column) -> Column:
        times = F.size(F.filter(F.slice("_titles", F.lit(1), i + 1), lambda x: x == title))
        return F.when(times > 1, F.concat(title, F.lit("_"), times.cast("string"))).otherwise(title)

    body = F.slice(F.col("_rows"), F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0)))
    out = (
        rows.select(*keys, "_rows", titles.alias("_titles"))  # once per page, not per row
        .select(*keys, "_rows", F.transform("_titles", numbered).alias("_titles"))
        .select(*keys, "_titles", F.posexplode(body).alias("position", "_cells"))
    )

    def cell(name: str) -> Column:
        at = F.array_position("_titles", F.lit(name)).cast("int")
        return F.when(at > 0, element_text(F.get(F.col("_cells"), at - 1))).alias(name)

    return out.select(*keys, "position", *[cell(c) for c in columns])


def drop_pager_rows(table: DataFrame, column: str = "reporter", marker: str = "1") -> DataFrame:
    """Drop the page-number row; rows without a value are dropped with it."""
    return table.filter(F.col(column) != marker)


def split_ids(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """Distinct integers in a column of separated lists; parts that are no integer are dropped."""
    part = F.explode(F.split(F.col(column), sep)).alias("_part")
    return (
        df.select(part)
        .select(F.trim("_part").try_cast("int").alias("id"))
        .filter(F.col("id").isNotNull())
        .distinct()
    )
