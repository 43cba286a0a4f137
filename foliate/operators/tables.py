"""Tables: parsing from markdown, HTML, delimited text and JSON rows, headers, renderings, and tables that span pages.

A parsed table is struct(headers array<string>, rows array<array<string>>); all of it is built from native functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.functions import ids
from foliate.functions.text import strip

_ROWS = "array<array<string>>"


def _squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def is_numeric(c: Column) -> Column:
    """A number once commas and percent signs are left out."""
    t = strip(F.regexp_replace(c, "[,%]", ""))
    return t.rlike(r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?(?:e[+-]?\d+)?|\.\d+(?:_\d+)*(?:e[+-]?\d+)?|inf|infinity|nan)$")


def looks_like_header(row: Column) -> Column:
    """At most half of the filled cells are numbers and they have 60 characters or fewer on average."""
    filled = F.filter(row, lambda c: strip(c) != "")
    n = F.size(filled)
    numbers = F.size(F.filter(filled, lambda c: is_numeric(strip(c))))
    length = F.aggregate(filled, F.lit(0), lambda a, c: a + F.length(c))
    return F.coalesce((n > 0) & (numbers <= F.floor(n / 2)) & (length <= 60 * n), F.lit(False))


def _table(rows: Column, headers: Column) -> Column:
    return F.struct(headers.cast("array<string>").alias("headers"), rows.cast(_ROWS).alias("rows"))


def _guess(rows: Column) -> Column:
    """The first row as headers if it looks like it and others follow."""
    return F.when(
        (F.size(rows) > 1) & looks_like_header(F.get(rows, F.lit(0))),
        _table(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), F.get(rows, F.lit(0))),
    ).when(F.size(rows) > 0, _table(rows, F.array()))


def from_markdown(c: Column) -> Column:
    """The first run of lines with pipes: headers, a line that is skipped, rows (blank ones left out)."""
    lines = F.transform(F.split(strip(c), "\n"), strip)
    first = F.array_position(F.transform(lines, lambda x: x.contains("|")), F.lit(True))
    rest = F.when(first > 0, F.slice(lines, first.cast("int"), F.size(lines)))
    end = F.array_position(F.transform(rest, lambda x: x.contains("|")), F.lit(False))
    run = F.when(end > 0, F.slice(rest, 1, (end - 1).cast("int"))).otherwise(rest)
    cells = F.transform(run, lambda x: F.transform(F.split(F.regexp_replace(F.regexp_replace(x, r"^\|", ""), r"\|$", ""), r"\|", -1), _squeeze))
    rows = F.filter(F.slice(cells, 3, F.greatest(F.size(cells) - 2, F.lit(0))), lambda r: F.exists(r, lambda x: x != ""))
    return F.when(F.size(cells) >= 2, _table(rows, F.get(cells, F.lit(0))))


def from_html(c: Column) -> Column:
    """Rows of td and th cells, tags inside cells left out, white space squeezed; headers are guessed."""
    parts = F.regexp_extract_all(c, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr|<tr\b|</table|\z)"), 1)
    rows = F.transform(
        parts,
        lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), 1), lambda x: _squeeze(F.regexp_replace(x, "<[^>]*>", ""))),
    )
    return _guess(F.filter(rows, lambda r: F.size(r) > 0))


def from_text(c: Column) -> Column:
    """Lines with tabs, if there are two or more, else lines with runs of two spaces; headers are guessed."""
    lines = F.split(strip(c), "\n")
    tabs = F.filter(F.transform(F.filter(lines, lambda x: x.contains("\t")), lambda x: F.transform(F.split(x, "\t", -1), strip)), lambda r: F.size(r) >= 2)
    gaps = F.filter(F.transform(lines, lambda x: F.filter(F.transform(F.split(strip(x), r"(?U)\s{2,}", -1), strip), lambda y: y != "")), lambda r: F.size(r) >= 2)
    return F.when(F.size(lines) >= 2, F.when(F.size(tabs) >= 2, _guess(tabs)).when(F.size(gaps) >= 2, _guess(gaps)))


def from_json(c: Column) -> Column:
    """A list of rows, itself or as "rows" or "data" of an object, or an object of columns.

    Rows are objects, whose headers are the first one's keys, or lists, which have no headers. Columns are lists; shorter ones are filled with
    empty cells. Without a list of something as the first column there is no table.
    """
    data = F.coalesce(F.get_json_object(c, "$.rows"), F.get_json_object(c, "$.data"), strip(c))
    first = F.get(F.from_json(F.when(data.startswith("["), data), "array<string>"), F.lit(0))
    objects = F.from_json(F.when(first.startswith("{"), data), "array<map<string,string>>")
    keys = F.map_keys(F.get(objects, F.lit(0)))
    filled = F.transform(objects, lambda r: F.transform(keys, lambda k: F.coalesce(F.try_element_at(r, k), F.lit(""))))
    lists = F.transform(F.from_json(F.when(first.startswith("["), data), _ROWS), lambda r: F.transform(r, lambda x: F.coalesce(x, F.lit(""))))
    columns = F.from_json(F.when(data.startswith("{"), data), "map<string,string>")
    cells = F.transform(F.map_values(columns), lambda v: F.coalesce(F.from_json(F.when(v.startswith("["), v), "array<string>"), F.array().cast("array<string>")))
    length = F.array_max(F.transform(cells, F.size))
    across = F.transform(F.sequence(F.lit(0), F.greatest(length, F.lit(1)) - 1), lambda i: F.transform(cells, lambda x: F.coalesce(F.get(x, i), F.lit(""))))
    return (
        F.when(F.size(objects) > 0, _table(filled, keys)).when(F.size(lists) > 0, _table(lists, F.array()))
        .when(F.size(F.get(cells, F.lit(0))) > 0, _table(across, F.map_keys(columns)))
    )


def to_markdown(t: Column) -> Column:
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    dashes = lambda cells: line(F.transform(cells, lambda _: F.lit("---")))
    has = F.size(t["headers"]) > 0
    top = F.when(has, t["headers"]).otherwise(F.get(t["rows"], F.lit(0)))
    rest = F.when(has, t["rows"]).otherwise(F.slice(t["rows"], 2, F.greatest(F.size(t["rows"]) - 1, F.lit(0))))
    body = F.array_join(F.concat(F.array(line(top), dashes(top)), F.transform(rest, line)), "\n")
    return F.when(has | (F.size(t["rows"]) > 0), body).otherwise(F.lit(""))


def to_html(t: Column) -> Column:
    row = lambda cells, tag: F.concat(F.lit("    <tr>"), F.array_join(F.transform(cells, lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    has, n = F.size(t["headers"]) > 0, F.size(t["rows"])
    head = F.when(has, F.array(F.lit("  <thead>"), row(t["headers"], "th"), F.lit("  </thead>"))).otherwise(F.array().cast("array<string>"))
    rows = F.when(has | (n <= 1), t["rows"]).otherwise(F.slice(t["rows"], 2, F.greatest(n - 1, F.lit(0))))
    parts = F.concat(
        F.array(F.lit("<table>")), head, F.array(F.lit("  <tbody>")), F.transform(rows, lambda r: row(r, "td")),
        F.array(F.lit("  </tbody>"), F.lit("</table>")),
    )
    return F.when(has | (n > 0), F.array_join(parts, "\n")).otherwise(F.lit(""))


def summary(existing: Column, headers: Column, rows: Column, columns: Column) -> Column:
    """What a table holds, after a summary that it has already; at most five headers."""
    names = F.concat(F.array_join(F.slice(headers, 1, 5), ", "), F.when(F.size(headers) > 5, F.lit(", ...")).otherwise(F.lit("")))
    text = F.concat(
        F.lit("Table with "), rows.cast("string"), F.lit(" row(s) and "), columns.cast("string"), F.lit(" column(s)"),
        F.when(F.size(headers) > 0, F.concat(F.lit(", headers: ["), names, F.lit("]"))).otherwise(F.lit("")),
    )
    own = strip(F.coalesce(existing, F.lit("")))
    return F.when((own != "") & ~own.startswith("Table showing"), F.concat(own, F.lit(". "), text)).otherwise(text)


def enrich(tables: DataFrame) -> DataFrame:
    """tables(json_data, html, markdown, content, summary, headers) with rows, headers, counts and renderings from the best source
    there is, in this order. A table without headers takes its first row if that looks like headers, else Column 1 and so on."""
    have = lambda c, f: f(F.col(c)) if c in tables.columns else F.lit(None)
    found = F.coalesce(
        *[have(c, f) for c, f in (("json_data", from_json), ("html", from_html), ("markdown", from_markdown), ("content", from_text)) if c in tables.columns]
    )
    out = tables.withColumn("__t", found)
    old = F.col("headers") if "headers" in tables.columns else F.array().cast("array<string>")
    headers = F.when(F.size(F.col("__t.headers")) > 0, F.col("__t.headers")).otherwise(old)
    rows = F.coalesce(F.col("__t.rows"), F.array().cast(_ROWS))
    take = (F.size(headers) == 0) & (F.size(rows) > 0)
    guess = take & looks_like_header(F.get(rows, F.lit(0)))
    width = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
    numbered = F.transform(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), lambda i: F.concat(F.lit("Column "), i.cast("string")))
    out = out.withColumns(
        {
            "headers": F.when(guess, F.get(rows, F.lit(0))).when(take, numbered).otherwise(F.coalesce(headers, F.array().cast("array<string>"))),
            "rows": F.when(guess, F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))).otherwise(rows),
        }
    )
    out = out.withColumns({"row_count": F.size("rows"), "col_count": F.size("headers"), "__r": F.struct("headers", "rows")})
    text = F.col("summary") if "summary" in tables.columns else F.lit("")
    return out.withColumns(
        {"markdown": to_markdown(F.col("__r")), "html": to_html(F.col("__r")), "summary": summary(text, F.col("headers"), F.col("row_count"), F.col("col_count"))}
    ).drop("__t", "__r")


def header_signature(headers: Column) -> Column:
    """A key of 12 hexadecimal digits: trimmed lower-case headers, blank ones left out."""
    names = F.filter(F.transform(headers, lambda h: strip(F.lower(h))), lambda h: h != "")
    return F.substring(F.md5(F.array_join(names, "|")), 1, 12)


def spanning(tables: DataFrame, gap: int = 2) -> DataFrame:
    """tables with is_spanning and span_group_id: two or more of a document, section, width and headers, on pages at most gap apart."""
    key = ["doc_id", "section_path", "col_count", "__sig"]
    signed = tables.withColumn("__sig", header_signature(F.col("headers")))
    w = Window.partitionBy(*key).orderBy("page_num", "reading_order", "element_id")
    step = F.coalesce((F.col("page_num") - F.lag("page_num").over(w) > gap).cast("int"), F.lit(0))
    runs = signed.withColumn("__step", step).withColumn("__run", F.sum("__step").over(w))
    r = Window.partitionBy(*key, "__run")
    group = ids.span_group_id(F.col("doc_id"), F.col("section_path"), F.min("page_num").over(r), F.col("col_count"), F.col("__sig"))
    many = F.count("*").over(r) >= 2
    return runs.withColumns({"is_spanning": many, "span_group_id": F.when(many, group)}).drop("__sig", "__step", "__run")
