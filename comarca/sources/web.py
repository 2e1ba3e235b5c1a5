"""Links and tables of pages that were fetched before (page_id, url, html)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions.text import strip

#: What stands between the angle brackets of a tag: quoted attribute values may hold any of them.
#: All loops are possessive, so they neither recurse nor go back.
INSIDE = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
#: What is no markup of the page: comment, declaration, script or style with its content.
ASIDE = r"<!--.*?(?:-->|\z)|<[!?][^>]*+>|<(?:script|style)\b" + INSIDE + r">.*?(?:</(?:script|style)\s*+>|\z)"
#: A page as tokens: aside, tag, text, stray bracket.
TOKEN = "(?is)" + ASIDE + "|</?[a-z]" + INSIDE + ">|[^<]++|<"
#: What stands behind the tag of the first table.
FIRST_TABLE = ("(?is)^(?:" + ASIDE + r"|(?!<table\b)</?[a-z]" + INSIDE + r">|[^<]++|(?!<table\b" + INSIDE + r">)<)*+<table\b"
               + INSIDE + ">(.*+)$")
#: Asides and tags that are not those of a table, and the tags that are.
NO_TABLE = "(?is)" + ASIDE + r"|<(?!/?(?:table|t[rdh])\b)/?[a-z]" + INSIDE + ">"
TABLE_TAG = r"(?i)</?(?:table|t[rdh])\b" + INSIDE + ">"
#: A tag with the value of its attribute href, in double quotes, in single quotes or bare.
HREF = (r"""(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!href\s*+=)[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
        r"""[\s/]++href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""")
#: Marks in the text of a table: both ends of a tag, row, end of a cell.
TAG, ROW, END = "\ufdd0", "\ufdd1", "\ufdd2"
#: Columns that one cell may span.
MOST_SPANNED = 1000


def page_tokens(html: Column) -> Column:
    """Comments, tags and texts of a page in their order."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def _references() -> Column:
    """Named references and what they stand for; numbers that old pages take from Windows-1252."""
    known = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'",
             **{str(n): bytes([n]).decode("cp1252", errors="replace") for n in range(0x80, 0xA0)}}
    # a literal after constant folding
    return F.str_to_map(F.lit(TAG.join(f"{k}{ROW}{v}" for k, v in known.items())), F.lit(TAG), F.lit(ROW))


def decode_entities(text: Column) -> Column:
    """Named character references of HTML 4 and all decimal and hexadecimal ones."""
    known = _references()

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, "^&#?([0-9a-zA-Z]+);?$", 1)
        hexed = part.rlike("^&#[xX]")
        number = F.when(hexed, F.conv(F.substr(name, F.lit(2)), 16, 10)).otherwise(name).try_cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        code = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        numeric = F.when(number.between(0x80, 0x9F), F.try_element_at(known, number.cast("string"))).when(valid, code)
        return (F.when(part.startswith("&#"), F.coalesce(numeric, F.lit("\ufffd")))
                 .when(name != "", F.coalesce(F.try_element_at(known, name), part)).otherwise(part))

    parts = F.regexp_extract_all(
        text, F.lit(r"(?s)&(?:#[0-9]{1,8};?|#[xX][0-9a-fA-F]{1,8};?|[a-zA-Z][a-zA-Z0-9]{1,31};)|[^&]++|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(text)


def _address(raw: Column) -> Column:
    return decode_entities(F.trim(F.regexp_replace(raw, r"""^["']|["']$""", "")))


def _addresses(tokens: Column) -> Column:
    """Addresses of the tags among ``tokens``, in their order."""
    found = F.transform(F.filter(tokens, lambda t: t.rlike("^<[a-zA-Z]") & F.contains(F.lower(t), F.lit("href"))),
                        lambda t: F.regexp_extract(t, HREF, 1))
    return F.transform(F.filter(found, lambda a: a != ""), _address)


def _first(addresses: Column, pattern: str) -> Column:
    """First address that the pattern occurs in, null without one."""
    return F.get(F.filter(addresses, lambda a: a.rlike(pattern)), F.lit(0))


def absolute(base: str, href: Column) -> Column:
    """Address of a link on a site."""
    return (F.when(href.rlike("^https?://"), href)
             .when(href.startswith("/"), F.concat(F.lit(base.rstrip("/")), href))
             .otherwise(F.concat(F.lit(base.rstrip("/") + "/"), href)))


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page; addresses in comments, scripts and other attributes are none."""
    # an outer explode: Spark would push a test for empty arrays below it and read every page twice
    found = pages.select("page_id", F.explode_outer(_addresses(page_tokens(F.col("html")))).alias("href"))
    return found.where("href is not null")


def links_by_year(pages: DataFrame, prefix: str, base: str = "") -> DataFrame:
    """Distinct links below ``prefix`` whose path has a four-digit year."""
    path = F.substr("href", F.lit(len(prefix) + 1))
    year = F.regexp_extract(path, r"([0-9]{4})", 1)
    identifier = F.replace(F.element_at(F.split("href", "/"), -1), F.lit(".html"), F.lit(""))
    return (page_links(pages).where(F.col("href").startswith(prefix) & (year != ""))
            .select(year.cast("int").alias("link_year"), identifier.alias("identifier"),
                    absolute(base, F.col("href")).alias("url"))
            .distinct())


def latest_link(links: DataFrame) -> DataFrame:
    """Last identifier of the last year."""
    newest = F.max(F.struct("link_year", "identifier", "url")).alias("m")
    return links.agg(newest).select("m.*")


def pick_attachment(pages: DataFrame, marker: str, extension: str = "xls",
                    base: str = "") -> DataFrame:
    """Attachment of a page: first link after the marker in its text, else the first link
    that ends in the extension, else null."""
    tokens = F.col("_tokens")
    texts = F.transform(tokens, lambda t: ~t.startswith("<") & F.contains(F.lower(t), F.lit(marker.lower())))
    at = F.array_position(texts, True)
    near = F.when(at > 0, _first(_addresses(F.slice(tokens, at.cast("int") + 1, F.size(tokens))), rf"(?i)\.{extension}"))
    ending = _first(_addresses(tokens), rf"\.(?:{extension}|{extension}x)$")
    rule = (F.when(F.col("near").isNotNull(), "after_marker").when(F.col("ending").isNotNull(), "first_link")
             .otherwise("none"))
    return (pages.select("page_id", "url", page_tokens(F.col("html")).alias("_tokens"))
            .select("page_id", "url", near.alias("near"), ending.alias("ending"))
            .select("page_id", "url", absolute(base, F.coalesce("near", "ending")).alias("attachment_url"),
                    rule.alias("rule")))


def _flattened(parts: Column) -> Column:
    """Text of a table that holds tables, from the pieces between table tags: of the inner tables
    only the text is left (it stays in the cell), and nothing of what follows the table."""
    def step(state: Column, part: Column) -> Column:
        turn = F.when(part.startswith("</"), -1).when(part.startswith("<"), 1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + turn).otherwise(0)
        text = F.regexp_replace(part, f"^</?[a-zA-Z][^{TAG}]*+{TAG}", " ")
        said = F.when(depth == 1, text).when(depth > 1, F.regexp_replace(text, f"{TAG}[^{TAG}]*+{TAG}", " "))
        return F.struct(depth.alias("depth"), F.when(said.isNull(), state["said"]).otherwise(
            F.concat(state["said"], F.array(said))).alias("said"))

    start = F.struct(F.lit(1).alias("depth"), F.array().cast("array<string>").alias("said"))
    return F.aggregate(parts, start, step, lambda s: F.array_join(s["said"], ""))


def _first_tables(pages: DataFrame) -> DataFrame:
    """(page_id, text): the first table, up to the end tag that belongs to it or the end of the page,
    as a text with marks for rows, cells (their tag between two marks) and ends of cells."""
    rest = F.regexp_extract("html", FIRST_TABLE, 1)
    wrapped = F.regexp_replace(F.regexp_replace("rest", NO_TABLE, ""), TABLE_TAG, f"{TAG}$0{TAG}")
    # a tag in an attribute of a tag stands between no marks of its own
    parts = F.split("wrapped", f"(?i){TAG}(?=</?table\\b)", -1)
    flat = (F.size("parts") == 1) | F.col("parts")[1].startswith("</")
    marked = F.regexp_replace(F.regexp_replace("text", f"(?i){TAG}</?tr\\b[^{TAG}]*+{TAG}", ROW),
                              f"(?i){TAG}</t[dh]\\b[^{TAG}]*+{TAG}", END)
    return (pages.select("page_id", rest.alias("rest")).select("page_id", wrapped.alias("wrapped"))
            .select("page_id", parts.alias("parts"))
            .select("page_id", F.when(flat, F.col("parts")[0]).otherwise(_flattened(F.col("parts"))).alias("text"))
            .select("page_id", marked.alias("text")))


def _cells_of_row(row: Column) -> Column:
    """Texts of the cells of a marked row; a cell that spans columns stands in each of them."""
    parts = F.split(row, TAG, -1)  # before the first cell, then tag and text by turns
    texts = F.transform(F.filter(parts, lambda p, i: (i > 0) & (i % 2 == 0)),
                        lambda t: strip(decode_entities(F.substring_index(t, END, 1))))

    def span(tag: Column) -> Column:
        said = F.regexp_extract(tag, r"""(?i)\scolspan\s*+=\s*+["']?+\s*+([0-9]{1,4})""", 1).try_cast("int")
        return F.when(F.contains(F.lower(tag), F.lit("colspan")), F.least(
            F.greatest(F.coalesce(said, F.lit(1)), F.lit(1)), F.lit(MOST_SPANNED))).otherwise(1)

    spans = F.transform(F.filter(parts, lambda p, i: i % 2 == 1), span)
    return F.when(F.contains(F.lower(row), F.lit("colspan")),
                  F.flatten(F.zip_with(texts, spans, F.array_repeat))).otherwise(texts)


def html_table_rows(pages: DataFrame) -> DataFrame:
    """First table of every page: (page_id, row_no, col_no, header, value).

    A row begins at its tag, a cell ends at its end tag or where the next begins, the table at
    its end tag or with the page; rows without cells do not count.
    """
    filled = F.filter(F.transform(F.split("text", ROW), _cells_of_row), lambda row: F.size(row) > 0)
    grid = _first_tables(pages).select("page_id", filled.alias("t"))
    # outer explodes, as in page_links; a first row alone gives nothing
    body = grid.select("page_id", F.get(F.col("t"), F.lit(0)).alias("head"),
                       F.posexplode_outer("t").alias("row_no", "row")).where(F.col("row_no") > 0)
    return (body.select("page_id", "row_no", "head", F.posexplode_outer("row").alias("col_no", "value"))
            .where("col_no is not null")
            .select("page_id", "row_no", "col_no",
                    F.get(F.col("head"), F.col("col_no")).alias("header"), "value"))
