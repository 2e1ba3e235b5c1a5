"""Text keys, name normalisation, lenient parsing and source labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from comarca.functions import fixed_values as fv

NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` drops blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_key(c: Column) -> Column:
    """Join key of a name: blanks trimmed, upper case."""
    return F.upper(F.trim(c))


def normalize_name(c: Column, expand_abbreviations: bool = False,
                   fold_grave: bool = False) -> Column:
    """Comparable form of a place name: upper case, folded letters, single blanks."""
    source, target = fv.FOLD_FROM, fv.FOLD_TO
    if fold_grave:
        source, target = source + fv.FOLD_GRAVE_FROM, target + fv.FOLD_GRAVE_TO
    # "translate" drops letters without a partner, so the blanks at the end of
    # the target must stay: punctuation becomes a blank there
    name = F.translate(clean_key(c), source, target)
    name = F.trim(F.regexp_replace(name, r"\s+", " "))
    if expand_abbreviations:
        for short, full in fv.ABBREVIATIONS:
            name = F.regexp_replace(name, rf"\b{short}\s+", f"{full} ")
    return name


def parse_number(c: Column) -> Column:
    """Double, or null when the text is not a plain number."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def lenient_number(c: Column, drop_blanks: bool = False) -> Column:
    """Number of a sheet cell; suppressed marks (``<5``) are stripped, the rest is 0."""
    cleaned = F.regexp_replace(c, "[ <>]" if drop_blanks else "[<>]", "")
    return F.coalesce(parse_number(cleaned), F.lit(0.0))


def text_code(c: Column) -> Column:
    """Integer of a code kept as text, ``"01"`` or ``"2.0"``; half goes up."""
    return F.round(parse_number(c)).cast("bigint")


def local_code(c: Column, base: int) -> Column:
    """Code within the province of a national code; local codes pass through."""
    code = c.cast("bigint")
    return F.when(code >= base, code % F.lit(base)).otherwise(code)


def pad_code(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept (``lpad`` alone would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def label_key(c: Column) -> Column:
    """Label usable in file names: blanks and slashes to ``_``, no dots, upper case."""
    return F.upper(F.translate(c, " /.", "__"))


def clean_column_name(c: Column) -> Column:
    """Header text as a column name; null when nothing usable is left."""
    name = F.regexp_replace(F.lower(strip(c)), r"[ /\-]", "_")
    name = F.regexp_replace(name, r"[^\p{L}\p{N}_]", "")
    return (F.when(name == "", None)
             .when(name.rlike("^[0-9]"), F.concat(F.lit("col_"), name))
             .otherwise(name))


def canonical_header(c: Column, rules=None) -> Column:
    """Canonical column of a header spelling; other headers are only cleaned
    (all of them when ``rules`` is empty)."""
    text = F.lower(strip(c))

    def has(term: str) -> Column:
        return text.rlike(term[1:]) if term.startswith("~") else text.contains(term)

    ladder = None
    for name, any_of, all_of, none_of in fv.HEADER_RULES if rules is None else rules:
        hit = reduce(lambda a, b: a | b, [has(t) for t in any_of])
        for term in all_of:
            hit = hit & has(term)
        for term in none_of:
            hit = hit & ~has(term)
        ladder = F.when(hit, name) if ladder is None else ladder.when(hit, name)
    cleaned = clean_column_name(c)
    return cleaned if ladder is None else ladder.otherwise(cleaned)


def month_number(label: Column, year: Column) -> Column:
    """Month of a page identifier: name, else first 1-2 digits in 1..12, else 1."""
    text = F.lower(label)
    year_text = F.coalesce(year.cast("string"), F.lit("(no year)"))
    for before in (F.concat(F.lit("-"), year_text), year_text):
        text = F.replace(text, before, F.lit(""))
    named = None
    for number, name in enumerate(fv.MONTH_NAMES, start=1):
        hit = text.contains(name)
        named = F.when(hit, number) if named is None else named.when(hit, number)
    digits = F.regexp_extract(text, "([0-9]{1,2})", 1).try_cast("int")
    return F.coalesce(named, F.when(digits.between(1, 12), digits), F.lit(1))


def file_period(name: Column) -> tuple[Column, Column]:
    """(year, month) of ``2021_05_anything.xls``; nulls for other names."""
    pattern = r"^([0-9]+)_([0-9]+)([_.]|$)"
    return (F.regexp_extract(name, pattern, 1).try_cast("int"),
            F.regexp_extract(name, pattern, 2).try_cast("int"))


def two_digit_year(name: Column, prefix: str = "pobmun",
                   pivot: int = fv.FIRST_TWO_DIGIT_YEAR) -> Column:
    """Year of ``pobmun24`` or ``pobmun2024``; two digits from ``pivot`` mean 19xx."""
    digits = F.regexp_extract(name, rf"^{prefix}([0-9]{{4}}|[0-9]{{2}})([^0-9]|$)", 1)
    year = digits.try_cast("int")
    return (F.when(F.length(digits) == 4, year)
             .when(year >= pivot, year + 1900).otherwise(year + 2000))


def sheet_type_and_province(sheet: Column) -> tuple[Column, Column]:
    """(data type, province) of a sheet name; spellings are fixed before anything
    is filtered, and only whole labels are replaced."""
    name = _spelled(strip(sheet), fv.SHEET_SPELLINGS)
    pattern = f"^({'|'.join(fv.SHEET_PREFIXES)}) (.*)$"
    prefix = F.regexp_extract(name, pattern, 1)
    kind = (F.when(name.isin(fv.IGNORED_SHEETS), "ignored")
             .otherwise(_spelled(prefix, [*fv.SHEET_PREFIXES.items(), ("", "unknown")])))
    province = F.when(prefix == "", name).otherwise(strip(F.regexp_extract(name, pattern, 2)))
    return kind, _spelled(province, fv.SHEET_PROVINCES)


def _spelled(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Replace whole labels by a fixed list of spellings."""
    known = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.coalesce(F.try_element_at(known, c), c)


def heading_pattern() -> str:
    """Case-insensitive pattern of the heading words."""
    escaped = [w.replace(".", r"\.") for w in fv.HEADING_WORDS]
    return "(?iu)" + "|".join(escaped)
