"""Declared columns: headers by their spellings, strict casts, and what does not fit by reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

FAULTS = "_faults"
WHOLE = ("int", "bigint")


@dataclass(frozen=True)
class Field:
    """A column of the result: name, type, the headers it may stand under, whether a value must be
    there, and the range it must keep.  Texts are trimmed."""

    name: str
    kind: str = "string"
    spellings: tuple[str, ...] = ()
    required: bool = True
    low: int | None = None
    high: int | None = None


#: Headers of the dictionary of places.
DICTIONARY = (
    Field("autonomous_community_code", "int", ("CODAUTO",), low=1, high=19),
    Field("province_code", "int", ("CPRO",), low=1, high=52),
    Field("municipality_code", "bigint", ("CMUN",), low=0),
    Field("check_digit", "int", ("DC",), low=0, high=9),
    Field("municipality_name", "string", ("NOMBRE",)),
)


def _header_key(header: str) -> str:
    return " ".join(header.split()).casefold()


def source_columns(df: DataFrame, fields: tuple[Field, ...]) -> dict[str, str | None]:
    """The column of ``df`` for every field, by spelling in any case; a required one must be there,
    and no field may fit two columns."""
    found: dict[str, str | None] = {}
    for f in fields:
        wanted = {_header_key(s) for s in (f.name, *f.spellings)}
        fits = [c for c in df.columns if _header_key(c) in wanted]
        if len(fits) > 1 or (f.required and not fits):
            raise ValueError(f"{f.name}: {'columns ' + ', '.join(fits) if fits else 'no column'} for {sorted(wanted)}")
        found[f.name] = fits[0] if fits else None
    return found


def _typed(raw: Column, f: Field) -> tuple[Column, Column]:
    """The value of a cell, and why it has none that fits (null if it has)."""
    text = F.nullif(F.trim(F.regexp_replace(raw.cast("string"), r"^\s+|\s+$", "")), F.lit(""))
    if f.kind == "string":
        value, wrong = text, F.lit(False)
    else:
        # whole numbers may come as 28.0 from a sheet; nothing else is cut to fit
        plain = F.regexp_replace(text, r"\.0+$", "") if f.kind in WHOLE else text
        value = F.when(plain.rlike("^[+-]?[0-9]+$"), plain.try_cast(f.kind)) if f.kind in WHOLE else plain.try_cast(f.kind)
        wrong = text.isNotNull() & value.isNull()
    outside = F.lit(False)
    if f.low is not None:
        outside = outside | (value < f.low)
    if f.high is not None:
        outside = outside | (value > f.high)
    reason = F.when(wrong, F.lit(f"not_{f.kind}")).when(F.coalesce(outside, F.lit(False)), "out_of_range")
    if f.required:
        reason = F.when(text.isNull(), "missing").otherwise(reason)
    return value, reason


def typed(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Every row of ``df``: its other columns, the fields with their types, and ``_faults``, an array
    of (column_name, value, reason) for the values that do not fit (they are null)."""
    at = source_columns(df, fields)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in at.values()]
    values, faults = [], []
    for f in fields:
        raw = F.lit(None).cast("string") if at[f.name] is None else F.col(f"`{at[f.name]}`")
        value, reason = _typed(raw, f)
        values.append(F.when(reason.isNull(), value).alias(f.name))
        faults.append(F.when(reason.isNotNull(), F.struct(
            F.lit(f.name).alias("column_name"), raw.cast("string").alias("value"), reason.alias("reason"))))
    return df.select(*rest, *values, F.array_compact(F.array(*faults)).alias(FAULTS))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size(FAULTS) == 0).drop(FAULTS)


def rejects(rows: DataFrame, *identify: str) -> DataFrame:
    """A row per value that does not fit: the columns that identify its row, column_name, value, reason."""
    return rows.where(F.size(FAULTS) > 0).select(*identify, F.inline(FAULTS))


def reject_counts(rows: DataFrame) -> DataFrame:
    return rejects(rows).groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def load_strict(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """The typed rows, or an error with the counts per column and reason if any value does not fit."""
    rows = typed(df, fields)
    counts = reject_counts(rows).orderBy("column_name", "reason").collect()  # a few rows per field
    if counts:
        raise ValueError("values that do not fit: " + ", ".join(f"{r.column_name} {r.reason} {r.n}" for r in counts))
    return accepted(rows)
