"""Column expressions used to clean and label records. All run inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The greedy start makes it the last stamp: folders above may have stamps of their own.
EXTRACTION_STAMP = r"(?s)^.*[._](\d{8})T?(\d{6})(?=[._/]|$)"


def trimmed(source: str) -> Column:
    """Text without leading and trailing spaces. Tabs stay, as with SQL ``trim``."""
    return F.trim(F.col(source))


def safe_cast(source: str | Column, type_name: str) -> Column:
    """Cast that gives NULL for malformed input, so that a row expectation can drop and count it."""
    column = F.col(source) if isinstance(source, str) else source
    return column.try_cast(type_name)


def label(*parts: str, separator: str = " - ") -> Column:
    """Readable label from several columns; NULL parts are left out, no part at all gives ''."""
    return F.concat_ws(separator, *[F.col(part) for part in parts])


def extraction_time(file_name: str | Column) -> Column:
    """Extraction time held in a landed name: ``name.20260814120000`` or ``name_20260814T120000.json``.

    Works on file names and on whole paths, where the last stamp counts; NULL where there is no stamp.
    """
    column = F.col(file_name) if isinstance(file_name, str) else file_name
    day, time = (F.regexp_extract(column, EXTRACTION_STAMP, group) for group in (1, 2))

    def digits(text: Column, start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        digits(day, 1, 4), digits(day, 5, 2), digits(day, 7, 2),
        digits(time, 1, 2), digits(time, 3, 2), digits(time, 5, 2),
    )


def source_name(file_name: str | Column) -> Column:
    """The name a landed file has at its source: only the stamp, and what follows it, goes."""
    column = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.regexp_replace(column, r"[._]\d{8}T?\d{6}(?:\.\w+)?$", "")


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip white space around all column names; refuse when two names become the same."""
    names = [name.strip() for name in df.columns]
    folded = [name.lower() for name in names]
    clashing = sorted({name for name, key in zip(names, folded) if folded.count(key) > 1})
    if clashing:
        raise ValueError(f"column names are equal once trimmed: {clashing}")
    return df.toDF(*names)
