"""Append-only landing of complete snapshots, one stamped folder per extraction."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame


def stamped(name: str, extracted_at: datetime) -> str:
    return f"{name}.{extracted_at:%Y%m%d%H%M%S}"


def land_snapshot(
    df: DataFrame,
    raw: str,
    name: str,
    extracted_at: datetime,
    *,
    file_format: str = "json",
    **options,
) -> str:
    """Write one snapshot below ``raw`` as ``<name>.<stamp>/`` and never over an earlier one.

    The snapshot is written in parallel part files; the stamp in the folder name is its extraction time.
    """
    target = f"{raw}/{stamped(name, extracted_at)}"
    df.write.mode("errorifexists").format(file_format).options(**options).save(target)
    return target


# Writer options for tab-separated files that keep padding in headers and values.
TSV = {
    "sep": "\t",
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
}
