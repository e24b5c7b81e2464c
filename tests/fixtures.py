"""Small landed files with padding, duplicates, corrections, malformed and missing values."""

from __future__ import annotations

import json
from pathlib import Path

PAD = "        "


def write_tsv(path: Path, header: list[str], lines: list[list[str]]) -> None:
    path.write_text("\n".join("\t".join(line) for line in [header, *lines]) + "\n")


def observation_header() -> list[str]:
    return ["series_id" + PAD, "year", "period", "       value", "footnote_codes"]


def land_first(raw: Path, stamp: str = "20260814120000") -> None:
    bls, people = raw / "bls", raw / "people"
    bls.mkdir(parents=True)
    people.mkdir(parents=True)
    s1, s2, s3, s4, target = "S1", "S2", "S3", "S4", "PRS30006032"
    data = [
        [s1 + PAD, "2012", "Q01", "       1.5", ""],
        [s1 + PAD, "2012", "Q02", "       2.5", ""],
        [s1 + PAD, "2013", "Q01", "       4.0", "R"],
        [s1 + PAD, "2013", "Q05", "     900.0", ""],
        [s1 + PAD, "2013", "M01", "     900.0", ""],
        [s2 + PAD, "2014", "Q01", "       3.0", ""],
        [s2 + PAD, "2013", "Q01", "       3.0", ""],
        [s3 + PAD, "2013", "Q01", "         -", ""],
        [s3 + PAD, "2013", "Q02", "          ", ""],
        [s3 + PAD, "2014", "Q01", "       0.5", ""],
        [s4 + PAD, "2015", "Q04", "      -2.0", ""],
        [target + PAD, "1990", "Q01", "       0.1", ""],
        [target + PAD, "2013", "Q01", "       0.2", ""],
        [target + PAD, "2014", "Q01", "       0.3", ""],
        [target + PAD, "2014", "Q02", "       0.4", ""],
    ]
    write_tsv(bls / f"pr.data.1.AllData.{stamp}", observation_header(), data)
    write_tsv(
        bls / f"pr.series.{stamp}",
        ["series_id" + PAD, "sector_code", "class_code", "measure_code", "begin_year"],
        [
            [s1 + PAD, "01", "3", "02", "1990"],
            [s2 + PAD, "1", "3", "02", "1990"],
            [s3 + PAD, "01", "3", "99", "1990"],
            [target + PAD, "77", "3", "99", "1990"],
        ],
    )
    write_tsv(
        bls / f"pr.measure.{stamp}",
        ["measure_code", "measure_text", "display_level"],
        [["02", "Output per hour", "0"], ["2", "Wrong measure", "0"]],
    )
    write_tsv(
        bls / f"pr.sector.{stamp}",
        ["sector_code ", "sector_name", "display_level"],
        [["01", "Nonfarm", "0"], ["1", "One", "0"]],
    )
    snapshot(
        people / f"population.{stamp}.json",
        [
            record(2012, 100.0),
            record(2013, 110.0),
            record(2014, 130.0),
            record(2018, 150.0),
            record(2019, 900.0),
            record(2014, 7.0, "Elsewhere", "02000XX"),
            record(None, 1.0),
        ],
    )


def land_second(raw: Path, stamp: str = "20260815120000") -> None:
    """Repeats, corrects and repairs rows of the first landing; the snapshot has a further field."""
    write_tsv(
        raw / "bls" / f"pr.data.1.AllData.{stamp}",
        observation_header(),
        [
            ["S1" + PAD, "2012", "Q01", "       1.5", ""],
            ["S1" + PAD, "2012", "Q02", "      99.0", "C"],
            ["S3" + PAD, "2013", "Q01", "       2.5", ""],
        ],
    )
    records = [record(2013, 110.0), record(2014, 335.0), record(2015, 140.0)]
    for entry in records:
        entry["Margin"] = 0.5
    snapshot(raw / "people" / f"population.{stamp}.json", records, source="census")


def record(year, population, nation="United States", nation_id="01000US") -> dict:
    return {"Nation ID": nation_id, "Nation": nation, "Year": year, "Population": population}


def snapshot(path: Path, records, **extra) -> None:
    body = {"annotations": {}, "page": {}, "columns": ["Nation ID"], "data": records, **extra}
    path.write_text(json.dumps(body) + "\n")
