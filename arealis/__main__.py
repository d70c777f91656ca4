"""Command line of the batch runs: ``python -m arealis <step> --data <folder> …``."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from arealis.plans import batch
from arealis.presets import layout
from arealis.session import get_spark


def under(folder: str, path: str) -> str:
    return f"{folder.rstrip('/')}/{path}"


def clean(spark: SparkSession, data: str, years: list[str]) -> None:
    """Clean the landed sheets, and report missing dates per year and what failed."""
    at = partial(under, data)
    outcomes = batch.clean_and_count(spark, years, at(layout.RAW_SHEETS), at(layout.CLEAN_SHEETS))
    counts = "total long, total_null long, total_empty long"
    batch.outcome_table(spark, outcomes, counts).orderBy("item").show(len(years), truncate=False)
    if failures := [outcome.error for outcome in outcomes if outcome.error]:
        raise ExceptionGroup("some years failed", failures)


def split(spark: SparkSession, data: str, years: list[str]) -> None:
    """Split the cleaned sheets by quarter, for the map tool."""
    at = partial(under, data)
    batch.split_years(spark, years, at(layout.CLEAN_SHEETS), at(layout.QUARTER_FOLDERS))


def curate(spark: SparkSession, data: str, years: list[str]) -> None:
    """Gather the located quarter files into the partitioned table; quarters whose files are as before stay."""
    at = partial(under, data)
    changed, gone = batch.curate_changed(spark, at(layout.LOCATED_QUARTERS), years, at(layout.CURATED))
    print(f"rewritten: {', '.join(changed) or 'none'}; dropped: {', '.join(gone) or 'none'}")


def census(spark: SparkSession, data: str, levels: list[str]) -> None:
    """Build the census tables of the given levels."""
    paths = {
        level: {name: under(data, path) for name, path in files.items()}
        for level, files in layout.CENSUS_FILES.items()
    }
    batch.build_levels(spark, levels, paths, under(data, layout.CENSUS))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="arealis")
    steps = parser.add_subparsers(dest="step", required=True)
    for step in (clean, split, curate, census):
        command = steps.add_parser(step.__name__, help=step.__doc__)
        command.set_defaults(run=step)
        command.add_argument("--data", required=True, help="data folder, on any file system")
        if step is census:
            command.add_argument("--levels", nargs="+", default=list(layout.CENSUS_FILES))
        else:
            command.add_argument("--years", nargs="+", required=True)
    options = vars(parser.parse_args(arguments))
    options.pop("step")
    options.pop("run")(get_spark(), **options)


if __name__ == "__main__":
    main()
