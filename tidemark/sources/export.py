"""CSV output: table exports, previews and landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import while_writing
from tidemark.sources.files import Files, scratch
from tidemark.spec import TableSpec


# Quotes are doubled, and outer blanks of a value are kept.
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_csv(spec: TableSpec, table: DataFrame, path: str) -> None:
    """Write a table's business columns as CSV with a header."""
    with while_writing(table.sparkSession):
        table.select(*spec.names).write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def preview(spark: SparkSession, spec: TableSpec, path: str, n: int = 5) -> DataFrame:
    """The first rows, by key, of a written CSV."""
    rows = (
        spark.read.schema(spec.landing_schema())
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return rows.orderBy(*spec.key).limit(n)


def write_landing(
    spec: TableSpec, frame: DataFrame, landing: str, label: str = "raw"
) -> list[str]:
    """Write a frame as landing files named ``<table>_<label>_<n>.csv`` and return their names."""
    parts = scratch(frame.sparkSession, "landing")
    export_csv(spec, frame, parts)
    return _moved(spec, frame, parts, landing, label)


def write_lines(spec: TableSpec, lines: DataFrame, landing: str, label: str) -> list[str]:
    """Write a frame's only column as the lines of landing files, its name as their header, as they are."""
    parts = scratch(lines.sparkSession, "landing")
    with while_writing(lines.sparkSession):
        lines.write.options(header="true", sep="\u0001", quote="\u0000").csv(parts)
    return _moved(spec, lines, parts, landing, label)


def _moved(spec: TableSpec, frame: DataFrame, parts: str, landing: str, label: str) -> list[str]:
    """Spark writes the parts; only their names are changed afterwards."""
    files = Files(frame.sparkSession)
    files.make_directory(landing)
    names = []
    for n, part in enumerate(p for p in files.names(parts) if p.endswith(".csv")):
        name = f"{spec.name}_{label}_{n}.csv"
        files.move(f"{parts}/{part}", f"{landing}/{name}")
        names.append(name)
    files.drop(parts)
    return names
