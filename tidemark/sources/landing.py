"""Landing files: discovery, routing and the all-text CSV scan."""

from __future__ import annotations

import re

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import moment
from tidemark.retail import RETAIL
from tidemark.spec import MALFORMED, Batch, TableSpec


def route(file_name: Col, specs: dict[str, TableSpec] = RETAIL) -> Col:
    """The table whose name a file's name starts with, the longest such name, or NULL."""
    longest_first = sorted(specs, key=lambda name: (-len(name), name))
    prefix = F.regexp_extract(file_name, f"^({'|'.join(map(re.escape, longest_first))})", 1)
    return F.nullif(prefix, F.lit(""))


#: What is known of a file without reading it.
FILE = T.StructType.fromJson(
    {"type": "struct", "fields": [
        {"name": n, "type": t, "nullable": True, "metadata": {}}
        for n, t in (("path", "string"), ("modificationTime", "timestamp"), ("length", "long"), ("content", "binary"))
    ]}
)
FOUND = {"pathGlobFilter": "*.csv"}


def discover(
    spark: SparkSession, landing: str, specs: dict[str, TableSpec] = RETAIL
) -> DataFrame:
    """Every CSV file of the landing folder with its size, time of change and table; contents are not read."""
    return described(spark.read.format("binaryFile").options(**FOUND).load(landing), specs)


def described(files: DataFrame, specs: dict[str, TableSpec] = RETAIL) -> DataFrame:
    """Names, sizes, times of change and tables of files; the column of their contents is left out."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        name.alias("file_name"), "path", "length", F.unix_millis("modificationTime").alias("modified")
    ).withColumn(
        "table_name", route(F.col("file_name"), specs)
    )


def routed_to(file_name: Col, name: str, specs: dict[str, TableSpec] = RETAIL) -> Col:
    """Whether a file whose name starts with a table's name is that table's: no longer name that starts alike claims it.

    The same answer as ``route`` gives, by comparing beginnings only, as it is asked for each line.
    """
    mine = file_name.startswith(name)
    for other in specs:
        if other != name and other.startswith(name):
            mine = mine & ~file_name.startswith(other)
    return mine


def unrouted(files: DataFrame) -> DataFrame:
    """Files no table claims. They are reported and left alone."""
    return files.filter(F.col("table_name").isNull())


def csv_options(spec: TableSpec, check_header: bool) -> dict[str, str]:
    """Reader options: quoted fields, doubled quotes, and a pattern for this table's files.

    Columns are taken by position. With ``check_header`` a header that disagrees is an error.
    """
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "enforceSchema": str(not check_header).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "pathGlobFilter": f"{spec.name}*.csv",
    }


def scan_schema(spec: TableSpec) -> T.StructType:
    return spec.landing_schema().add(MALFORMED, T.StringType())


def with_lineage(
    spec: TableSpec, lines: DataFrame, batch: Batch, specs: dict[str, TableSpec] = RETAIL
) -> DataFrame:
    """Add load time and source file. The file id is the run id and the file's name.

    Lines of files that are routed to another table, though their names start alike, are left out.
    """
    return lines.filter(routed_to(F.col("_metadata.file_name"), spec.name, specs)).select(
        *spec.names,
        MALFORMED,
        moment(batch.loaded_at).alias("created_at_bronze"),
        F.concat(F.lit(f"{batch.ingestion_id}/"), F.col("_metadata.file_name")).alias(
            "source_file_id"
        ),
    )


def scan(
    spark: SparkSession,
    spec: TableSpec,
    landing: str,
    batch: Batch,
    check_header: bool = True,
    specs: dict[str, TableSpec] = RETAIL,
    paths: list[str] | None = None,
) -> DataFrame:
    """All files of one table as one scan, in bronze shape. Empty fields are NULL, blanks stay.

    ``paths`` names the files to read; without them it is all that the folder holds for the table.
    """
    reader = spark.read.schema(scan_schema(spec)).options(**csv_options(spec, check_header))
    # Characters that file patterns give a meaning stand for themselves.
    lines = reader.csv([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths] if paths else landing)
    return with_lineage(spec, lines, batch, specs)
