"""Reading raw course files and tables by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schemas import RAW_FILES, struct
from cohortlens.sources.records import CsvLoad, read_csv_records


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with headers, every column as text, header names trimmed; cells may hold line breaks.

    A malformed record is an error, as in a bulk copy; ``records.read_csv_records`` has them in a table of their own.
    """
    return read_csv_records(spark, path).strict()


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file or folder of known shape; no inference pass over the data.

    Columns are matched by the header's names, so their order in the file is free; a column
    that is not in the file is absent from the result, as the default dialect expects.
    """
    text = read_text_table(spark, path)
    return text.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in struct(schema) if f.name in text.columns]
    )


def _read_if_present(spark: SparkSession, path: str) -> CsvLoad | None:
    try:
        return read_csv_records(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_raw_records(spark: SparkSession, folder: str) -> dict[str, CsvLoad]:
    """All raw tables of a folder as text, with their rejects; required files must exist, optional ones may not."""
    found = {
        table: _read_if_present(spark, f"{folder.rstrip('/')}/{file}")
        for table, (file, _) in RAW_FILES.items()
    }
    missing = [file for table, (file, required) in RAW_FILES.items() if required and found[table] is None]
    if missing:
        raise FileNotFoundError(f"required raw files missing in {folder}: {', '.join(missing)}")
    return {table: load for table, load in found.items() if load is not None}


def read_raw_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw tables of a folder as text; a malformed record is an error."""
    return {table: load.strict() for table, load in read_raw_records(spark, folder).items()}


def source_table(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """A table of a namespace by name."""
    return spark.table(f"`{namespace}`.`{table}`")


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, counted side by side in one job."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
