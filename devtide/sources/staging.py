"""Classified records, the quarantine and the staging tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import check
from ..operators.flatten import flat_rows
from ..schemas import STAGED, conform, ddl
from .files import Files
from .landing import json_lines

#: Compression of the typed rows of a run: a third smaller than Spark's default, at the same CPU.
ROWS_AS = "zstd"


def classified_rows(raw: DataFrame, entity: str) -> DataFrame:
    """Check and flatten in one pass; payload text is kept for invalid records only."""
    bad = F.size("problems") > 0
    line = F.col("_corrupt_record") if "_corrupt_record" in raw.columns else F.lit(None)
    checked, values = check(raw, entity)
    kept = checked.withColumns(
        {
            "ok": ~bad,
            "payload": F.when(bad, F.to_json("data")),
            "line": F.when(bad, line.cast("string")),
        }
    )
    instants = {path: value.instant for path, value in values.items()}
    return flat_rows(
        kept, entity, "ok", "repository", "problems", "payload", "line", parsed=instants
    )


def classified_path(root: str, run_id: str, entity: str) -> str:
    return f"{root}/classified/run={run_id}/entity={entity}"


def write_classified(raw: DataFrame, root: str, run_id: str, entity: str) -> None:
    """The only place where the JSON of a run is parsed. Valid and invalid records lie in the same
    files, told apart by a column: folders for both would have every task sort its rows."""
    writer = classified_rows(raw, entity).write.mode("overwrite").option("compression", ROWS_AS)
    writer.parquet(classified_path(root, run_id, entity))


def read_classified(spark: SparkSession, root: str, run_id: str, entity: str) -> DataFrame:
    layout = (
        "repository string, problems array<string>, payload string, line string, "
        "_slug string, _seq bigint, "
    )
    if entity != "repositories":
        person = (
            "contributor_nk:string,github_user_id:bigint,login:string,"
            "display_name:string,user_type:string,is_bot:boolean"
        )
        layout += f"people array<struct<{person}>>, "
    layout += ddl(STAGED[entity]) + ", ok boolean"
    return spark.read.schema(layout).parquet(classified_path(root, run_id, entity))


def quarantine_rows(classified: DataFrame) -> DataFrame:
    """Invalid records as they are kept for inspection."""
    return classified.filter(~F.col("ok")).select(
        "repository", "problems", F.parse_json("payload").alias("data"), "line"
    )


def clear_quarantine(spark: SparkSession, root: str, run_id: str) -> None:
    """Nothing of an earlier attempt at a run stays in quarantine."""
    Files(spark, root).delete(f"{root}/quarantine/run_id={run_id}")


def write_quarantine(rows: DataFrame, root: str, run_id: str, entity: str) -> None:
    path = f"{root}/quarantine/run_id={run_id}/entity={entity}"
    json_lines(rows.hint("rebalance"), path)


def read_quarantine(spark: SparkSession, root: str, run_id: str, entity: str) -> DataFrame:
    schema = "repository string, problems array<string>, data variant, line string"
    path = f"{root}/quarantine/run_id={run_id}/entity={entity}"
    if not Files(spark, root).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def staged_path(root: str, run_id: str, table: str) -> str:
    return f"{root}/staged/run={run_id}/{table}"


def write_staged(df: DataFrame, root: str, run_id: str, table: str) -> int:
    """Replace a staging table of a run; returns its row count, taken while writing."""
    seen = Observation()
    counted = conform(df, STAGED[table]).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite").option("compression", ROWS_AS)
    writer.parquet(staged_path(root, run_id, table))
    return seen.get["rows"]


def read_staged(spark: SparkSession, root: str, run_id: str) -> dict[str, DataFrame]:
    return {
        table: spark.read.schema(ddl(layout)).parquet(staged_path(root, run_id, table))
        for table, layout in STAGED.items()
    }


def register_staged(staged: dict[str, DataFrame], prefix: str = "stg_") -> None:
    """Make the staging tables available to SQL under ``stg_<table>``."""
    for table, df in staged.items():
        df.createOrReplaceTempView(f"{prefix}{table}")
