"""Table schemas and conforming a DataFrame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "double": DoubleType(),
}


def _struct(columns: str) -> StructType:
    out = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        out.add(name, _TYPES[kind])
    return out



# Column names and order of the input tables.
RUNS = _struct(
    "dag_id string, run_id string, execution_date timestamp, state string,"
    " start_date timestamp, end_date timestamp, run_type string,"
    " external_trigger boolean, queued_at timestamp, data_interval_start timestamp,"
    " data_interval_end timestamp, updated_at timestamp, clear_number int"
)
TASKS = _struct(
    "dag_id string, task_id string, run_id string, state string, try_number int,"
    " max_tries int, start_date timestamp, end_date timestamp, duration double,"
    " queued_dttm timestamp, pool string, queue string, priority_weight int,"
    " hostname string, operator string, custom_operator_name string"
)
PIPELINES = _struct(
    "dag_id string, is_paused boolean, is_active boolean,"
    " last_parsed_time timestamp, schedule_interval string, fileloc string,"
    " owners string, has_import_errors boolean, max_active_runs int,"
    " max_active_tasks int, max_consecutive_failed_dag_runs int"
)
LOGS = _struct(
    "dag_id string, run_id string, task_id string, try_number int,"
    " log_ts timestamp, severity string, source_loc string, message string,"
    " full_block string"
)

# Version keys per table; the newest insert_time wins.
VERSION_KEYS = {
    "runs": ("dag_id", "run_id"),
    "tasks": ("dag_id", "run_id", "task_id", "map_index"),
    "pipelines": ("dag_id",),
}
VERSION_COLUMN = "insert_time"
SCHEMAS = {"runs": RUNS, "tasks": TASKS, "pipelines": PIPELINES, "logs": LOGS}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones are NULL, bad values too."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        name = present.get(f.name.lower())
        if name is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[name].dataType == f.dataType:
            out.append(F.col(name).alias(f.name))
        else:
            out.append(F.col(name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)
