"""Job configuration records: one JSON object per pipeline.

Fields: ``name``, ``source_table_name`` (list of paths), ``target_table_name``,
``output_path``, ``checkpoint_location``, ``bad_records_location``.  The
lookup filters the small config table by name and brings one row to the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.streaming.jobs import JobConfig, run_to_end

CONFIG_SCHEMA = ("name string, source_table_name array<string>, target_table_name string, "
                 "output_path string, checkpoint_location string, bad_records_location string")


def load_configs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG_SCHEMA).json(path)


def get_config(configs: DataFrame, name: str, trigger_once: bool = True,
               max_files_per_trigger: int | None = None, run_id: str | None = None) -> JobConfig:
    row = configs.filter(F.col("name") == name).limit(2).collect()
    if len(row) != 1:
        raise KeyError(f"expected one config named {name!r}, found {len(row)}")
    r = row[0]
    return JobConfig(name=r.target_table_name or name, source_paths=tuple(r.source_table_name or ()),
                     output_path=r.output_path, checkpoint_location=r.checkpoint_location,
                     bad_records_location=r.bad_records_location, trigger_once=trigger_once,
                     max_files_per_trigger=max_files_per_trigger, run_id=run_id)


def run_configured(spark: SparkSession, configs: DataFrame, names: Sequence[str], run_id: str,
                   jobs: Mapping[str, Callable[[SparkSession, JobConfig], StreamingQuery]],
                   max_files_per_trigger: int | None = None) -> list[JobConfig]:
    """Run the named jobs one after the other, each as its config row says,
    to the end of what is there; their rows carry the job's and run's name
    (``processed_by``).  Returns the configs that were run."""
    done = []
    for name in names:
        cfg = get_config(configs, name, max_files_per_trigger=max_files_per_trigger, run_id=run_id)
        run_to_end(jobs[name](spark, cfg))
        done.append(cfg)
    return done


def written_by(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """A job's table with ``job`` and ``run_id`` read back from its rows."""
    table = spark.read.parquet(cfg.output_path)
    return table.withColumns({"job": F.substring_index("processed_by", ":", 1),
                              "run_id": F.get(F.split("processed_by", ":", 2), 1)})
