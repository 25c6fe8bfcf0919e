"""Result sinks: replace a table, replace one run of a table, or append to a JDBC table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.functions import TASK_ID_COLUMN
from clickscope.session import checkpoint_dir


def overwrite_table(df: DataFrame, table: str, partition_by: list[str] | None = None,
                    fmt: str = "parquet", path: str | None = None) -> None:
    """Drop-and-replace a table. Without ``path`` the catalog places it
    (managed table); with ``path`` its files go there (e.g. a shared folder).

    Large fact tables should be written with ``partition_by=["date"]`` so date
    conditions prune whole directories on read.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def replace_run(df: DataFrame, table: str, run_id: str, run_column: str = TASK_ID_COLUMN) -> None:
    """Write a run's rows into a catalog table, in place of those of an earlier run of that id.

    The table is partitioned by the run id, and created on first use. Only the
    run's own partition is overwritten, also by an empty result, so a run that
    is repeated after a failure leaves its rows once, and other runs stay. The
    rows are worked out and checked before anything is overwritten: a result
    that fails, or holds a row of another run, leaves the table as it was.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    if not spark.catalog.tableExists(table):
        df.limit(0).write.partitionBy(run_column).saveAsTable(table)
    columns = [c for c in spark.table(table).columns if c != run_column]
    if sorted(columns) != sorted(c for c in df.columns if c != run_column):
        raise ValueError(f"{table} has the columns {columns}, the result {df.columns}")
    told = F.assert_true(F.col(run_column).eqNullSafe(F.lit(run_id)), F.lit(f"a row is not of run {run_id}"))
    view = f"clickscope_run_{uuid.uuid4().hex}"
    df.filter(told.isNull()).select(*columns).checkpoint().createOrReplaceTempView(view)
    literal = run_id.replace("\\", "\\\\").replace("'", "\\'")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({run_column} = '{literal}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                num_partitions: int | None = None) -> None:
    """Append rows to a JDBC table, creating it on first use.

    Credentials and driver class come in ``properties`` from the caller;
    nothing is read from files here. ``num_partitions`` bounds concurrent
    connections; the rows are dealt to so many partitions by an exchange of
    the finished result, which leaves the plan below it as parallel as it is.
    """
    out = df.repartition(num_partitions) if num_partitions else df
    writer = out.write.format("jdbc").option("url", url).option("dbtable", table).mode("append")
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
