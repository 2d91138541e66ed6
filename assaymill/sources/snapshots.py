"""Tables as numbered snapshot folders: a merge reads one snapshot and writes the next.

A step that changes several tables writes their snapshots and then one commit row that names them all; `committed` reads
the tables of the last commit, so a step that dies in between leaves no half of its changes behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete snapshots of a table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if n.startswith("v") and n[1:].isdigit()
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def latest(spark: SparkSession, folder: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The newest complete snapshot, aligned to `schema` if given; an empty table or None where there is none."""
    found = _versions(spark, folder)
    if not found:
        return spark.createDataFrame([], schema) if schema is not None else None
    df = spark.read.parquet(f"{folder}/v{found[-1]}")
    return align(df, schema) if schema is not None else df


def write_next(df: DataFrame, folder: str) -> int:
    """Write the next snapshot; readers of the one before are not disturbed."""
    n = (_versions(df.sparkSession, folder) or [0])[-1] + 1
    df.write.mode("overwrite").parquet(f"{folder}/v{n}")
    return n


COMMITS = "_commits"


def commit(spark: SparkSession, root: str, changes: dict[str, DataFrame]) -> None:
    """Write the next snapshot of each table below `root`, then the commit that makes all of them current."""
    current = committed(spark, root)
    current |= {name: write_next(df, f"{root}/{name}") for name, df in changes.items()}
    rows = [(name, version) for name, version in sorted(current.items())]
    write_next(spark.createDataFrame(rows, "name string, version int").coalesce(1), f"{root}/{COMMITS}")


def committed(spark: SparkSession, root: str) -> dict[str, int]:
    """Table name -> version of the last commit."""
    last = latest(spark, f"{root}/{COMMITS}")
    return {} if last is None else {r["name"]: r["version"] for r in last.collect()}  # one row per table


def at_commit(spark: SparkSession, root: str, versions: dict[str, int], name: str, schema: StructType | str | None = None) -> DataFrame | None:
    """A table as of a commit; one that no commit names is read at its newest snapshot."""
    if name not in versions:
        return latest(spark, f"{root}/{name}", schema)
    df = spark.read.parquet(f"{root}/{name}/v{versions[name]}")
    return align(df, schema) if schema is not None else df


def align(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Columns of a schema in its order; those a table does not have yet are NULL, extra ones are kept at the end."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    known = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
             for f in schema.fields]
    return df.select(*known, *[c for c in df.columns if c not in schema.names])
