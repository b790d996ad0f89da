"""Writers. Spark's committer writes beside the target and renames on success; ``_SUCCESS`` marks a finished stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, p: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(p)
    return jvm, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "overwrite") -> None:
    """JSON lines in UTF-8, a file per task (W1, T13). Null fields are left out unless ``keep_nulls``."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def export_one_file(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """One JSON lines file, for small results only: written beside the target, then renamed over it. Nothing lies at the target in part."""
    spark = df.sparkSession
    tmp = f"{path}.tmp"
    write_jsonl(df.coalesce(1), tmp, keep_nulls)
    jvm, target, fs = _path(spark, path)
    part = next(s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmp)) if s.getPath().getName().startswith("part-"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(part, fs.makeQualified(target), rename)  # one step: a reader sees the old file or the new one
    fs.delete(jvm.org.apache.hadoop.fs.Path(tmp), True)


def write_packed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Packed sequences as Parquet."""
    df.write.mode(mode).parquet(path)


def write_splits(splits: dict[str, DataFrame | None], path: str) -> None:
    """Named splits side by side, ``split=NAME``; missing ones are skipped."""
    for name, df in splits.items():
        if df is not None:
            df.write.mode("overwrite").json(f"{path}/split={name}")


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether a stage has finished."""
    _, p, fs = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def write_once(df: DataFrame, path: str) -> bool:
    """Writes Parquet unless the stage is done (W4); whether it wrote."""
    if is_done(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True
