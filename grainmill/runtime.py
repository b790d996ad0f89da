"""Session helpers shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its rows were counted and found to be no more than this.
BROADCAST_ROWS = 200_000
#: Copies of the smaller side of a salted join: a key that a third of all rows hold is read by so many tasks.
SALT = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only where the session names none and runs in one process.

    A temporary one is deleted when the process ends. On a cluster, where other machines could not read it, an unset
    ``spark.checkpoint.dir`` is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        import atexit
        import shutil

        named = tempfile.mkdtemp(prefix="grainmill-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint, which survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slots(n_rows: int, per_slot: int) -> int:
    """The number of hash slots that hold about ``per_slot`` rows each; a function of the row count only."""
    return max(1, -(-n_rows // per_slot))


def join_checked(df: DataFrame, side: DataFrame, on: str, how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` joined with a materialized side: broadcast if that has at most ``most`` rows, else by a shuffle of both."""
    return df.join(F.broadcast(side) if side.limit(most + 1).count() <= most else side, on, how)


def join_salted(df: DataFrame, side: DataFrame, on: str, spread: str, how: str = "inner", salt: int = SALT) -> DataFrame:
    """``df`` joined with a side that holds a value of ``on`` once. Rows of one value are dealt to ``salt`` tasks by a hash of the
    column ``spread``, and the side is copied to each."""
    left = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread).cast("string")), F.lit(salt)).cast("int"))
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return left.join(right, [on, "_salt"], how).drop("_salt")
