import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Values of a column expression over texts."""
    from pyspark.sql import functions as F

    def run(texts, expr):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(2)
        return [r["x"] for r in rows.select("i", expr(F.col("text")).alias("x")).orderBy("i").collect()]

    return run
