import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a Column function over a list of inputs (tuples for several columns)."""

    def run(function, inputs):
        rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(inputs)]
        names = [f"c{j}" for j in range(len(rows[0]) - 1)]
        schema = ", ".join(["i int", *[f"{name} string" for name in names]])
        df = spark.createDataFrame(rows, schema)
        found = df.select("i", function(*names).alias("out")).collect()
        return [row.out for row in sorted(found, key=lambda row: row.i)]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_of
