import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over a one-row frame of given values."""

    def run(*columns, **values):
        import pandas as pd

        df = spark.range(1)
        from pyspark.sql import functions as F

        for name, value in values.items():
            schema = {"str": "string", "float": "double", "int": "int", "list": "array<double>", "NoneType": "string"}[type(value).__name__]
            df = df.withColumn(name, F.lit(value).cast(schema) if not isinstance(value, list) else F.array(*[F.lit(v) for v in value]).cast(schema))
        row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        assert pd is not None
        return row[0] if len(columns) == 1 else tuple(row)

    return run


DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
