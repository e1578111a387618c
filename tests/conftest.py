import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def to_pandas(df, *order) -> pd.DataFrame:
    """Rows as pandas, NULL as None/NaN, in the given order."""
    out = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    return out.sort_values(list(order)).reset_index(drop=True) if order else out
