import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
               .config("spark.driver.memory", "4g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Sorted row tuples, floats to six decimals."""
    def plain(v):
        if isinstance(v, float):
            return round(v, 6) + 0.0
        if isinstance(v, list):
            return [tuple(x) if isinstance(x, tuple) else x for x in v]
        return v
    df = df.select(*cols) if cols else df
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)
