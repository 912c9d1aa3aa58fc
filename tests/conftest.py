import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from hangtally.session import SETTINGS
    builder = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-")))
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(frame, *columns): sorted tuples."""
    def take(df, *columns):
        cols = columns or df.columns
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
    return take
