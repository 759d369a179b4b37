import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)
SF = "/root/testdata/sf0.001"
#: Contigs are too short for the windows in the smallest tables.
SF_LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    at = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC",
        "spark.local.dir": at, "spark.sql.warehouse.dir": f"{at}/warehouse", "spark.checkpoint.dir": f"file://{at}/shared",
    }
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="session")
def oracle():
    return connect(SF)


@pytest.fixture(scope="session")
def oracle_larger():
    return connect(SF_LARGER)


def rows_of(pdf):
    """Rows as sorted tuples of texts, columns by name; floats to nine decimals."""
    cols = sorted(pdf.columns)

    def text(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, float):
            return f"{v + 0.0:.9f}"
        return str(v)

    return cols, sorted(tuple(text(v) for v in row) for row in pdf[cols].astype(object).itertuples(index=False))
