import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    """A value that compares alike from both engines."""
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if hasattr(v, "isoformat"):
        return str(v)
    return float(v) if type(v).__name__ == "Decimal" else v


def same(df, duck, sql):
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert ours == theirs
