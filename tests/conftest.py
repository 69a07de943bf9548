import json
import os
import sys
import time

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)
# Python workers import the package too
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def deliver(tmp_path):
    """Write records as one JSON Lines file; later files get later modification times."""
    state = {"n": 0, "clock": time.time() - 10_000}

    def write(folder, *records):
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        state["n"] += 1
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path = target / f"f{state['n']:04d}.json"
        path.write_text("\n".join(lines), encoding="utf-8")
        stamp = state["clock"] + state["n"] * 10
        os.utime(path, (stamp, stamp))
        return str(target)

    return write


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
