import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from boreflow.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("boreflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="boreflow-test-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="boreflow-test-")


def nsort(items):
    """Sort tuples that may hold NULLs (NULLs last, values compared as text)."""
    return sorted(items, key=lambda t: tuple((x is None, str(x)) for x in t))


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return nsort(tuple(r[c] for c in cols) for r in df.collect())
