import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from geomedallion.session import REQUIRED_CONF, ensure_checkpoint_dir

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("geomedallion-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="gm-warehouse-"))
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


def rows(df, order=None):
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
