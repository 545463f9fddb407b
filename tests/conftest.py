import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    own = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()


def canonical(rows, names):
    """Rows as sorted text, floats to 6 places, in the order of column names."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: repr(round(float(v), 6) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)
