import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.enabled": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mixed(spark):
    """101 rows: gaps in one number, two categories, a 0/1 target, and the first row repeated."""
    import numpy as np

    draw = np.random.default_rng(42)
    gaps = set(draw.choice(100, 10, replace=False).tolist()) - {0}
    rows = [
        (
            i, None if i in gaps else float(draw.normal()), float(draw.normal() * 10 + 50),
            "ABC"[int(draw.integers(3))], "XY"[int(draw.integers(2))], int(draw.integers(2)),
        )
        for i in range(100)
    ]
    rows.append((100, *rows[0][1:]))
    schema = "id bigint, numeric1 double, numeric2 double, category1 string, category2 string, target bigint"
    return spark.createDataFrame(rows, schema)
