import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from odoflow.session import build_session

    ckpt = tempfile.mkdtemp(prefix="odoflow-test-ckpt-", dir="/tmp")
    s = build_session(
        app="odoflow-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.checkpoint.dir": ckpt,
            "spark.sql.ansi.enabled": "true",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="odoflow-test-wh-", dir="/tmp"),
            "spark.driver.extraJavaOptions": "-Dderby.system.home=" + tempfile.mkdtemp(prefix="odoflow-derby-", dir="/tmp"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def raw_rows(spark, rows):
    """Raw readings from tuples (C/A, UNIT, SCP, STATION, LINENAME, DIVISION, 'yyyy-mm-dd', 'HH:MM:SS', DESC, ENTRY, EXIT)."""
    from datetime import date

    from odoflow.schemas import RAW_SCHEMA

    fixed = [r[:6] + (date.fromisoformat(r[6]),) + r[7:] for r in rows]
    return spark.createDataFrame(fixed, RAW_SCHEMA)
