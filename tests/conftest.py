import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyforge.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    session = get_session("tests", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(",".join(str(v) for v in row) for row in rows) + "\n", encoding="utf-8")
    return str(path)
