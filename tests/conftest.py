from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortlens.session import build_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


INFO = "id_student long, code_module string, studied_credits double, age_band_num int, imd_band_num int, disability_flag int, pass_probability_base double"
SUBMISSIONS = "id_student long, id_assessment long, date_submitted int, score double, is_banked int, submitted int"
DUE = "id_assessment long, assessment_date int, weight double"


@pytest.fixture
def make_info(spark):
    return lambda rows: spark.createDataFrame(rows, INFO)


@pytest.fixture
def make_submissions(spark):
    return lambda rows: spark.createDataFrame(rows, SUBMISSIONS)


@pytest.fixture
def make_due(spark):
    return lambda rows: spark.createDataFrame(rows, DUE)


def rows(df, *columns):
    """Rows as sorted tuples; nulls first."""
    out = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(out, key=lambda t: [(v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in t])
