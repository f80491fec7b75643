import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from demandlens.session import build_session  # noqa: E402
from demandlens.taxonomy import taxonomy_table  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def taxonomy(spark):
    return taxonomy_table(spark)


@pytest.fixture
def market(spark):
    """Build a demand table from skill -> posting count (shares of ``n``)."""
    from demandlens.operators.demand import rank_demand

    def build(counts, n=4):
        rows = [(s, c, c / n) for s, c in counts.items()]
        return rank_demand(spark.createDataFrame(
            rows, "skill string, posting_count bigint, pct_postings double"))
    return build
