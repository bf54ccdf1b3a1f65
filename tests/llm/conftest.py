import pytest


@pytest.fixture(scope="session", autouse=True)
def _prepared(spark):
    from kpicast.llm.common import prepare

    prepare(spark)
    # Small tables: stars take several rounds of small joins.
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
