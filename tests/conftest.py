import pytest

from forumlens.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[8]",
        "forumlens-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Evaluate a column built from a text literal column ``t``."""

    def run(text, build, **extra):
        from pyspark.sql import functions as F

        row = spark.createDataFrame([(text,)], "t string").select(build(F.col("t")).alias("v")).first()
        return row["v"]

    return run
