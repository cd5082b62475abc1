import pytest
from pyspark.sql import SparkSession

from inciscope.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("inciscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted plain tuples of a DataFrame."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect


@pytest.fixture(scope="session")
def plan():
    """Text of the physical plan; the final one if the query has run."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
