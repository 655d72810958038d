import pytest
from pyspark.sql import SparkSession

from articlelake.session import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = configure(
        SparkSession.builder.master("local[4]")
        .appName("articlelake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config(
            "spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))
        )
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """Evaluate an expression over one row of string columns."""

    def run(build, **values):
        from pyspark.sql import functions as F

        row = spark.createDataFrame([tuple(values.values())], _schema(values))
        return row.select(build(*[F.col(c) for c in values]).alias("v")).first()["v"]

    return run


def _schema(values):
    kinds = {str: "string", int: "bigint", type(None): "string", bool: "boolean"}
    return ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
