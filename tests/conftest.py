import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from waybill.session import configure

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        configure(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def targets(spark):
    """A pair of fresh databases."""
    import uuid

    from waybill import Targets

    tag = uuid.uuid4().hex[:8]
    for name in (f"results_{tag}", f"rejects_{tag}"):
        spark.sql(f"CREATE DATABASE {name}")
    return Targets(results=f"results_{tag}", rejects=f"rejects_{tag}")
