import pytest

from waybill import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


