import pytest

from showbill.session import session


@pytest.fixture(scope="session")
def spark():
    spark = session("local[4]", 4, **{"spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
