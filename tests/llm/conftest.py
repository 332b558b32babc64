import pytest

from residua.llm.queries import workers_find_package


@pytest.fixture(autouse=True)
def package_for_workers(spark):
    workers_find_package(spark)
