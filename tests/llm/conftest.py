import tempfile

import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="carlot-llm-"))
