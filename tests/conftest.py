import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tripmart.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[*]", app_name="tripmart-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lookups(spark):
    from tripmart.plans import registry

    return registry.lookups(spark)
