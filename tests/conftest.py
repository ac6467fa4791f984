import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripline.plans.scanlog import EVENT_LOG_CONF
    from tripline.session import build_session

    events = {**EVENT_LOG_CONF, "spark.eventLog.dir": tempfile.mkdtemp(prefix="tripline-test-events-")}
    ckpt = tempfile.mkdtemp(prefix="tripline-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="tripline-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, **events},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tripline-test-")
