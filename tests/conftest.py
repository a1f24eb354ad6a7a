import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline import get_spark

    s = get_spark("local[4]", app="ledgerline-tests", shuffle_partitions=4,
                  extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only when the session has none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s


@pytest.fixture()
def workdir(spark):
    from ledgerline.session import new_run_dir

    return new_run_dir(spark, "test")


def _write_text(path, text):
    local = path.replace("file:", "")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write(text)
    return path
