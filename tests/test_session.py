"""Folders that a program makes and leaves."""

import os
import subprocess
import sys

import pytest

from lineara import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
from lineara.session import checkpointed, discard, local_session, shared_dir, stored, MADE
spark = local_session("ends", "2", **{"spark.checkpoint.dir": "file://%s", "spark.driver.memory": "1g"})
df = checkpointed(spark.range(10))
stored(df, "kept")
before = len(MADE)
stored(df, "goes")
discard(spark)  # all but the folder of checkpoints
assert len(MADE) <= 1 and df.count() == 10 and checkpointed(df).count() == 10
stored(df, "left")
%s
"""


@pytest.mark.parametrize("end", ["spark.stop()", ""])
def test_a_program_leaves_nothing(tmp_path, end):
    done = subprocess.run([sys.executable, "-c", PROGRAM % (tmp_path, end)], env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.listdir(tmp_path) == []


def test_whether_something_exists(spark, tmp_path):
    assert session.exists(spark, f"file://{tmp_path}") and not session.exists(spark, f"file://{tmp_path}/none")
