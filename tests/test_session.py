"""The package on workers that do not have it on their path."""
from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import ROOT

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from martflow.session import local_session, ship_package

spark = local_session(2, 2)
rows = spark.range(4)


def uses_the_package(batches):
    from martflow.functions import columns

    for b in batches:
        yield b.iloc[: len(columns.GENDERS)] if len(b) else b


def count():
    return rows.mapInPandas(uses_the_package, "id long").count()


try:
    count()
    print("found without shipping")
except Exception as err:
    print("missing" if "No module named 'martflow'" in str(err) else err)
for _ in range(2):
    ship_package(spark)
print("shipped", count())
"""


def test_workers_get_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(root=str(ROOT))], cwd=tmp_path, env=env, timeout=200,
                          capture_output=True, text=True)
    assert done.stdout.split("\n")[:2] == ["missing", "shipped 4"], done.stdout + done.stderr[-2000:]
