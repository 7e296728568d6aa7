"""Every query runs where Python workers find no copy of the repository."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])                  # of the driver only
from __spark_entry__ import queries
from quire.session import build_session
spark = build_session("local[4]", shuffle_partitions=4)

def found(batches):
    import pyarrow as pa
    try:
        import quire
        n = 1
    except ModuleNotFoundError:
        n = 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([n] * b.num_rows)], names=["n"])

assert spark.range(4).mapInArrow(found, "n long").groupBy().sum("n").first()[0] == 0, "workers find the package"
for name, query in queries().items():
    if name.startswith("op") and name[2].isdigit() or name == "pipeline":
        print(name, query(spark, sys.argv[2]).count())
"""


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_queries_without_the_package_on_the_workers(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "run.py", REPO, SF], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert got.returncode == 0, got.stderr[-3000:]
    assert len(got.stdout.split("\n")) > 13
