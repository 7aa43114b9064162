"""Every query of this package on workers that cannot import the library."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import importlib.util, os, tempfile
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from quarry.session import local_session
spark = local_session(4, shuffle_partitions=4)
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(dir="."))

def blind(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("quarry") is not None]}})

assert not any(r.found for r in spark.range(4).mapInArrow(blind, "found boolean").collect())
for name, query in entry.queries().items():
    if name.startswith("op") and name[2].isdigit():
        print(name, len(query(spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


def test_queries_run_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(entry=f"{REPO}/__spark_entry__.py")], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    names = [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert all(int(line.split()[1]) > 0 for line in done.stdout.splitlines() if line.startswith("op"))
