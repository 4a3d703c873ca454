import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from placemill.session import drop_scratch, local_session, scratch_path, ship_package
spark = local_session(2)
ship_package(spark)
from placemill.sources.registers import decode_files
row = ("s", "csv", None, 0, "#0", b"n\\nx\\n")
files = spark.createDataFrame([row], "source_id string, format string, encoding string, header_row int, sheet string, content binary")
sys.path.remove({root!r})
print(decode_files(files).count())
path = scratch_path(spark, "x")
spark.range(3).write.parquet(path)
drop_scratch(spark)
import os
print(os.path.exists(path.removeprefix("file:")))
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["1", "False"], run.stderr[-2000:]
