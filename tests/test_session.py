"""The shared folder, in a process of its own because the setting is fixed at start."""

import os
import subprocess
import sys

SCRIPT = """
import sys
from tablewright.session import drop_scratch, local_session, scratch_path, shared_root, tune
from tablewright.operators import changes, keys
from tablewright.sources import files
spark = tune(local_session(2, 2, **{"spark.checkpoint.dir": sys.argv[1]}))
assert shared_root(spark) == sys.argv[1], shared_root(spark)
path = scratch_path(spark, "x")
assert path.startswith(sys.argv[1] + "/tablewright/")
assert changes.publish(keys.dense_ids(spark.range(10).toDF("n"), ["n"]), path) == 10
assert len(files.child_names(spark, path.rsplit("/", 1)[0])) == 2
drop_scratch(spark)
assert not files.exists(spark, path)
print("fine")
"""


def test_checkpoint_dir_names_the_shared_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, capture_output=True, text=True, timeout=180)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
