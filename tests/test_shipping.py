import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from curbside.operators import profile
from curbside.streaming import clusters, frozen


@pytest.mark.parametrize("function", [profile._read_footers, profile._batch_bytes, clusters._updater(1.0, 5, 60.0),
                                      frozen._placed(1.0, 5, np.zeros((2, 3))), frozen._merge(1.0, 5)])
def test_worker_functions_load_without_the_package(function, tmp_path):
    """Executors have Spark and Arrow, but not this repository."""
    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); assert callable(f); assert 'curbside' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(function), cwd=tmp_path, env=env,
                          capture_output=True)
    assert done.returncode == 0, done.stderr.decode()
