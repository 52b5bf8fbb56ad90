"""Functions that run in tasks must work on executors that have no copy of the package."""

from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from corpusloom.operators import scoring, vocab
from corpusloom.streaming import chat

CHECK = "import pickle, sys; pickle.load(open(sys.argv[1], 'rb')); assert 'corpusloom' not in sys.modules"


@pytest.mark.parametrize("function", [scoring._overlap.func, scoring._mean_best, vocab._rebuild, chat._keep_history(5)])
def test_task_functions_travel_by_value(tmp_path, function):
    path = tmp_path / "function.pkl"
    path.write_bytes(cloudpickle.dumps(function))
    run = subprocess.run([sys.executable, "-c", CHECK, str(path)], cwd=tmp_path, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
