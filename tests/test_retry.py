"""Executor/task loss: a failed task attempt is retried and the result is
unchanged (operators are deterministic, no driver-side state)."""

import json
import os
import subprocess
import sys

from conftest import SF01


def test_task_failure_is_retried_to_same_result():
    script = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = subprocess.run([sys.executable, script, SF01], capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["same"] and res["n"] > 0 and res["session_rows"] == 5725


def test_python_workers_without_package_on_path():
    """Run from /tmp with no PYTHONPATH: executors get the package's code by
    value, not by import."""
    import tempfile
    here = os.path.dirname(os.path.abspath(__file__))
    entry = os.path.join(os.path.dirname(here), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, os.path.join(here, "foreign_cwd_job.py"), entry, SF01],
                         capture_output=True, text=True, timeout=600, cwd=tempfile.gettempdir(), env=env)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["rising"] == 4500 and res["entry"] > 0
