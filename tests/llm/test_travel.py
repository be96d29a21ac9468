"""Tasks of the operators carry their code: workers that cannot import the package still run them."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
TABLES = "/root/testdata/sf0.001"

# The repository is put on the driver's path only; workers start in another folder without it.
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from caselight.session import local_session
from caselight.llm import load_queries
spark = local_session(2, 4, **{{"spark.checkpoint.dir": {scratch!r}}})
queries = load_queries()[0]
for name in {names!r}:
    print(name, queries[name](spark, {tables!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables not here")
def test_queries_run_where_workers_lack_the_package():
    names = ["op1_minhash_near_dedup", "op4_byte_bpe", "op5_best_fit_packing", "op10_plane_token_files"]
    with tempfile.TemporaryDirectory() as away:
        code = SCRIPT.format(repo=str(REPO), scratch=f"{away}/scratch", names=names, tables=TABLES)
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run(
            [sys.executable, "-c", code], cwd=away, env=env, capture_output=True, text=True, timeout=900
        )
    assert done.returncode == 0, done.stderr[-3000:]
    for name in names:
        assert f"\n{name} " in "\n" + done.stdout
