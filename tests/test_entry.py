"""The entry without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_stands_without_the_training_data_folders(tmp_path):
    shutil.copytree(os.path.join(ROOT, "loomseq"), tmp_path / "loomseq", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    tell = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", tell], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=120).stdout.split()
    assert int(out[0]) > 120 and out[1:] == ["False", "False"]
