"""The driver contract, with and without the folder of operators for training data."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as e
assert e.queries().keys() >= e.oracle_sql().keys()
print(e.WITH_LLM, any(n.startswith("op") or n == "pipeline" for n in e.queries()))
"""


def run(folder, before=""):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", before + SCRIPT], cwd=folder, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_entry_without_the_training_data_operators(tmp_path):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "tallyforge", tmp_path / "tallyforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    assert run(tmp_path) == ["False", "False"]


def test_entry_without_a_package_they_need():
    blocked = "import sys\nsys.modules['sentencepiece'] = sys.modules['zstandard'] = sys.modules['xxhash'] = None\n"
    assert run(REPO, blocked) == ["False", "False"]


def test_nothing_outside_imports_them():
    for path in (REPO / "tallyforge").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tallyforge.llm" not in path.read_text(), path
