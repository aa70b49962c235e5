"""The entry without the training-data package, or without something that it needs."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(n.startswith('op1') for n in q))"


def shown(code, folder):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, references, training = done.stdout.split()
    return int(count), int(references), training == "True"


@pytest.mark.parametrize("left", [None, "empty folder"])
def test_without_the_package(tmp_path, left):
    names = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=names)
    if left:
        (tmp_path / "copy" / "burstwatch" / "llm").mkdir()
    count, references, training = shown(SHOW, tmp_path / "copy")
    assert count > 75 and references > 66 and not training


def test_without_a_module_that_only_the_package_needs():
    count, _, training = shown("import sys; sys.modules['tiktoken'] = None; " + SHOW, ROOT)
    assert count > 75 and not training
