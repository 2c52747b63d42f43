"""The registry without the training-data package: absent, or an empty folder."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"


def _copy(tmp_path, *left_out):
    for name in ("larder", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, name)
        if name in left_out or not os.path.exists(src):
            continue
        if os.path.isdir(src):
            skip = shutil.ignore_patterns("__pycache__", *(["llm"] if "llm" in left_out else []))
            shutil.copytree(src, tmp_path / name, ignore=skip)
        else:
            shutil.copy(src, tmp_path / name)
    return tmp_path


def _ask(path):
    return subprocess.run([sys.executable, "-c", ASK], cwd=path, env={**os.environ, "PYTHONPATH": str(path)}, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("case", ["both gone", "folder gone", "empty folder", "pipeline gone"])
def test_other_queries_stay(tmp_path, case):
    gone = {"both gone": ("llm", "corpus_pipeline.py"), "folder gone": ("llm",), "empty folder": ("llm",), "pipeline gone": ("corpus_pipeline.py",)}[case]
    path = _copy(tmp_path, *gone)
    if case == "empty folder":
        os.makedirs(path / "larder" / "llm" / "__pycache__")
    out = _ask(path)
    assert out.returncode == 0, out.stderr
    from larder.catalog.queries import QUERIES
    assert out.stdout.split()[0] == str(len(QUERIES)) and out.stdout.split()[2] == "False"


def test_a_missing_library_is_told(tmp_path):
    path = _copy(tmp_path, "llm", "corpus_pipeline.py")
    (path / "corpus_pipeline.py").write_text("import no_such_library_at_all\n")
    out = _ask(path)
    assert out.returncode != 0 and "no_such_library_at_all" in out.stderr
