"""The library works without the training-data package."""

import json
import os
import shutil
import subprocess
import sys

import pytest

from chronolex.plans import all_queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def names(folder, before=""):
    """Names of queries and of SQL forms that a copy of the library registers."""
    done = subprocess.run([sys.executable, "-c", before + LIST], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_import_without_the_package(tmp_path, with_pipeline):
    folder = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "chronolex"), folder / "chronolex", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")) else [])]:
        shutil.copy(os.path.join(ROOT, name), folder / name)
    assert names(folder) == [sorted(all_queries.QUERIES), sorted(all_queries.ORACLES)]


def test_import_without_a_library_of_the_package():
    got = names(ROOT, "import sys; sys.modules['xxhash'] = None; ")
    assert got == [sorted(all_queries.QUERIES), sorted(all_queries.ORACLES)]
