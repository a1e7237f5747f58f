"""The library without its optional subpackage."""
import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith(('op', 'pipeline')) for k in q), len(set(e.oracle_sql()) - set(q)))"


def _copy(tmp_dir: str, *without: str) -> str:
    tree = os.path.join(tmp_dir, "tree")
    skip = {os.path.join(ROOT, *w.split("/")) for w in without}

    def ignore(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in skip]
    shutil.copytree(ROOT, tree, ignore=ignore)
    return tree


def _count(tree: str) -> list[int]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=tree, env=env, capture_output=True, text=True, check=True)
    return list(map(int, out.stdout.split()))


@pytest.mark.parametrize("without", [("salesmart/llm", "tests/llm"), ("salesmart/llm", "tests/llm", "corpus_pipeline.py")])
def test_imports_without_the_subpackage(tmp_dir, without):
    from salesmart.plans.queries import QUERIES
    assert _count(_copy(tmp_dir, *without)) == [len(QUERIES), 0, 0]


def test_emptied_folder(tmp_dir):
    from salesmart.plans.queries import QUERIES
    tree = _copy(tmp_dir, "salesmart/llm", "tests/llm")
    os.makedirs(os.path.join(tree, "salesmart", "llm", "__pycache__"))
    assert _count(tree) == [len(QUERIES), 0, 0]
