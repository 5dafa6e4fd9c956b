import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import __spark_entry__ as contract
assert contract.LLM is None and contract.PIPELINE is None
assert not any(n.startswith("op") and n[2].isdigit() for n in contract.queries()), "numbered operators"
assert "pipeline" not in contract.queries() and "entry_common_roles" in contract.queries()
assert set(contract.oracle_sql()) <= set(contract.queries())
"""


def imported_without(tmp_path, *gone):
    copy = tmp_path / "copy"
    left_out = {os.path.join(ROOT, g) for g in gone} | {os.path.join(ROOT, ".git"), os.path.join(ROOT, "tests")}
    shutil.copytree(
        ROOT, copy, ignore=lambda d, names: [n for n in names if n == "__pycache__" or os.path.join(d, n) in left_out]
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(copy)}
    return subprocess.run([sys.executable, "-c", CHECK], cwd=copy, env=env, capture_output=True, text=True, timeout=300)


def test_entry_imports_without_the_optional_package(tmp_path):
    run = imported_without(tmp_path, "marquetry/llm")
    assert run.returncode == 0, run.stderr


def test_entry_imports_without_the_package_and_the_pipeline(tmp_path):
    run = imported_without(tmp_path, "marquetry/llm", "corpus_pipeline.py")
    assert run.returncode == 0, run.stderr
