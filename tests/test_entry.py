"""The library without its llm subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), any(n.startswith('op') for n in q))"


def run(at: Path, code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=at, capture_output=True, text=True, timeout=120)


def test_imports_without_llm(tmp_path):
    shutil.copytree(REPO / "eventloom", tmp_path / "eventloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    out = run(tmp_path, COUNT)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1] == "False" and int(out.stdout.split()[0]) > 50


def test_llm_that_cannot_be_imported_is_left_out_with_a_warning(tmp_path):
    shutil.copytree(REPO / "eventloom", tmp_path / "eventloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    (tmp_path / "eventloom" / "llm").mkdir()
    (tmp_path / "eventloom" / "llm" / "__init__.py").write_text("")
    (tmp_path / "eventloom" / "llm" / "queries.py").write_text("import no_such_module_at_all\n")
    out = run(tmp_path, COUNT)
    assert out.returncode == 0 and out.stdout.split()[1] == "False" and "no_such_module_at_all" in out.stderr


def test_nothing_else_imports_llm():
    for path in (REPO / "eventloom").rglob("*.py"):
        if "llm" not in path.relative_to(REPO).parts:
            assert "llm" not in path.read_text(), path
