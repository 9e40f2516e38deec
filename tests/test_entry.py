"""The entry module works without the optional text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def _run(code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_entry_without_the_text_operators():
    done = _run("import sys; sys.modules['knnspark.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
                "import __spark_entry__ as e\n"
                "assert 'knn_l2' in e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
                "assert set(e.oracle_sql()) <= set(e.queries())")
    assert done.returncode == 0, done.stderr
