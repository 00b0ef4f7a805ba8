"""Every operator and the pipeline are registered, and the entry module works without them."""
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline

ROOT = Path(__file__).resolve().parents[2]


def test_names():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert "pipeline" in names and {"op2_quality_rules", "op7_mixing", "op11_fill_middle", "op13_importance_resampling"} <= set(entry.oracle_sql()) and len(corpus_pipeline.STAGES) == 5


def test_entry_without_the_folder(tmp_path):
    shutil.copytree(ROOT / "sitewright", tmp_path / "sitewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 200 and 'pipeline' not in q and not any(x.startswith('op1_') for x in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
