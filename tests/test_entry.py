from __future__ import annotations

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder: Path) -> tuple[set[str], set[str]]:
    code = "import __spark_entry__ as e; print('|'.join(e.queries())); print('|'.join(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": ""}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split("\n")
    return set(said[0].split("|")), set(said[1].split("|"))


def test_names_agree():
    queries, sql = names(ROOT)
    assert sql <= queries


def test_imports_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "tracewright", tmp_path / "tracewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "tracewright" / "llm" / "__pycache__").mkdir(parents=True)  # what a deleted folder may leave
    queries, sql = names(tmp_path)
    assert len(sql) >= 50
    assert not any(q.startswith("op1_") or q == "pipeline" for q in queries)


def test_a_missing_library_costs_the_training_data_operators_alone(tmp_path):
    shutil.copytree(ROOT / "tracewright", tmp_path / "tracewright", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "xxhash.py").write_text("raise ImportError('not here')")
    queries, sql = names(tmp_path)
    assert len(sql) >= 80
    assert not any(q.startswith("op1_") for q in queries)


def test_clusters_need_a_shared_folder():
    import pytest

    from tracewright.plans.session import ensure_checkpoints

    class Fake:
        master = "spark://host:7077"
        sparkContext = property(lambda self: self)  # noqa: N815
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(dict)  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoints(Fake())


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tracewright").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"tracewright\.llm|\.llm\b|import llm", path.read_text()), path


def test_flagship(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["match_level", "n"]
    assert sum(r["n"] for r in rows.collect()) == 150
