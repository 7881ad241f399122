"""The entry points, with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    import __spark_entry__ as e

    queries, sql = e.queries(), e.oracle_sql()
    assert "relax_summary_by_epoch" in queries and set(sql) <= set(queries)
    if os.path.isdir("/root/testdata/sf0.001"):
        assert e.entry(spark).count() == 30


def test_without_the_training_data_operators(tmp_path):
    """The library, the entry points and the queries stand without them."""
    shutil.copytree(os.path.join(ROOT, "runlens"), tmp_path / "runlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 50 and 'pipeline' not in q and not any(n.startswith('op') for n in q); print(len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr


def test_without_the_subpackage_but_with_the_pipeline(tmp_path):
    """The pipeline's file alone brings nothing in, and an error of its own isn't taken for a missing subpackage."""
    shutil.copytree(os.path.join(ROOT, "runlens"), tmp_path / "runlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 50 and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    found = run()
    assert found.returncode == 0, found.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    assert "no_such_module_at_all" in run().stderr


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "runlens")):
        if "llm" not in folder.split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    text = open(os.path.join(folder, n)).read()
                    assert "llm" not in text, n
