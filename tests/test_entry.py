"""The entry module's contract, with and without its optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(root):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), set(e.oracle_sql()) <= set(e.queries()), 'bm25_search' in e.queries(), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=True)
    return out.stdout.split()


def test_every_oracle_has_its_query():
    assert names(ROOT)[2:4] == ["True", "True"]


def test_the_library_stands_without_its_optional_parts(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    count, oracles, *rest = names(copy)
    assert int(count) == int(oracles) == 88 and rest == ["True", "True", "False"]


def test_the_flagship_query_runs(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        sys.path.insert(0, ROOT)
        import __spark_entry__

        assert __spark_entry__.entry(spark).columns == ["doc_id", "lang", "source", "score"]
