import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_flagship_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60


def test_streams_equal_batches(spark, small):
    from emberline.catalog import QUERIES
    from emberline.fixtures import table

    events = table(spark, small, "events")
    assert QUERIES["stream_dedup_available_now"](spark, small).count() == events.count()
    assert sum(r.n for r in QUERIES["stream_daily_counts"](spark, small).collect()) == events.count()


def test_entry_works_without_the_corpus_parts(tmp_path):
    """A copy of the repository without the optional folders still imports and lists its own queries."""
    import shutil

    for name in ("emberline", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "emberline" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op1') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
