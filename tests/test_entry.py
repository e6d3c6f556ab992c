import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__

ROOT = Path(__file__).parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHEAP = ["fmt_ts_half_even", "normalize_text", "cue_lines_to_segments", "frame_intervals", "speech_windows", "prefix_budget", "stride_sample", "rendered_document", "candidate_windows", "score_strings", "cache_split", "tolerant_json"]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 3


@pytest.mark.parametrize("name", CHEAP)
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    got = __spark_entry__.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    rows = want.fetchall()
    places = [want.columns.index(c) for c in got.columns]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in places)) for r in rows) and rows


def test_oracles_have_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_llm_subpackage(tmp_path):
    """A copy without the llm folders and the pipeline still imports and offers the other queries."""
    import shutil

    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'exact_quotes' in q and not any(x.startswith('op') and x[2].isdigit() for x in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    for f in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text().replace("LLM", ""), f
