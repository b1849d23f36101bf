"""Driver contract: entry smoke, registry/oracle keys, Spark vs DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E
from riskweave.plans import registry
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck

BATCH_KEYS = [k for k in registry.QUERIES if not k.startswith("stream_")]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[:2] == ["event_date", "total_transactions"] and len(rows) > 0


def test_every_key_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_key_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF_SMALL)
    assert r["same_cols"], (r["cols"], r["ocols"])
    assert r["same_values"], (r.get("only_spark"), r.get("only_oracle"))


def test_payment_keys_outlive_the_operators_and_their_modules(tmp_path):
    """Without the operators' folder, or a module that only they need, the entry still gives its other keys."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    gone = tmp_path / "gone"
    shutil.copytree(root, gone, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "spark-warehouse", "*.md", "*.json"))
    blocked = "import sys; sys.modules['ahocorasick'] = None; "
    for where, before in ((gone, ""), (root, blocked)):
        code = before + "import __spark_entry__ as E; print(len(E.queries()), any(k.startswith('op') for k in E.queries()))"
        out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=where, capture_output=True, text=True, check=True).stdout
        assert out.split() == [str(len(registry.QUERIES)), "False"]
