"""Every registered query against its SQL on the smallest data set."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    from check_oracle import connect

    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    from check_oracle import compare

    state, _, note = compare(spark, con, FOLDER, name)
    assert state in ("ok", "ROWS"), note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_executors_need_no_installation(tmp_path):
    """Python workers start in a folder from which the package cannot be imported."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from tabloom import build_session; "
        "s = build_session('away', 'local[2]', **{'spark.sql.shuffle.partitions': '2'}); "
        f"print('rows', [e.queries()[n](s, {FOLDER!r}).count() for n in ('portfolio_metrics', 'forum_posts', 'cosine_topk')])"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows [5, 300, 50]" in done.stdout, done.stderr[-2000:]
