import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_modules_import_without_a_session():
    """No module may build Columns at import time (a driver imports the entry
    point before it has a session)."""
    code = ("import sys; sys.path.insert(0, %r)\n"
            "import emporium.plans.build, emporium.streaming.jobs, emporium.queries\n"
            "import emporium.operators.quality, emporium.operators.metrics, emporium.operators.union\n"
            "import oracle_queries, bench\n"
            "import __spark_entry__ as E\n"
            "from emporium.queries import QUERIES\n"
            "assert set(QUERIES) == set(oracle_queries.oracle_sql()) and set(QUERIES) <= set(E.queries())\n") % ROOT
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
