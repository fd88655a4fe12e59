"""The engine's queries are there when a package of the optional part is not."""

import subprocess
import sys


def test_a_missing_package_takes_no_other_query():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e, dqloom.queries as q; assert set(q.queries()) <= set(e.queries()) and set(q.oracle_sql()) <= set(e.oracle_sql()); print('ok')"
    assert "ok" in subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0]).stdout
