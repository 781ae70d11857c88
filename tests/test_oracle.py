"""Every registered query equals its DuckDB oracle on sf0.001."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_all_queries_match_oracle_sf0001():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "oracle_check.py"),
                          "/root/testdata/sf0.001"], capture_output=True, text=True, timeout=1800)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith(("PASS", "FAIL"))]
    fails = [ln for ln in lines if ln.startswith("FAIL")]
    assert lines and not fails, "\n".join(fails) + out.stderr[-2000:]
