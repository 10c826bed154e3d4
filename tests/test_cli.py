"""``python -m eddy``: the line-fed jobs from the command line (own JVM each)."""
import glob
import json
import os
import re
import subprocess
import sys

import pyarrow.dataset
import pyarrow.parquet

from test_fixture_join import NAV_LINES, USER_LINES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _lines(folder, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def _run(args, scratch):
    os.makedirs(scratch, exist_ok=True)
    env = dict(os.environ, PYTHONPATH=REPO)
    ck = os.path.join(scratch, "checkpoint")        # fresh: never resume an older run
    return subprocess.run([sys.executable, "-m", "eddy", "--master", "local[2]", "--once",
                           "--checkpoint", ck, *args],
                          cwd=scratch, env=env, capture_output=True, text=True, timeout=600)


def test_cli_windowed_join_prints_golden_rows(scratch):
    nav = _lines(os.path.join(scratch, "nav"), NAV_LINES)
    user = _lines(os.path.join(scratch, "user"), USER_LINES)
    r = _run(["windowed-join", "--nav", nav, "--user", user], scratch)
    assert r.returncode == 0, r.stderr[-2000:]
    rows = re.findall(r"^\(\d+,\d+,\d+\)$", r.stdout + r.stderr, flags=re.M)
    assert len(rows) == 36


def test_cli_prints_every_row_with_its_label(scratch):
    """1,000 rows in one micro-batch, each behind the sync_<ms> label."""
    own = _lines(os.path.join(scratch, "own"), [f"{i % 7}, {i}, 5" for i in range(1000)])
    r = _run(["--partitions", "2", "holdings", "--own", own], scratch)
    assert r.returncode == 0, r.stderr[-2000:]
    rows = re.findall(r"^sync_\d+> \((\d+),(\d+),\d+,5,5\)$", r.stdout + r.stderr, flags=re.M)
    assert sorted(int(u) for _, u in rows) == list(range(1000))


def test_cli_route_and_tables(scratch):
    recs = [{"id": i if i % 10 else None, "name": f"n{i % 3}", "age": i, "title": "t" if i % 2 else None,
             "timestamp": "2024-01-01T00:00:00Z", "partition": 0, "offset": i} for i in range(50)]
    src = _lines(os.path.join(scratch, "recs"), [json.dumps(x) for x in recs])
    out = {k: os.path.join(scratch, k) for k in ("even", "odd", "dead", "tuple", "employee", "bean")}
    r = _run(["route", "--records", src, "--even", out["even"], "--odd", out["odd"], "--dead", out["dead"]], scratch)
    assert r.returncode == 0, r.stderr[-2000:]
    count = lambda k: pyarrow.dataset.dataset(out[k], format="parquet").count_rows()
    assert (count("even"), count("odd"), count("dead")) == (20, 25, 5)
    r = _run(["tables", "--records", src, *(x for k in ("tuple", "employee", "bean") for x in (f"--{k}", out[k]))],
             os.path.join(scratch, "t2"))
    assert r.returncode == 0, r.stderr[-2000:]
    for k in ("tuple", "employee", "bean"):
        files = glob.glob(f"{out[k]}/log/_batch=0/*.parquet")
        assert sum(pyarrow.parquet.read_metadata(f).num_rows for f in files) == 48


def test_cli_holdings_poison_stops_after_restarts(scratch):
    own = _lines(os.path.join(scratch, "own"), ["7, 1, 5", "7, 3, 1", "7, 1, 2"])
    r = _run(["holdings", "--own", own, "--poison-user", "3", "--restarts", "1"], scratch)
    assert r.returncode != 0 and "poison record" in (r.stdout + r.stderr)
