"""Command-line oracle check: python tests/check.py [--sf DIR] [name or prefix ...]."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from millrace.session import build_session  # noqa: E402
from oracle import REGISTRY, compare, connect  # noqa: E402

args = sys.argv[1:]
folder = "/root/testdata/sf0.01"
if args and args[0] == "--sf":
    folder, args = args[1], args[2:]
names = [n for n in REGISTRY if not args or any(n.startswith(a) for a in args)]
spark = build_session(
    "check", "local[8]",
    **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
bad = 0
for name in names:
    began = time.time()
    try:
        count, diffs = compare(spark, con, folder, name)
    except Exception as error:  # report and go on
        count, diffs = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
    mark = "ok  " if not diffs else "FAIL"
    weak = "" if REGISTRY[name].sql else " (rows only)"
    print(f"{mark} {name} rows={count} {time.time() - began:.1f}s{weak}", flush=True)
    for d in diffs:
        print("     ", d[:700], flush=True)
    bad += bool(diffs)
print(f"{len(names) - bad} of {len(names)} match")
