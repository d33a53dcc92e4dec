"""Run every query with its oracle: python check_oracles.py [sf_dir] [name ...]"""

import sys
import time

sys.path.insert(0, "tests")
from compare import connect, difference  # noqa: E402

from reachmap.plans.catalog import QUERIES  # noqa: E402
from reachmap.plans.oracles import oracles  # noqa: E402
from reachmap.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark, con, sql = local_session(8), connect(sf), oracles()
bad = 0
for name in names:
    t0 = time.time()
    try:
        diff = difference(QUERIES[name](spark, sf), con, sql[name]) if name in sql else "no oracle"
    except Exception as e:
        diff = f"{type(e).__name__}: {str(e)[:700]}"
    bad += diff is not None
    print(f"{name:32s} {time.time() - t0:6.2f}s  {diff or 'equal'}", flush=True)
print(f"{len(names) - bad} equal, {bad} not")
