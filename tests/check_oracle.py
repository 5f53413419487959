"""Runs bound queries against their SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, connect  # noqa: E402

from quantloom.bindings.catalog import REGISTRY  # noqa: E402
from quantloom.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(REGISTRY)
    spark = local_session("oracle-check")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        bound = REGISTRY[name]
        start = time.time()
        try:
            df = bound.run(spark, sf_dir)
            problem = compare(df, con, bound.sql) if bound.sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if len(sys.argv) > 2:
                traceback.print_exc()
        failed += bool(problem and not problem.startswith("rows only"))
        print(f"{'ok  ' if problem is None else 'FAIL' if not problem.startswith('rows') else 'rows'} "
              f"{name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {failed} failed")


if __name__ == "__main__":
    main()
