"""Run the registered queries against their SQL: ``python tests/check_queries.py <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = get_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    oracles = contract.oracle_sql()
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                verdict = differences(df, connection, oracles[name]) or "ok"
            else:
                verdict = f"rows {df.count()}"
        except Exception:
            verdict = "ERROR " + traceback.format_exc(limit=-3)[-1500:]
        failed += not (verdict == "ok" or verdict.startswith("rows"))
        print(f"{name:32s} {time.time() - started:6.2f}s {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
