"""Run registered queries against their oracle: python tests/check.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from harness import compare, duck  # noqa: E402
from slotcast import session  # noqa: E402


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = session.build(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problems = compare(df, connection, sql[name])
                kind = "oracle"
            else:
                problems = [] if df.count() else ["no rows"]
                kind = "rows"
        except Exception as error:
            problems, kind = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:28}{kind:8}{time.time() - start:6.2f}s", flush=True)
        for problem in problems:
            print("     ", problem[:900], flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
