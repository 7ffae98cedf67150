"""``python -m tidemark.verify <folder> [name ...]``: check queries against their SQL."""

from __future__ import annotations

import sys
import time
import traceback

from tidemark.session import build_session
from tidemark.verify.compare import differences, engine
from tidemark.verify.oracles import all_oracles
from tidemark.verify.queries import all_queries


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "verify",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = engine(folder), all_oracles()
    failed = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problems = differences(df, connection, sql[name]) if name in sql else []
        except Exception as error:  # report and go on with the other queries
            traceback.print_exc(limit=3)
            problems = [f"{type(error).__name__}: {str(error)[:400]}"]
        failed += bool(problems)
        status = "FAIL" if problems else "ok" if name in sql else "no sql"
        print(f"{status:6} {time.time() - start:6.2f}s {name} {' '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
