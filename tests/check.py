"""Run registered queries against their SQL: ``python tests/check.py [module-or-name-prefix ...]``."""

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from loomtab.session import build_session  # noqa: E402


def main():
    sf = os.environ.get("CHECK_SF", "/root/testdata/sf0.01")
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con = oracle.connect(sf)
    qs, sqls = e.queries(), e.oracle_sql()
    wanted = sys.argv[1:]
    if wanted:
        mods = {n for n in qs if qs[n].__closure__ and any(
            getattr(c.cell_contents, "__module__", "").split(".")[-1] in wanted for c in qs[n].__closure__)}
        names = [n for n in qs if n in mods or n in wanted]
    else:
        names = list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            msg = oracle.compare(spark, con, qs[n], sqls.get(n), sf)
        except Exception as ex:  # noqa: BLE001
            msg = "ERROR " + "".join(traceback.format_exception_only(ex))[:900]
        bad += msg is not None
        print(f"{'ok ' if msg is None else 'BAD'} {time.time() - t0:6.2f}s {n}{'' if n in sqls else ' (rows)'}"
              f"{'' if msg is None else ' -> ' + msg[:1200]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


main()
