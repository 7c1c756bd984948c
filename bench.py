"""Benchmark: the three jobs end to end on the test tables; prints one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_OUT (scratch dir, default mktemp).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = os.environ.get("BENCH_OUT") or tempfile.mkdtemp(prefix="tillpoint-bench-")

    from tillpoint.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", app="tillpoint-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.sql.execution.arrow.pyspark.enabled": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    # stage outputs go to spark.checkpoint.dir as configured; a local folder is used only when it is unset

    from tillpoint.plans import jobs
    from tillpoint.sources import testdata as td

    # warm-up (class loading, JIT of the hot loops) on a smaller scale factor; not timed, reported in the output
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm) or os.path.abspath(warm) == os.path.abspath(sf_dir):
        warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        jobs.run_quality(spark, td.clientes_dq(spark, warm), td.REF_DATE)
        w = jobs.run_features(spark, td.vendas(spark, warm), f"{scratch}/warm_features", td.REF_DATE)
        warm_panel = jobs.panel_from_sales(spark.read.parquet(w.details["vendas_limpo"]), cleaned=True)
        jobs.run_forecast(spark, warm_panel, f"{scratch}/warm_forecast",
                          model_params={"RandomForest": {"numTrees": 5, "maxDepth": 3}})

    timings: dict[str, float] = {}
    details: dict[str, dict] = {}

    t = time.time()
    rep = jobs.run_features(spark, td.vendas(spark, sf_dir), f"{scratch}/features", td.REF_DATE)
    timings["features"] = round(time.time() - t, 3)
    details["features"] = {"status": rep.status, "rows": rep.rows, "tables": rep.tables, "stages": rep.stage_seconds}
    cleaned = rep.details["vendas_limpo"]

    t = time.time()
    rep = jobs.run_quality(spark, td.clientes_dq(spark, sf_dir), td.REF_DATE)
    timings["quality"] = round(time.time() - t, 3)
    details["quality"] = {"status": rep.status, "score": rep.details.get("score_qualidade"),
                          "severidade": rep.details.get("severidade")}

    t = time.time()
    # the forecast consumes the feature job's cleaned sales (a committed stage output), not the raw join again
    panel = jobs.panel_from_sales(spark.read.parquet(cleaned), cleaned=True)
    rep = jobs.run_forecast(spark, panel, f"{scratch}/forecast")
    timings["forecast"] = round(time.time() - t, 3)
    details["forecast"] = {"status": rep.status, "stages": rep.stage_seconds,
                           "n_treino": rep.details.get("n_treino"), "n_teste": rep.details.get("n_teste"),
                           "metricas": rep.details.get("metricas")}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "jobs_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "warmup": f"untimed run of the three jobs on {warm}", "details": details}
    print(json.dumps(out, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
