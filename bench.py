"""Time the layer stages on the driver's tables and print one JSON line.

Stages follow the reference's run log: ingest (land the source as CSV,
one folder per dataset), raw, profiling, cleaned, transformed, hashed.
The source is the ``tx`` view over the star schema (one row per line
item). Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1),
``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from layerflow.operators import profile  # noqa: E402
from layerflow.plans import fixtures, layers  # noqa: E402
from layerflow.plans.registry import tx_spec  # noqa: E402
from layerflow.plans.run import Runner  # noqa: E402
from layerflow.schema import RAW_SCHEMA  # noqa: E402
from layerflow.session import build_session, scratch_path  # noqa: E402
from layerflow.sources import csv as csvsrc  # noqa: E402
from layerflow.sources.store import TableStore  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "8g"}
    if os.environ.get("BENCH_EVENTLOG"):  # stage and task times, read offline
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG"]})
    spark = build_session(f"local[{cpus}]", "layerflow-bench", shuffle_partitions=max(cpus * 2, 8), extra=extra)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    # ingest: land the source rows as CSV, one folder per dataset (year)
    t0 = time.perf_counter()
    landing = scratch_path(spark, "bench", "landing")
    src = fixtures.tx(spark, sf_dir, row_id=False).withColumn("dataset_id", F.substring("month", 1, 4))
    csvsrc.land_csv(src, landing)
    landed = csvsrc.landed_counts(spark.read.option("header", "true").csv(landing)).collect()
    rows["source"] = sum(r["rows"] for r in landed)
    times["ingest"] = time.perf_counter() - t0

    store = TableStore(spark, scratch_path(spark, "bench", "store"))
    runner = Runner(spark, store, tx_spec())

    # raw: scan the landed files with the declared schema, range + blank filter, gate
    t0 = time.perf_counter()
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(c, T.IntegerType() if t == "int" else T.LongType())
                                             for c, t in fixtures.TX_LINEAGE_TYPES.items()])
    source = csvsrc.scan_csv(spark, landing, schema)
    runner.raw(source.drop("dataset_id"), rows["source"])
    rows["raw"] = store.count("raw")
    times["raw"] = time.perf_counter() - t0

    # profiling: profile frames of the raw layer, written as JSON
    t0 = time.perf_counter()
    raw = store.read("raw")
    text_cols = ["month", "town", "flat_type", "block", "street_name", "storey_range", "flat_model"]
    spec = layers.LayerSpec()

    def keep(df):
        return spark.read.parquet(store.stage_write(df, "profiling"))

    frames = profile.profile_report(raw, text_cols, ["floor_area_sqm", "resale_price", "lease_commence_date"],
                                    ["town", "flat_type", "flat_model"], spec.natural_key,
                                    range_col="storey_range", format_col="block", reuse=keep, name="raw")
    profile.write_profile(frames, scratch_path(spark, "bench", "profile"))
    times["profiling"] = time.perf_counter() - t0

    for stage in ("cleaned", "transformed", "hashed"):
        t0 = time.perf_counter()
        getattr(runner, stage)()
        rows[stage] = store.count(stage)
        times[stage] = time.perf_counter() - t0

    total = sum(times.values())
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "layer_stages_total", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "rows": rows, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
