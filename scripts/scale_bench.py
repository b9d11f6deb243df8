"""Scale experiment: binding A's raw rows replicated x k (shifted ids), written
as a Parquet table partitioned by snapshot_date, then the headline models run
over it.  Reports seconds, shuffle bytes written and spill bytes per query
(from Spark's event log in the scratch folder; the UI stays off).

    python scripts/scale_bench.py --scratch "$(mktemp -d /tmp/run-XXXXXX)" --factors 1,10

A ``skew`` variant puts a third of all rows into one group (one language on
every snapshot) to show the top-N plan is unaffected by a hot group.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tidemark import get_spark  # noqa: E402
from tidemark.operators import breakouts as bo  # noqa: E402
from tidemark.operators.marts import top_repos  # noqa: E402
from tidemark.operators.staging import stage  # noqa: E402
from tidemark.operators.trends import language_trends  # noqa: E402
from tidemark.sources import bindings  # noqa: E402
from tidemark.sources.sinks import replace_table  # noqa: E402

ID_SHIFT = 10**9


def replicate(raw, k: int, skew: bool = False):
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    out = raw.withColumn("_rep", rep)
    out = out.withColumns(
        {
            "id": F.col("id") + F.col("_rep").cast("long") * F.lit(ID_SHIFT),
            "url": F.concat(F.col("url"), F.lit("#"), F.col("_rep").cast("string")),
        }
    )
    if skew:
        out = out.withColumn(
            "language", F.when(F.col("_rep") % 3 == 0, F.lit("Brand#1")).otherwise(F.col("language"))
        )
    return out.drop("_rep")


def shuffle_metrics(event_dir: str) -> dict[str, dict[str, int]]:
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in glob.glob(f"{event_dir}/**/*", recursive=True):
        if not os.path.isfile(path) or path.endswith(".inprogress.crc"):
            continue
        with open(path) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    out[group]["shuffle_bytes_written"] += m.get("Shuffle Write Metrics", {}).get(
                        "Shuffle Bytes Written", 0
                    )
                    out[group]["spill_bytes"] += m.get("Memory Bytes Spilled", 0) + m.get("Disk Bytes Spilled", 0)
                    out[group]["tasks"] += 1
    return {g: dict(v) for g, v in out.items()}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--factors", default="1,10")
    ap.add_argument("--scratch", required=True, help="fresh scratch folder (mktemp -d)")
    ap.add_argument("--cpus", default=os.environ.get("BENCH_CPUS", "8"))
    ap.add_argument("--shuffle-partitions", default="64")
    args = ap.parse_args()

    events = os.path.join(args.scratch, "events")
    os.makedirs(events, exist_ok=True)
    spark = get_spark(
        f"local[{args.cpus}]",
        shuffle_partitions=int(args.shuffle_partitions),
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    sc = spark.sparkContext
    raw = bindings.parts_per_quarter(spark, args.sf_dir)
    results = []
    variants = [(int(k), False) for k in args.factors.split(",")] + [(int(args.factors.split(",")[-1]), True)]
    for k, skew in variants:
        name = f"x{k}{'_skew' if skew else ''}"
        path = os.path.join(args.scratch, f"raw_{name}")
        sc.setJobGroup(f"{name}:write", "write")
        t = time.perf_counter()
        replace_table(replicate(raw, k, skew), path)
        write_sec = time.perf_counter() - t
        data = spark.read.parquet(path)
        rows = data.count()
        stg = stage(data)
        top = top_repos(stg)
        queries = {
            "top_repos": top,
            "language_trends": language_trends(stg),
            "breakouts": bo.breakouts(top, method="window"),
            "breakouts_join": bo.breakouts(top, method="join"),
        }
        for q, df in queries.items():
            df.write.format("noop").mode("overwrite").save()  # warm
            sc.setJobGroup(f"{name}:{q}", q)
            t = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            results.append({"data": name, "raw_rows": rows, "query": q, "sec": round(time.perf_counter() - t, 3)})
        results.append({"data": name, "raw_rows": rows, "query": "write_raw", "sec": round(write_sec, 3)})
    spark.stop()
    metrics = shuffle_metrics(events)
    for r in results:
        r.update(metrics.get(f"{r['data']}:{r['query'] if r['query'] != 'write_raw' else 'write'}", {}))
        print(json.dumps(r))


if __name__ == "__main__":
    main()
