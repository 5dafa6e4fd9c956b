"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input (default sf0.1), ``BENCH_CPUS`` the cores,
``BENCH_QUERIES`` a comma-separated choice (``all`` for every registered query).
Every figure is the median of three runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

import bindings  # noqa: E402
from bindings.tables import table  # noqa: E402
from marquetry.plans import production  # noqa: E402
from marquetry.session import local_session, remove_copies, scratch_path  # noqa: E402
from marquetry.sources.writers import write_jsonl  # noqa: E402

HEADLINE = [
    "entry_common_roles",
    "j01_referential_integrity",
    "j02_orphan_report",
    "j05_left_alignment",
    "a07_sum_by_two_keys",
    "a12_monthly_kpis",
    "a13_annual_summary",
    "a15_spend_by_category",
    "a19_quality_report",
    "a22_distinct_rows",
    "o02_most_common",
    "o04_top_rows",
    "p09_above_average",
    "w01_pct_change",
    "w03_keep_first",
    "w05_daily_running_balance",
    "u03_melt",
    "f01_clean_text",
    "f03_clean_year",
    "m02_replace_fields",
    "m06_import_absent",
    "m08_generate_recurring",
    "m10_latest_value",
    "m11_list_items",
    "s01_jsonl_scan",
    "s15_track_payloads",
    "education_kpis",
    "st1_sensor_decode",
    "st3_first_seen",
]


def sink(df) -> None:
    """Compute all rows and columns without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


# The crew's lines are landed so many times: the published clean crew is a bit more than half of its raw lines.
CREW_COPIES = 4


def land_raw(spark, sf: str) -> tuple[str, int]:
    """The given tables as untidy JSON lines for the cleaning job; path and line count."""
    base = scratch_path(spark, "bench-raw")
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id_pessoa"), F.concat(F.lit("  "), "c_name").alias("nome")
    )
    works = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id_producao"),
        F.concat(F.lit("Title   "), "o_orderkey").alias("titulo"),
        F.concat(F.lit("#"), F.year("o_orderdate")).alias("ano"),
        F.substring("o_orderpriority", 1, 1).alias("tipo_id"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.lit(CREW_COPIES)))
    crew = table(spark, sf, "lineitem").withColumn("_copy", copies).select(
        F.col("l_orderkey").alias("id_producao"),
        F.col("l_partkey").alias("id_pessoa"),
        F.concat(F.lit(" "), "l_returnflag", F.when(F.col("_copy") > 2, F.col("_copy").cast("string")).otherwise("")).alias("papel"),
    )
    lines = 0
    for name, df in (("pessoa", people), ("producao", works), ("equipe", crew)):
        write_jsonl(df, f"{base}/{name}.jsonl")
        lines += df.count()
    return base, lines


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(bindings.QUERIES) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)
    spark = local_session(cores, "bench")
    raw, lines = land_raw(spark, sf)

    def clean() -> None:
        sink(production.run(spark, raw, scratch_path(spark, "bench-clean")))

    jobs = {n: (lambda n=n: sink(bindings.QUERIES[n](spark, sf))) for n in names}
    jobs["cleaning_job"] = clean
    runs = [{name: timed(job) for name, job in jobs.items()} for _ in range(3)]
    times = {name: round(median(r[name] for r in runs), 3) for name in jobs}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "runs_sec": [round(sum(r.values()), 3) for r in runs],
                "cleaning_lines": lines,
                "cleaning_records_per_sec": round(lines / times["cleaning_job"]),
            }
        )
    )
    remove_copies(spark)
    spark.stop()


if __name__ == "__main__":
    main()
