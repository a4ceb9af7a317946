"""

Uses the same settings as bench.py: BENCH_SF_DIR and BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import bench_session, timed  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import warehouse as stored  # noqa: E402
from tidemark import schemas  # noqa: E402
from tidemark.operators import gold, tables  # noqa: E402
from tidemark.plans import job  # noqa: E402
from tidemark.session import scratch_folder  # noqa: E402
from tidemark.sources import read_snapshots  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def bytes_of(files: list[str]) -> int:
    return sum(Path(file.removeprefix("file:")).stat().st_size for file in files)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = bench_session()
    built = stored.warehouse(spark, sf_dir)
    rebuild = partial(job.build_gold, spark, built.database)
    bikes = built.table(spark, schemas.BRONZE_BIKE_POINTS)

    def one_by_one() -> None:
        for day in built.dates:
            rebuild([day])

    def both_grains(bikes, share: bool) -> None:
        state = gold.hourly_bike_state(bikes)
        if share:
            state = state.persist()
            noop(gold.finish_bike(state, schemas.GOLD_HOURLY_BIKE))
            noop(gold.finish_bike(gold.merge_bike_state(state, gold.DAY), schemas.GOLD_DAILY_BIKE))
            state.unpersist()
        else:
            noop(gold.hourly_bike(bikes))
            noop(gold.daily_bike(bikes))

    landing = stored.land(spark, sf_dir, f"{scratch_folder(spark)}/landing")

    def load(staged: bool) -> str:
        """One load of all dates by either plan, without gold; where it is."""
        database, location = stored.new_database(), scratch_folder(spark)
        more = (built.dates, location, stored.MIN_RECORDS)
        if staged:
            job._load_staged(spark, landing, database, *more, None)
        else:
            job._load_once(spark, landing, database, *more)
        return database

    rebuild(built.dates)
    loads = {}
    for staged in (False, True, False, True):
        name = "load_staged" if staged else "load_once"
        loads[name] = min(loads.get(name, float("inf")), timed(lambda: load(staged)))
    records = read_snapshots(spark, landing, built.dates, keep_empty=True)
    flat = job.stage(records, scratch_folder(spark))
    loads["staged_bytes"] = bytes_of([f for frame in flat.values() for f in frame.inputFiles()])
    results = loads | {"all_dates_one_job": timed(lambda: rebuild(built.dates)), "all_dates_one_by_one": timed(one_by_one)}

    dense = stored.new_database()
    tables.ensure_tables(spark, dense, scratch_folder(spark))
    repeated = bikes.withColumn("second", F.explode(F.sequence(F.lit(0), F.lit(11))))
    later = F.col("extracted_at") + F.make_dt_interval(secs=F.col("second"))
    tables.load_table(
        repeated.withColumn("extracted_at", later), dense, schemas.BRONZE_BIKE_POINTS, built.dates
    )
    many = tables.read_table(spark, dense, schemas.BRONZE_BIKE_POINTS)
    for rows, frame in (("sparse", bikes), ("dense", many)):
        for share in (True, False):
            both_grains(frame, share)
            name = f"both_grains_{rows}_{'shared' if share else 'separate'}"
            results[name] = min(timed(lambda: both_grains(frame, share)) for _ in range(3))

    whole = [f for t in schemas.BRONZE.values() for f in built.table(spark, t).inputFiles()]
    one_day = [
        f
        for t in schemas.BRONZE.values()
        for f in tables.read_table(spark, built.database, t, built.dates[:1]).inputFiles()
    ]
    results |= {
        "dates": len(built.dates),
        "bronze_files": len(whole),
        "bronze_bytes": bytes_of(whole),
        "one_date_files": len(one_day),
        "one_date_bytes": bytes_of(one_day),
    }
    print(json.dumps({name: round(value, 3) for name, value in results.items()}))
    spark.stop()


if __name__ == "__main__":
    main()
