"""The whole pipeline from landed files to gold, for one date and for many."""

from __future__ import annotations

import json
import os
import random
import subprocess
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import quality, tables
from tidemark.operators.clean import clean_all
from tidemark.plans import analytics, job
from tidemark.sources import read_snapshots

ROOT = Path(__file__).resolve().parents[1]
DATES = [date(2026, 7, 18) + timedelta(days=n) for n in range(3)]
LINES = ["bakerloo", "central", "waterloo-city", "jubilee", "northern", "victoria"]


def snapshot(rng, stations=110):
    lines = []
    for name in LINES:
        statuses = [
            {"statusSeverity": s, "statusSeverityDescription": " d ", "disruption": {"description": " late "} if s != 10 else None}
            for s in rng.choices(range(21), k=rng.randrange(3))
        ]
        lines.append({"id": name, "name": f" {name}\n", "lineStatuses": statuses})
    points = []
    for n in range(stations):
        docks = rng.randrange(30)
        bikes = rng.randrange(docks + 1)
        counts = {"NbBikes": bikes, "NbEmptyDocks": docks - bikes, "NbDocks": docks}
        points.append({
            "id": f"BikePoints_{n}", "commonName": f"Stop {n} ", "lat": 51.5 + n / 1000, "lon": -n / 1000,
            "additionalProperties": [{"key": k, "value": str(v)} for k, v in counts.items()],
        })
    forecasts = [
        {"forecastType": kind, "forecastBand": rng.choice(["Low", "Moderate"]), "forecastSummary": "s",
         "nO2Band": "Low", "o3Band": "Low", "pM10Band": "Low", "pM25Band": "Low", "sO2Band": "Low"}
        for kind in ("Current", "Future")
    ]
    return {"line_status": lines, "bike_points": points, "air_quality": {"currentForecast": forecasts}}


def land(folder, day, hour, documents):
    for dataset, document in documents.items():
        path = folder / dataset / f"date={day}"
        path.mkdir(parents=True, exist_ok=True)
        envelope = {"extracted_at": f"{day}T{hour:02d}:15:30.000001+00:00", "payload": json.dumps(document)}
        (path / f"{hour:02d}.json").write_text(json.dumps(envelope) + "\n")


@pytest.fixture
def landing(tmp_path):
    rng = random.Random(7)
    folder = tmp_path / "landing"
    for day in DATES:
        for hour in (8, 12, 16):
            land(folder, day, hour, snapshot(rng))
    return folder


def content(spark, database):
    return {
        name: sorted(map(repr, tables.read_table(spark, database, table).collect()))
        for name, table in schemas.TABLES.items()
    }


def run(spark, landing, database, dates, tmp_path, **more):
    job.run(spark, str(landing), database, dates, f"{tmp_path}/{database}", **more)


def test_backfill_equals_one_date_at_a_time(spark, landing, database, tmp_path):
    run(spark, landing, database, DATES, tmp_path)
    at_once = content(spark, database)
    assert len(at_once["bronze_bike_points"]) == 3 * 3 * 110
    assert len(at_once["gold_daily_line_summary"]) == 3 * len(LINES)
    assert len(at_once["gold_hourly_bike_summary"]) == 3 * 3 * 110
    assert all(at_once.values())
    single = f"{database}_single"
    try:
        for day in DATES:
            run(spark, landing, single, [day], tmp_path)
        assert content(spark, single) == at_once
        # Again, for one date: nothing doubles and nothing goes missing.
        run(spark, landing, single, [DATES[1]], tmp_path)
        assert content(spark, single) == at_once
        # And with the daily tables merged from the hourly state.
        job.build_gold(spark, single, DATES, share_hourly=True)
        assert content(spark, single) == at_once
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {single} CASCADE")


def test_new_snapshot_joins_its_day(spark, landing, database, tmp_path):
    run(spark, landing, database, DATES[:1], tmp_path)
    land(landing, DATES[0], 20, snapshot(random.Random(8)))
    run(spark, landing, database, DATES[:1], tmp_path)
    totals = analytics.row_totals(*(tables.read_table(spark, database, t) for t in schemas.BRONZE.values())).first()
    assert totals.bike_points_rows == 4 * 110 and totals.air_quality_rows == 8
    hours = tables.read_table(spark, database, schemas.GOLD_HOURLY_LINE).select("summary_hour").distinct()
    assert sorted(r.summary_hour for r in hours.collect()) == [8, 12, 16, 20]


def faulty(fault):
    bad = snapshot(random.Random(9), stations=99 if fault == "few stations" else 110)
    if fault == "bad band":
        bad["air_quality"]["currentForecast"][0]["forecastBand"] = " Low"
    if fault == "bad severity":
        bad["line_status"][0]["lineStatuses"] = [{"statusSeverity": 21}]
    if fault == "empty document":
        bad["line_status"] = []
    return bad


def test_failed_gate_leaves_the_tables_alone(spark, landing, database, tmp_path):
    run(spark, landing, database, DATES[:2], tmp_path)
    before = content(spark, database)
    with pytest.raises(quality.QualityError, match="2026-08-01, snapshots=0"):
        run(spark, landing, database, [*DATES[:2], date(2026, 8, 1)], tmp_path)
    for fault in ("few stations", "bad band", "bad severity", "empty document"):
        land(landing, DATES[0], 22, faulty(fault))
        with pytest.raises(quality.QualityError) as error:
            run(spark, landing, database, DATES[:2], tmp_path)
        assert str(error.value).count("dataset=") == 1, fault
    assert content(spark, database) == before


def test_snapshot_in_the_wrong_folder_fails_the_gate(spark, landing, database, tmp_path):
    wrong = landing / "air_quality" / f"date={DATES[0]}" / "08.json"
    wrong.write_text(wrong.read_text().replace(str(DATES[0]), "2026-07-01"))
    with pytest.raises(quality.QualityError, match="dataset=air_quality, extracted_date=None.*first_stray=2026-07-01"):
        run(spark, landing, database, DATES[:1], tmp_path)


def test_staged_load_gives_the_same_tables(spark, landing, database, tmp_path, monkeypatch):
    run(spark, landing, database, DATES[:2], tmp_path, staged=True)
    staged, other = content(spark, database), f"{database}_once"
    monkeypatch.setattr(job, "stage", lambda *a: pytest.fail("nothing is staged"))
    try:
        run(spark, landing, other, DATES[:2], tmp_path)
        assert content(spark, other) == staged
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {other} CASCADE")


@pytest.mark.parametrize("staged", [False, True])
def test_document_landed_twice_fails_its_date(spark, landing, database, tmp_path, staged):
    path = landing / "bike_points" / f"date={DATES[1]}"
    envelope = (path / "08.json").read_text()
    (path / "08-again.json").write_text(envelope)
    with pytest.raises(quality.QualityError) as error:
        run(spark, landing, database, DATES, tmp_path, staged=staged)
    assert str(error.value).count("dataset=") == 1
    assert f"dataset=bike_points, extracted_date={DATES[1]}" in str(error.value) and "repeated_documents=1" in str(error.value)
    # As another page of the snapshot it is no repetition; an empty document is told too.
    (path / "08-again.json").write_text(json.dumps(json.loads(envelope) | {"page": 1}) + "\n")
    run(spark, landing, database, DATES, tmp_path, staged=staged)
    assert tables.read_table(spark, database, schemas.BRONZE_BIKE_POINTS, DATES[1:2]).count() == 4 * 110


def test_failed_gate_leaves_no_files(spark, landing, database, tmp_path):
    run(spark, landing, database, DATES[:1], tmp_path)
    before = sorted(p.name for p in (tmp_path / database).rglob("load=*"))
    land(landing, DATES[0], 22, faulty("bad band"))
    with pytest.raises(quality.QualityError):
        run(spark, landing, database, DATES[:1], tmp_path)
    assert sorted(p.name for p in (tmp_path / database).rglob("load=*")) == before


@pytest.mark.parametrize("dataset", schemas.DATASETS)
def test_cleaner_of_nothing_fails_the_load(spark, landing, database, tmp_path, dataset):
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    records = read_snapshots(spark, str(landing), DATES[:1])
    job.load_bronze(spark, clean_all(records), database, DATES[:1])
    before = content(spark, database)
    empty = clean_all(records | {dataset: records[dataset].where("false")})
    with pytest.raises(quality.QualityError, match=f"no {dataset.replace('_', ' ')} records to clean"):
        job.load_bronze(spark, empty, database, DATES[:1])
    none_left = clean_all(records)
    none_left[dataset] = none_left[dataset].withColumn("kept", F.lit(False))
    with pytest.raises(quality.QualityError, match=f"cleaned {dataset.replace('_', ' ')} is empty"):
        job.load_bronze(spark, none_left, database, DATES[:1])
    assert content(spark, database) == before


def test_tidy_removes_replaced_rows(spark, landing, database, tmp_path, monkeypatch):
    for _ in range(2):
        run(spark, landing, database, DATES[:1], tmp_path)
    before, folder = content(spark, database), tmp_path / database
    monkeypatch.setattr(job, "build_session", lambda: spark)
    old = (datetime.now() - timedelta(days=2)).timestamp()
    for load in folder.rglob("load=*"):
        os.utime(load, (old, old))
    job.main(["tidy", "--database", database])
    assert len(list(folder.rglob("load=*"))) == 8 and content(spark, database) == before


def test_scratch_folder_is_removed(spark, landing, database, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("tidemark-*"))
    run(spark, landing, database, DATES[:1], tmp_path, staged=True)
    assert set(shared.glob("tidemark-*")) == before


def test_wrong_session_settings_are_refused(spark, landing, database, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            run(spark, landing, database, DATES[:1], tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_command_line_covers_a_range(monkeypatch):
    seen = {}
    monkeypatch.setattr(job, "build_session", lambda: "session")
    monkeypatch.setattr(job, "run", lambda *arguments, **more: seen.update(arguments=arguments, **more))
    job.main(["--landing", "in", "--database", "db", "--first", "2026-07-18", "--last", "2026-07-20"])
    assert seen["arguments"] == ("session", "in", "db", DATES, None)
    assert (seen["checked_gold"], seen["scratch"]) == (quality.DAILY_GOLD, None)
    job.main(["load", "--landing", "in", "--database", "db", "--first", "2026-07-18", "--location", "out",
              "--scratch", "tmp", "--check-hourly"])
    assert seen["arguments"] == ("session", "in", "db", DATES[:1], "out")
    assert (seen["checked_gold"], seen["scratch"]) == (quality.DAILY_GOLD + quality.HOURLY_GOLD, "tmp")


def test_command_line_rebuilds_gold_and_repartitions(spark, landing, database, tmp_path, monkeypatch):
    run(spark, landing, database, DATES[:2], tmp_path)
    before = content(spark, database)
    spark.sql(f"TRUNCATE TABLE {database}.gold_daily_air_quality")
    monkeypatch.setattr(job, "build_session", lambda: spark)
    days = ["--first", str(DATES[0]), "--last", str(DATES[1])]
    job.main(["gold", "--database", database, *days, "--check-hourly"])
    assert content(spark, database) == before
    with pytest.raises(quality.QualityError, match="rows_loaded=0"):
        job.main(["gold", "--database", database, "--first", "2026-08-01"])
    job.main(["repartition", "--database", database])
    assert content(spark, database) == before


@pytest.mark.parametrize("arguments", [["--database", "db", "--first", "2026-07-18"], ["gold", "--database", "db"]])
def test_command_line_names_what_is_missing(arguments, capsys):
    with pytest.raises(SystemExit):
        job.main(arguments)
    assert "needs --" in capsys.readouterr().err


PLAIN = """
import sys
from datetime import date
from pathlib import Path
from tidemark.operators import tables
from tidemark.plans import job
from tidemark.session import build_session

landing, folder = sys.argv[1:]
settings = {"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}
spark = build_session("plain", **settings, **{"spark.sql.warehouse.dir": f"{folder}/warehouse"})
assert spark.conf.get("spark.checkpoint.dir", None) is None
for scratch in (None, f"{folder}/scratch"):
    job.run(spark, landing, "plain", [date(2026, 7, 18)], scratch=scratch)
assert spark.table("plain.bronze_bike_points").count() == 330
assert not list(Path(folder).rglob("tidemark-*"))
print("done")
"""


def test_session_without_a_shared_folder(landing, tmp_path):
    """A fresh process with Spark's own defaults only."""
    (tmp_path / "conf").mkdir()
    environment = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, "-c", PLAIN, str(landing), str(tmp_path)],
        env=environment, cwd=tmp_path, capture_output=True, text=True, timeout=600,
    )
    assert done.stdout.endswith("done\n"), done.stderr[-3000:]
