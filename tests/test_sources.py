"""Flattening of landed documents."""

from __future__ import annotations

import json
from datetime import date

import pytest

from tidemark import schemas
from tidemark.sources import (
    flatten_air_quality,
    flatten_bike_points,
    flatten_line_status,
    read_documents,
    read_snapshots,
)

AT = "2026-07-20T08:00:00.123456+00:00"


def documents(spark, *payloads):
    rows = [(AT, p if isinstance(p, str) or p is None else json.dumps(p)) for p in payloads]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


LINE_COLUMNS = ("line_id", "status_severity", "status_description", "disruption_reason", "is_disrupted")


def test_line_without_statuses_has_good_service(spark):
    docs = documents(
        spark,
        [{"id": "a", "name": "A"}, {"id": "b", "name": "B", "lineStatuses": []}],
        [{"id": "c", "name": "C", "lineStatuses": None}],
    )
    good = (10, "Good Service", None, False)
    assert rows(flatten_line_status(docs), *LINE_COLUMNS) == [(i, *good) for i in "abc"]


def test_one_row_per_status_with_defaults(spark):
    docs = documents(
        spark,
        [
            {
                "id": "a",
                "lineStatuses": [
                    {"statusSeverity": 9, "statusSeverityDescription": "Minor", "disruption": {"description": " x "}},
                    {"statusSeverity": 10},
                    {"statusSeverity": 20, "disruption": None},
                    {"disruption": {}},
                ],
            }
        ],
    )
    assert rows(flatten_line_status(docs), *LINE_COLUMNS) == [
        ("a", 10, "Good Service", None, False),
        ("a", 10, "Good Service", None, False),
        ("a", 20, "Good Service", None, True),
        ("a", 9, "Minor", " x ", True),
    ]
    assert rows(flatten_line_status(docs), "line_name", "extracted_at")[0] == ("", AT)


def test_bike_counts_come_from_the_property_list(spark):
    def point(identifier, properties, **more):
        return {"id": identifier, "commonName": "P", "additionalProperties": properties, **more}

    docs = documents(
        spark,
        [
            point(
                "BikePoints_1",
                [
                    {"key": "NbBikes", "value": "3"},
                    {"key": "NbBikes", "value": "4"},
                    {"key": "NbEmptyDocks", "value": ""},
                    {"key": "Other", "value": "9"},
                ],
                lat=51.5,
                lon=-0.1,
            ),
            point(
                "BikePoints_2",
                [{"key": "NbBikes"}, {"key": "NbEmptyDocks", "value": " 7 "}, {"key": "NbDocks", "value": 20}],
                lat="51.25",
            ),
            {"commonName": "Q"},
        ],
    )
    got = rows(flatten_bike_points(docs), "bike_point_id", "name", "lat", "lon", "nb_bikes", "nb_empty_docks", "nb_docks")
    assert got == [
        ("", "Q", None, None, 0, 0, 0),
        ("BikePoints_1", "P", 51.5, -0.1, 4, 0, 0),
        ("BikePoints_2", "P", 51.25, None, 0, 7, 20),
    ]


def test_air_fields_are_renamed(spark):
    docs = documents(
        spark,
        {
            "currentForecast": [
                {
                    "forecastType": "Current",
                    "forecastBand": "Low",
                    "forecastSummary": "s",
                    "nO2Band": "n",
                    "o3Band": "o",
                    "pM10Band": "p10",
                    "pM25Band": "p25",
                    "sO2Band": "s2",
                },
                {"forecastType": "Future"},
            ]
        },
        {"currentForecast": []},
        {},
    )
    got = rows(flatten_air_quality(docs), "forecast_type", "forecast_band", "forecast_summary", *schemas.POLLUTANT_BANDS)
    assert got == [("Current", "Low", "s", "n", "o", "p10", "p25", "s2"), ("Future", "", "", "", "", "", "", "")]


def test_empty_documents_can_be_kept(spark):
    air = flatten_air_quality(documents(spark, {}, {"currentForecast": [{"forecastBand": "Low"}]}), keep_empty=True)
    assert rows(air, "is_record", "forecast_band") == [(False, ""), (True, "Low")]
    line = flatten_line_status(documents(spark, [], [{"id": "a"}]), keep_empty=True)
    assert rows(line, "is_record", "line_id") == [(False, ""), (True, "a")]
    bike = flatten_bike_points(documents(spark, [], [{"id": "a"}]), keep_empty=True)
    assert rows(bike, "is_record", "bike_point_id") == [(False, ""), (True, "a")]
    assert flatten_bike_points(documents(spark, [])).count() == 0


@pytest.mark.parametrize("keep_empty", [False, True])
@pytest.mark.parametrize(
    ("flatten", "payload"),
    [
        (flatten_line_status, "not json"),
        (flatten_line_status, ""),
        (flatten_line_status, "null"),
        (flatten_line_status, None),
        (flatten_line_status, "[null]"),
        (flatten_line_status, '{"httpStatusCode": 429, "message": "slow down"}'),
        (flatten_line_status, ' {"id": "a"}'),
        (flatten_bike_points, '{"id": "BikePoints_1"}'),
        (flatten_bike_points, '[{"additionalProperties": [null]}]'),
        (flatten_bike_points, '[{"additionalProperties": [{"value": "3"}]}]'),
        (flatten_air_quality, '[{"currentForecast": []}]'),
        (flatten_line_status, '[{"lineStatuses": [null]}]'),
        (flatten_line_status, '[{"lineStatuses": [{"statusSeverity": "bad"}]}]'),
        (flatten_bike_points, "[null]"),
        (flatten_bike_points, '[{"lat": "north"}]'),
        (flatten_bike_points, '[{"additionalProperties": [{"key": "NbDocks", "value": "many"}]}]'),
        (flatten_air_quality, '{"currentForecast": [null]}'),
        (flatten_air_quality, '{"currentForecast": ['),
    ],
)
def test_malformed_documents_fail(spark, flatten, payload, keep_empty):
    with pytest.raises(Exception):
        flatten(documents(spark, payload), keep_empty).collect()


def land(folder, dataset, day, *envelopes):
    path = folder / dataset / f"date={day}"
    path.mkdir(parents=True)
    (path / "part.json").write_text("".join(json.dumps(e) + "\n" for e in envelopes))


def test_read_snapshots_prunes_by_date(spark, tmp_path):
    for day in ("2026-07-19", "2026-07-20"):
        at = f"{day}T08:00:00+00:00"
        land(tmp_path, "line_status", day, {"extracted_at": at, "payload": json.dumps([{"id": day}])})
        land(tmp_path, "bike_points", day, {"extracted_at": at, "payload": json.dumps([{"id": day}] * 2)})
        land(tmp_path, "air_quality", day, {"extracted_at": at, "payload": json.dumps({"currentForecast": [{}]})})
    wanted = [date(2026, 7, 20)]
    frames = read_snapshots(spark, str(tmp_path), wanted)
    assert {name: frame.count() for name, frame in frames.items()} == {
        "line_status": 1,
        "bike_points": 2,
        "air_quality": 1,
    }
    assert [r.line_id for r in frames["line_status"].collect()] == ["2026-07-20"]
    assert {n: f.count() for n, f in read_snapshots(spark, str(tmp_path)).items()}["bike_points"] == 4
    files = read_documents(spark, str(tmp_path), "line_status", wanted).inputFiles()
    assert [f.split("/")[-2] for f in files] == ["date=2026-07-20"]


def test_other_folders_are_not_looked_into(spark, tmp_path):
    at = "2026-07-20T08:00:00+00:00"
    land(tmp_path, "line_status", "2026-07-20", {"extracted_at": at, "payload": "[]"})
    land(tmp_path, "line_status", "2024-01-99", {"extracted_at": at, "payload": "[]"})
    read = lambda *days: read_documents(spark, str(tmp_path), "line_status", days)
    assert read(date(2026, 7, 20)).count() == 1
    # Dates that nothing landed for, and a dataset without a folder, have no documents.
    assert read(date(2026, 7, 20), date(2026, 7, 21)).count() == 1
    assert read(date(2026, 7, 21)).count() == 0
    assert read_documents(spark, str(tmp_path), "air_quality", [date(2026, 7, 20)]).count() == 0


def test_malformed_envelope_fails(spark, tmp_path):
    path = tmp_path / "air_quality" / "date=2026-07-20"
    path.mkdir(parents=True)
    (path / "part.json").write_text('{"extracted_at": ')
    with pytest.raises(Exception):
        read_documents(spark, str(tmp_path), "air_quality").collect()
