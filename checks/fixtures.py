"""Snapshot data derived from the test tables.

Everything is a projection or an explode of ``events`` or ``orders``: no
document is gathered from a group, so no group can grow into one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "extracted_date", F.to_date("ts")
    )


def iso(instant: Column) -> Column:
    return F.date_format(instant, ISO)


def text(number: Column) -> Column:
    return number.cast("string")


# --- bronze shapes -------------------------------------------------------------


def line_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.col("k") % 21
    return events(spark, sf_dir).select(
        F.col("ts").alias("extracted_at"),
        "extracted_date",
        F.col("event_type").alias("line_id"),
        F.concat(F.upper(F.left("event_type", F.lit(1))), F.substr("event_type", F.lit(2))).alias("line_name"),
        severity.alias("status_severity"),
        (severity != 10).alias("is_disrupted"),
    )


def bike_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("double")
    bikes, docks = F.floor("value").cast("int") % 45, F.col("k") % 40
    at_least_one = F.when(docks == 0, 1).otherwise(docks)
    return events(spark, sf_dir).select(
        F.col("ts").alias("extracted_at"),
        "extracted_date",
        F.col("user_id").cast("int").alias("station_id"),
        F.concat(F.lit("Stop "), text(F.col("user_id"))).alias("name"),
        (F.lit(51.0) + user / F.lit(1000.0)).alias("lat"),
        (F.lit(0.0) - user / F.lit(1000.0)).alias("lon"),
        bikes.alias("nb_bikes"),
        F.greatest(docks - bikes, F.lit(0)).alias("nb_empty_docks"),
        docks.alias("nb_docks"),
        (F.rint(bikes / at_least_one * 100 * 100) / 100).alias("occupancy_pct"),
    )


def air_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    bands = F.array(*map(F.lit, ("Low", "Moderate", "High", "Very High", "Unrated")))
    return events(spark, sf_dir).select(
        F.col("ts").alias("extracted_at"),
        "extracted_date",
        F.col("event_type").alias("forecast_type"),
        F.get(bands, k % 5).alias("forecast_band"),
        ((k % 5 + 1) % 5).alias("forecast_score"),
        F.concat(F.lit("A"), text(k % 7)).alias("no2_band"),
        F.concat(F.lit("B"), text(k % 3)).alias("o3_band"),
        F.concat(F.lit("C"), text(k % 2)).alias("pm10_band"),
        F.concat(F.lit("D"), text(k % 11)).alias("pm25_band"),
        F.concat(F.lit("E"), text(k % 4)).alias("so2_band"),
    )


# --- flat records --------------------------------------------------------------


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.col("k") % 22
    return events(spark, sf_dir).select(
        iso(F.col("ts")).alias("extracted_at"),
        F.col("event_type").alias("line_id"),
        F.concat(F.lit("\t"), "event_type", F.lit("-LINE o'"), text(F.col("k")), F.lit("x \n")).alias("line_name"),
        severity.alias("status_severity"),
        F.concat(F.lit("  status "), text(severity), F.lit("\t")).alias("status_description"),
        F.when(severity != 10, F.concat(F.lit("\n because "), "event_type", F.lit(" "))).alias("disruption_reason"),
        (severity != 10).alias("is_disrupted"),
    )


def bike_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("double")
    return events(spark, sf_dir).select(
        iso(F.col("ts")).alias("extracted_at"),
        F.concat(F.lit("BikePoints_"), text(F.col("user_id"))).alias("bike_point_id"),
        F.concat(F.lit(" Stop "), text(F.col("user_id")), F.lit("\r\n")).alias("name"),
        # Some stations have no position.
        F.when(F.col("k") % 9 != 4, F.lit(51.0) + user / F.lit(1000.0)).alias("lat"),
        F.when(F.col("k") % 9 != 4, F.lit(0.0) - user / F.lit(1000.0)).alias("lon"),
        (F.floor("value").cast("int") % 45).alias("nb_bikes"),
        (F.col("k") % 13).alias("nb_empty_docks"),
        (F.col("k") % 40).alias("nb_docks"),
    )


def air_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    bands = F.array(*map(F.lit, ("Low", " Moderate", "High\t", "\nVery High ", "Extreme", "")))
    return events(spark, sf_dir).select(
        iso(F.col("ts")).alias("extracted_at"),
        F.concat(F.lit(" "), "event_type").alias("forecast_type"),
        F.get(bands, k % 6).alias("forecast_band"),
        F.concat(F.lit("summary "), text(k), F.lit("\n")).alias("forecast_summary"),
        F.concat(F.lit("A"), text(k % 7), F.lit(" ")).alias("no2_band"),
        F.concat(F.lit("\tB"), text(k % 3)).alias("o3_band"),
        F.concat(F.lit("C"), text(k % 2)).alias("pm10_band"),
        F.concat(F.lit("D"), text(k % 11)).alias("pm25_band"),
        F.concat(F.lit("E"), text(k % 4)).alias("so2_band"),
    )


def gate_records(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Flat records with violations; a snapshot is an hour of events."""
    k = F.col("k")
    bands = F.array(*map(F.lit, ("Low", "Moderate", "High", "Very High", " Low", "Extreme", "")))
    at = iso(F.date_trunc("hour", "ts")).alias("extracted_at")
    ev = events(spark, sf_dir)
    return {
        "line_status": ev.select(at, (k % 23 - 1).alias("status_severity")),
        "bike_points": ev.select(
            at, (F.floor("value").cast("int") % 45 - 1).alias("nb_bikes"), (k % 40 - 1).alias("nb_docks")
        ),
        "air_quality": ev.select(at, F.get(bands, k % 7).alias("forecast_band")),
    }


def faulty_records(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same with a document per event: some are empty, for air quality all of one hour, and some are there twice."""
    k = F.col("k")
    copies = F.explode(F.array_repeat(F.lit(1), F.when(k % 41 == 5, 2).otherwise(1)))
    ev = events(spark, sf_dir).withColumn("copy", copies)
    bands = F.array(*map(F.lit, ("Low", "Moderate", "High", "Very High", " Low", "Extreme", "")))
    values = {
        "line_status": [(k % 23 - 1).alias("status_severity")],
        "bike_points": [(F.floor("value").cast("int") % 45 - 1).alias("nb_bikes"), (k % 40 - 1).alias("nb_docks")],
        "air_quality": [F.get(bands, k % 7).alias("forecast_band")],
    }
    hour = {"air_quality": F.hour("ts") != 5}
    return {
        name: ev.select(
            iso(F.date_trunc("hour", "ts")).alias("extracted_at"), F.col("event_id").alias("document"),
            (hour.get(name, F.lit(True)) & (k % 50 != 7)).alias("is_record"), *columns,
        )
        for name, columns in values.items()
    }


# --- documents -----------------------------------------------------------------


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order: none to three statuses, with members left out."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def status(i: Column) -> Column:
        return F.struct(
            F.when((key + i) % 5 != 0, (customer + i * 3) % 21).alias("statusSeverity"),
            F.when((customer + i) % 7 != 0, F.concat(F.lit(" d"), text(i))).alias("statusSeverityDescription"),
            F.when(
                (customer + i) % 3 == 0,
                F.struct(F.when(key % 2 == 0, F.concat(F.lit("late "), text(key))).alias("description")),
            ).alias("disruption"),
        )

    several = F.transform(F.sequence(F.lit(1), (key % 4).cast("int")), status)
    statuses = F.when(key % 8 == 4, F.slice(F.array(status(F.lit(1))), 1, 0)).when(key % 4 != 0, several)
    line = F.struct(
        F.concat(F.lit("line-"), text(customer % 11)).alias("id"),
        F.col("o_orderpriority").alias("name"),
        statuses.alias("lineStatuses"),
    )
    return orders.select(iso(F.col("o_orderdate")).alias("extracted_at"), F.to_json(F.array(line)).alias("payload"))


def bike_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stations per event: one with repeated, blank and absent properties, one bare."""
    k, user = F.col("k"), F.col("user_id")

    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    properties = F.filter(
        F.array(
            entry("NbBikes", k),
            entry("NbEmptyDocks", F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(" 7 "))),
            F.when(k % 10 != 0, entry("NbDocks", k + 5)),
            entry("NbBikes", F.floor("value").cast("int")),
        ),
        lambda e: e.isNotNull(),
    )
    full = F.struct(
        F.concat(F.lit("BikePoints_"), text(user)).alias("id"),
        F.concat(F.lit("Stop "), text(user)).alias("commonName"),
        (F.lit(51.0) + user.cast("double") / F.lit(1000.0)).alias("lat"),
        F.when(k % 4 != 0, F.lit(0.0) - user.cast("double") / F.lit(1000.0)).alias("lon"),
        properties.alias("additionalProperties"),
    )
    bare = F.struct(F.concat(F.lit("BikePoints_"), text(user + 1000)).alias("id"))
    payload = F.concat(F.lit("["), F.to_json(full), F.lit(","), F.to_json(bare), F.lit("]"))
    return events(spark, sf_dir).select(iso(F.col("ts")).alias("extracted_at"), payload.alias("payload"))


def air_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event no list, an empty list, or one or two forecasts."""
    k = F.col("k")

    def forecast(kind: str, band: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("forecastType"),
            F.when(k % 4 != 0, band).alias("forecastBand"),
            F.concat(F.lit("summary "), text(k)).alias("forecastSummary"),
            F.concat(F.lit("A"), text(k % 7)).alias("nO2Band"),
            F.when(k % 3 != 0, F.concat(F.lit("B"), text(k % 3))).alias("o3Band"),
            F.concat(F.lit("C"), text(k % 2)).alias("pM10Band"),
            F.concat(F.lit("D"), text(k % 11)).alias("pM25Band"),
            F.concat(F.lit("E"), text(k % 6)).alias("sO2Band"),
        )

    both = F.array(forecast("Current", F.lit("Low")), forecast("Future", F.lit("High")))
    forecasts = F.when(k % 10 == 1, F.slice(both, 1, 0)).when(k % 10 != 0, F.slice(both, 1, k % 2 + 1))
    return events(spark, sf_dir).select(
        iso(F.col("ts")).alias("extracted_at"), F.to_json(F.struct(forecasts.alias("currentForecast"))).alias("payload")
    )


# --- landed documents for the whole pipeline -------------------------------------

STATIONS_PER_EVENT = 12


def landed_documents(
    spark: SparkSession, sf_dir: str, dealt: Callable[[DataFrame], DataFrame] = lambda ev: ev
) -> dict[str, DataFrame]:
    """Envelopes with their landing date: two snapshots a day, one page per event; ``dealt`` places the events."""
    k = F.col("k")
    hour = F.when(F.hour("ts") < 12, F.lit("08")).otherwise(F.lit("16"))
    at = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":30:15.000001+00:00"))
    ev = dealt(events(spark, sf_dir))

    def page(payload: Column) -> DataFrame:
        return ev.select(
            at.alias("extracted_at"), F.col("event_id").alias("page"), payload.alias("payload"),
            F.col("extracted_date").alias("date"),
        )

    def status(severity: Column) -> Column:
        return F.struct(
            severity.alias("statusSeverity"),
            F.concat(F.lit(" s"), text(severity)).alias("statusSeverityDescription"),
            F.when(severity != 10, F.struct(F.concat(F.lit("late "), text(k)).alias("description"))).alias("disruption"),
        )

    line = F.struct(
        F.col("event_type").alias("id"),
        F.concat(F.lit("\t"), "event_type", F.lit("-line \n")).alias("name"),
        F.slice(F.array(status(k % 21), status((k * 7 + 3) % 21)), 1, k % 3).alias("lineStatuses"),
    )

    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), text(value).alias("value"))

    def counts(j: Column) -> dict[str, Column]:
        bikes, docks = (F.floor("value").cast("int") + j) % 45, (k + j * 3) % 40
        return {"NbBikes": bikes, "NbEmptyDocks": F.greatest(docks - bikes, F.lit(0)), "NbDocks": docks}

    def position(number: Column) -> tuple[Column, Column]:
        return F.lit(51.0) + number.cast("double") / F.lit(1000.0), F.lit(0.0) - number.cast("double") / F.lit(1000.0)

    def station(j: Column) -> Column:
        number = F.col("user_id") * STATIONS_PER_EVENT + j
        lat, lon = position(number)
        return F.struct(
            F.concat(F.lit("BikePoints_"), text(number)).alias("id"),
            F.concat(F.lit("Stop "), text(number), F.lit(" ")).alias("commonName"),
            lat.alias("lat"),
            lon.alias("lon"),
            F.array(*(entry(key, value) for key, value in counts(j).items())).alias("additionalProperties"),
        )

    def station_text(j: Column) -> Column:
        """The JSON of a station without nulls; it is of numbers, which need no escapes."""
        number = F.col("user_id") * STATIONS_PER_EVENT + j
        lat, lon = position(number)
        listed = [
            part for key, value in counts(j).items()
            for part in (F.lit(f'{{"key":"{key}","value":"'), text(value), F.lit('"},'))
        ]
        return F.concat(
            F.lit('{"id":"BikePoints_'), text(number), F.lit('","commonName":"Stop '), text(number), F.lit(' ","lat":'),
            text(lat), F.lit(',"lon":'), text(lon), F.lit(',"additionalProperties":['), *listed[:-1], F.lit('"}]}'),
        )

    # Nearly all documents are of stations. Their text is put together from its parts; a null leaves its member out.
    each = [F.lit(j) for j in range(STATIONS_PER_EVENT)]
    whole = F.col("user_id").isNotNull() & F.col("value").isNotNull() & k.isNotNull()
    texts = [part for j in each for part in (F.lit(","), station_text(j))][1:]
    stations = F.when(whole, F.concat(F.lit("["), *texts, F.lit("]"))).otherwise(F.to_json(F.array(*map(station, each))))
    bands = F.array(*map(F.lit, ("Low", "Moderate", "High", "Very High")))

    def forecast(kind: str, shift: int) -> Column:
        return F.struct(
            F.lit(kind).alias("forecastType"),
            F.get(bands, (k + shift) % 4).alias("forecastBand"),
            F.concat(F.lit("summary "), text(k)).alias("forecastSummary"),
            F.concat(F.lit("A"), text(k % 7)).alias("nO2Band"),
            F.concat(F.lit("B"), text(k % 3)).alias("o3Band"),
            F.concat(F.lit("C"), text(k % 2)).alias("pM10Band"),
            F.concat(F.lit("D"), text(k % 11)).alias("pM25Band"),
            F.concat(F.lit("E"), text(k % 6)).alias("sO2Band"),
        )

    forecasts = F.struct(F.array(forecast("Current", 0), forecast("Future", 1)).alias("currentForecast"))
    return {
        "line_status": page(F.to_json(F.array(line))),
        "bike_points": page(stations),
        "air_quality": page(F.to_json(forecasts)),
    }
