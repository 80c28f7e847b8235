"""Raw API payloads: reading documents and station documents.

``measure`` (object or bare URI) and ``stageScale`` (object, URI or absent)
are declared as strings: Spark's JSON reader then keeps an object as its raw
JSON text and a string as itself, so both shapes load with one stable schema
and the fields are picked with ``get_json_object``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.keys import mint_reading_id
from gaugeflow.functions.timefns import iso_z
from gaugeflow.functions.values import falsy_coalesce
from gaugeflow.schemas import READING_PAYLOAD, STATION_PAYLOAD
from gaugeflow.sources import derived
from gaugeflow.sources.documents import read_documents

BRONZE_FIELDS = (
    "reading_id",
    "measure",
    "station_reference",
    "station_label",
    "parameter",
    "qualifier",
    "unit_name",
    "date_time",
    "value",
)


def read_reading_payloads(spark: SparkSession, path: str) -> DataFrame:
    return parse_reading_payloads(read_documents(spark, path))


def read_station_payloads(spark: SparkSession, path: str) -> DataFrame:
    return parse_station_payloads(read_documents(spark, path))


def parse_reading_payloads(text: DataFrame, col: str = "json") -> DataFrame:
    """Payload documents held as JSON text in a column."""
    return text.select(F.from_json(F.col(col), READING_PAYLOAD).alias("p")).select("p.*")


def _is_object(c: Column) -> Column:
    return F.ltrim(c).startswith("{")


def flatten_readings(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One bronze row per item: measure object → URI + descriptive fields,
    bare string → URI only; the station falls back to the requested one
    when the object has none (or an empty one); the key is minted here.
    ``keep`` names payload columns carried onto every item row."""
    items = payloads.select("requested_station", F.explode("items").alias("it"), *keep)
    m = F.col("it.measure")
    obj = _is_object(m)
    j = lambda path: F.when(obj, F.get_json_object(m, path))
    flat = items.select(
        F.when(obj, F.get_json_object(m, "$.@id")).otherwise(m).alias("measure"),
        falsy_coalesce(j("$.stationReference"), F.col("requested_station")).alias("station_reference"),
        j("$.station.label").alias("station_label"),
        j("$.parameter").alias("parameter"),
        j("$.qualifier").alias("qualifier"),
        j("$.unitName").alias("unit_name"),
        F.col("it.dateTime").alias("date_time"),
        F.col("it.value").alias("value"),
        *keep,
    )
    return flat.select(mint_reading_id("measure", "date_time").alias("reading_id"), *BRONZE_FIELDS[1:], *keep)


def discover_stations(payloads: DataFrame, search: str | None = None, town: str | None = None) -> DataFrame:
    """Station candidates: label contains ``search``, or exact ``town`` (which
    takes precedence). ``typical_range_high`` only when ``stageScale`` is an object."""
    s = payloads.select(F.explode("items").alias("s")).select("s.*")
    scale = F.col("stageScale")
    out = s.select(
        F.col("stationReference").alias("station_reference"),
        F.col("label").alias("station_label"),
        F.col("riverName").alias("river_name"),
        "town",
        "lat",
        "long",
        "status",
        F.when(_is_object(scale), F.get_json_object(scale, "$.typicalRangeHigh").cast("double")).alias(
            "typical_range_high"
        ),
    )
    if town is not None:
        return out.where(F.col("town") == town)
    if search is not None:
        return out.where(F.col("station_label").contains(search))
    return out


# --- payloads built from the driver's tables ------------------------------
# FIXED VALUES of the payload rule (shared with the SQL oracle).
BARE_MEASURE_MOD = 3  # measure given as a bare URI string
EMPTY_STATION_REF_MOD = 13  # stationReference '' (falls back to the request)
STATION_AS_URI_MOD = 11  # station given as a URI (no label)
SCALE_ABSENT_MOD = 5  # no stageScale
SCALE_OBJECT_MOD = 2  # stageScale object when key % 2 = 0, else a URI
TOWN_MOD = 7


def reading_payload_text(events: DataFrame) -> DataFrame:
    """One JSON document per event (no grouping, no shuffle)."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    measure_uri = derived._measure(uid, ts)
    measure_obj = F.to_json(
        F.struct(
            measure_uri.alias("@id"),
            derived._parameter(F.col("event_type")).alias("parameter"),
            F.when(eid % derived.DOWNSTREAM_MOD == 0, F.lit("Downstream Stage")).otherwise(F.lit("Stage")).alias("qualifier"),
            F.lit("m").alias("unitName"),
            F.when(eid % EMPTY_STATION_REF_MOD == 0, F.lit("")).otherwise(uid.cast("string")).alias("stationReference"),
            F.when(eid % STATION_AS_URI_MOD == 0, F.struct(F.lit(None).cast("string").alias("label")))
            .otherwise(F.struct(F.concat(F.lit("Station "), uid.cast("string")).alias("label")))
            .alias("station"),
        )
    )
    # A bare measure is the quoted URI: take it from a one-element JSON array.
    bare = F.to_json(F.array(measure_uri))
    measure_json = F.when(eid % BARE_MEASURE_MOD == 0, F.expr("substring(bare, 2, length(bare) - 2)")).otherwise(
        F.col("obj")
    )
    date_time = F.when(eid % derived.NULL_DATE_MOD == 0, F.lit(None).cast("string")).otherwise(iso_z(ts))
    value = F.when(eid % derived.NULL_VALUE_MOD == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    rest = F.to_json(F.struct(date_time.alias("dateTime"), value.alias("value")))  # nulls are left out
    staged = events.select(
        uid.cast("string").alias("uid"), bare.alias("bare"), measure_obj.alias("obj"), rest.alias("rest"), eid
    )
    text = F.concat(
        F.lit('{"requested_station":"'),
        F.col("uid"),
        F.lit('","items":[{"measure":'),
        measure_json,
        F.when(F.col("rest") == "{}", F.lit("}")).otherwise(
            F.concat(F.lit(","), F.expr("substring(rest, 2, length(rest) - 1)"))
        ),
        F.lit("]}"),
    )
    return staged.select(text.alias("json"))


def station_payload_text(supplier: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON document per supplier row, beside the columns of ``keep``."""
    key = F.col("s_suppkey")
    scale_json = (
        F.when(key % SCALE_ABSENT_MOD == 0, F.lit(None).cast("string"))
        .when(key % SCALE_OBJECT_MOD == 0, F.to_json(F.struct((key / 10.0).alias("typicalRangeHigh"))))
        .otherwise(F.to_json(F.array(F.concat(F.lit("stage-scale/"), key.cast("string")))))
    )
    item = F.to_json(
        F.struct(
            key.cast("string").alias("stationReference"),
            F.col("s_name").alias("label"),
            F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("riverName"),
            F.concat(F.lit("Town "), (F.col("s_nationkey") % TOWN_MOD).cast("string")).alias("town"),
            (F.col("s_acctbal") / 100.0).alias("lat"),
            (F.col("s_nationkey") / 10.0).alias("long"),
            F.lit("Active").alias("status"),
        )
    )
    # stageScale is spliced as raw JSON (object, or the string inside a one-element array).
    scale_raw = F.when(F.col("scale_json").startswith("["), F.expr("substring(scale_json, 2, length(scale_json) - 2)")).otherwise(
        F.col("scale_json")
    )
    body = F.when(
        F.col("scale_json").isNull(), F.col("item")
    ).otherwise(F.concat(F.expr("substring(item, 1, length(item) - 1)"), F.lit(',"stageScale":'), scale_raw, F.lit("}")))
    return (
        supplier.select(*keep, item.alias("item"), scale_json.alias("scale_json"))
        .select(*keep, F.concat(F.lit('{"items":['), body, F.lit("]}")).alias("json"))
    )


def parse_station_payloads(text: DataFrame, col: str = "json") -> DataFrame:
    return text.select(F.from_json(F.col(col), STATION_PAYLOAD).alias("p")).select("p.*")
