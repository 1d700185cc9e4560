"""Queries over the driver's tables for the rules of ingest, measuring, records, labels and grading, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.functions import pixels, scalars
from wildtally.operators import charts, events, ranges, summaries
from wildtally.plans import analog as A
from wildtally.plans import grading, stages
from wildtally.plans.pipeline import stage_figures
from wildtally.plans.registry import built, counted_photos, event_labels, gaps, photo_table, sql
from wildtally.schemas import DETECTION_RECORDS, LABEL_RECORDS, conform
from wildtally.settings import Settings
from wildtally.sources.tables import RecordStore, json_lines, load_sidecar, parse_metadata, read_json_records, write_table
from wildtally.storage import cut, fresh_path
from wildtally.streaming import folder

Query = Callable[[SparkSession, str], DataFrame]
NOW = datetime(1998, 1, 1)


def text_of(moment: F.Column, pattern: str) -> F.Column:
    return F.date_format(moment, pattern)


def ingest_rules(spark: SparkSession, d: str) -> DataFrame:
    """Orders as image files with EXIF and a sidecar for some; camera and clock by the first source that has them."""
    k = F.col("o_orderkey")
    second = F.expr("make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400)")
    files = A.table(spark, d, "orders").withColumn("at", F.col("o_orderdate") + second)
    wild = (
        F.when(k % 5 == 0, "0000:00:00 00:00:00").when(k % 5 == 1, F.concat(text_of(F.col("at"), "yyyy:MM:dd HH:mm:ss"), F.lit("\0")))
        .when(k % 5 == 2, F.concat(text_of(F.col("at"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).when(k % 5 == 4, "  ")
    )
    headers = files.select(
        F.when(k % 4 == 0, F.concat(F.lit("img"), k, F.lit(".jpg"))).otherwise(F.concat(F.lit("cam"), k % 7, F.lit("/img"), k, F.lit(".jpg"))).alias("rel_path"),
        wild.alias("original"), F.when(k % 3 == 0, text_of(F.col("at"), "yyyy/MM/dd HH:mm:ss")).alias("date_time"), F.when(k % 2 == 1, " Acme ").otherwise("").alias("exif_make"),
        F.when(k % 3 == 0, F.concat(F.lit("M"), k % 4)).alias("exif_model"), F.when(k % 6 == 0, F.concat(F.lit("S"), k % 9)).alias("exif_serial"), F.lit(True).alias("readable"),
        F.when(k % 8 == 0, F.when(k % 16 != 0, F.concat(F.lit("side"), k % 5))).alias("side_camera"), F.when(k % 24 == 0, text_of(F.col("at"), "d MMMM yyyy HH:mm")).alias("side_timestamp"),
    )
    told = stages.media_frame(headers, "1995-01-01", NOW)
    return told.select("rel_path", "camera_id", "camera_source", "timestamp", "timestamp_source", "timestamp_valid", "exif_make", "exif_model")


#: Ways to write a time, and what is left of it: the second, the minute, the day or all of it.
WAYS = (
    ("yyyy:MM:dd HH:mm:ss", "second"), ("yyyy-MM-dd HH:mm:ss", "second"), ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "second"), ("yyyy/MM/dd HH:mm:ss", "second"), ("d MMMM yyyy HH:mm", "minute"),
    ("yyyy-MM-dd HH:mm", "minute"), ("MM/dd/yyyy HH:mm:ss", "second"), ("yyyy-MM-dd", "day"), ("yyyyMMdd HHmmss", "second"), ("yyyy/MM/dd", "day"), ("dd-MMM-yyyy HH:mm:ss", "second"),
    ("MMMM d yyyy HH:mm:ss", "second"), ("M/d/yy h:mm a", "minute"), ("EEE MMM d HH:mm:ss yyyy", "second"), ("d MMM yyyy 'at' h:mm:ss a 'UTC'", "second"), ("MMM d, yyyy HH:mm:ss.SSSSSS", "microsecond"),
    ("yyyyMMddHHmmss", "second"), ("M-d-yyyy H'h'mm'm'", "minute"),
)


def parsed_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Times written in eighteen ways, numbers alone month first, and read back."""
    at = F.col("event_id") % len(WAYS)
    written = F.coalesce(*[F.when(at == n, text_of(F.col("ts"), w)) for n, (w, _) in enumerate(WAYS)])
    return A.table(spark, d, "events").select("event_id", scalars.parse_timestamp(written).alias("read"))


def night_hours(spark: SparkSession, d: str) -> DataFrame:
    rows = A.table(spark, d, "events").select("user_id", scalars.is_night(F.col("ts")).alias("night"))
    return rows.groupBy("user_id").agg(F.count_if("night").alias("n_night"), F.count("*").alias("n"))


def names(spark: SparkSession, d: str) -> DataFrame:
    """File names, camera folders and box categories of line items."""
    k = F.col("l_partkey")
    file = F.concat(
        F.when(k % 6 == 0, "../").when(k % 6 == 1, "/").when(k % 6 == 2, "a\\").when(k % 6 == 3, "a/./").when(k % 6 == 4, "a/b/").otherwise(""),
        F.lit("img "), k, F.when(k % 5 == 0, ".exe").when(k % 5 == 1, ".JPG").otherwise(".png"),
    )
    camera = F.concat(F.lit("Loc "), F.col("l_suppkey"), F.when(k % 2 == 0, "/B").otherwise("!!"))
    return A.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.safe_file_name(file).alias("file"), scalars.camera_folder(camera).alias("folder"),
        scalars.category_name((F.col("l_linenumber")).cast("string")).alias("category"),
    )


def detection_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders as detector records: line items are their boxes, every thirteenth failed."""
    box = F.struct(F.lit("animal").alias("category"), (F.col("l_discount") * 10).alias("conf"), F.array(F.col("l_linenumber") / 16.0, F.lit(0.25), F.lit(0.5), F.lit(0.125)).alias("bbox"))
    lines = A.table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", box.alias("b")).alias("x"))
    whole = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x"))  # a few lines an order
    key = F.col("l_orderkey")
    failed = F.when(key % 13 == 0, "timeout")
    boxes = F.when(failed.isNull(), F.transform("x", lambda x: x["b"])).otherwise(F.array().cast(DETECTION_RECORDS["boxes"].dataType))
    return conform(whole.select(key.cast("string").alias("photo_id"), F.lit("m").alias("model"), boxes.alias("boxes"), failed.alias("error")), DETECTION_RECORDS)


def box_rows(spark: SparkSession, d: str) -> DataFrame:
    return stages.boxes_table(detection_records(spark, d))


def run_rows(spark: SparkSession, d: str) -> DataFrame:
    return stages.runs_table(detection_records(spark, d))


def classified(spark: SparkSession, d: str) -> DataFrame:
    """One box an order with two labels of different classes; a box whose record failed or is missing stays unresolved."""
    k = F.col("o_orderkey")
    label = lambda n: F.concat(F.lit("id;c"), F.lit(n), F.lit(";o;f;g;"), k % 5, F.lit(";Kind "), F.lit(n), F.lit(" "), k % 5)
    orders = A.table(spark, d, "orders").select("o_orderkey", k.cast("string").alias("photo_id"), F.lit(0).cast("long").alias("box_idx"), F.concat(k, F.lit(":b")).alias("box_key"))
    top = (k % 4096 + 4096) / 8192.0
    records = orders.filter(k % 11 != 0).select(
        "box_key", "photo_id", F.lit("m").alias("model"), F.array(label(1), label(2)).alias("classes"), F.array(top, 1 - top).alias("scores"), F.when(k % 7 == 0, "unreadable").alias("error")
    )
    told = stages.classifications_table(orders, conform(records, LABEL_RECORDS), 0.65)
    return told.select("photo_id", "species", "species_score", "species_level", "lineage", "top1_label", "top1_score", "top5_json", "error")


def quality_rows(spark: SparkSession, d: str) -> DataFrame:
    """Photos joined with what was measured of them: every ninth file unreadable, every seventh without a record."""
    k = F.col("photo_id").cast("long")
    media = A.media(spark, d).withColumn("readable", k % 9 != 0)
    metrics = A.measured(spark, d).filter(k % 7 != 0).select(
        "photo_id", "sharpness", "brightness", F.lit(1.0).alias("contrast"), "ir_score", "dhash", F.when(k % 29 == 0, "cut").alias("error")
    )
    told = stages.quality_table(media.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")), metrics, Settings())
    return told.select("photo_id", "decode_ok", "quality_error", "brightness", "is_ir", "is_dark", "is_overexposed", "dup_group", "is_near_duplicate")


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the stages say of themselves, by the pipeline's own figures, over photos, their runs and their quality."""
    whole = photo_table(spark, d).withColumns({"readable": F.col("decode_ok"), "error": F.col("detect_error")})
    ingest, quality, runs = (stage_figures(whole, n) for n in ("ingest", "quality", "detection_runs"))
    return ingest.crossJoin(quality).crossJoin(runs)  # three single rows


def pixel_figures(spark: SparkSession, d: str) -> DataFrame:
    """Images of one colour, and ramps: what is measured of them."""
    k = F.col("p_partkey")
    ramp, step = k % 2 == 1, k % 7 + 1
    red, green, blue = (F.when(ramp, 0).otherwise(k * n % 256) for n in (7, 11, 13))
    columns = F.sequence(F.lit(0), F.lit(17))
    bgr = F.flatten(F.transform(columns, lambda x: F.when(ramp, F.array(x * step, x * step, x * step)).otherwise(F.array(blue, green, red))))
    row = F.unhex(F.array_join(F.transform(bgr, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    data = F.unhex(F.repeat(F.hex(row), 16))
    image = F.struct(F.lit("").alias("origin"), F.lit(16).alias("height"), F.lit(18).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data"))
    told = A.table(spark, d, "part").select("p_partkey", pixels.measured(image, F.lit(1)).alias("m"))
    return told.select("p_partkey", "m.sharpness", "m.brightness", F.round("m.contrast", 2).alias("contrast"), "m.ir_score", "m.dhash")


def sidecar_rows(spark: SparkSession, d: str) -> DataFrame:
    """A sidecar with paths written in several ways; of rows for one file the last counts."""
    k = F.col("s_suppkey")
    file = F.concat(F.when(k % 3 == 0, "a\\").when(k % 3 == 1, "./a/").otherwise("a/"), F.floor(k / 2), F.lit(".jpg"))
    rows = A.table(spark, d, "supplier").orderBy("s_suppkey").select(file.alias("file"), F.when(k % 4 != 0, F.concat(F.lit(" c"), k)).otherwise("").alias("camera_id"))
    path = fresh_path(spark, "sidecar")
    rows.coalesce(1).write.option("header", True).csv(path)
    return load_sidecar(spark, path).select("rel_path", "side_camera")


def survey_images(spark: SparkSession, d: str) -> DataFrame:
    """The description of a public survey: camera and time by the first field that is set."""
    k = F.col("s_suppkey")
    image = F.struct(
        F.when(k % 7 != 0, F.concat(k, F.lit(".jpg"))).otherwise("").alias("file_name"), F.when(k % 3 == 0, F.concat(F.lit("L"), k % 5)).otherwise("").alias("location"),
        F.when(k % 3 == 1, F.concat(F.lit("C"), k % 5)).alias("camera"), F.when(k % 2 == 0, "2020-01-01").alias("datetime"), F.lit("2019").alias("date_captured"), F.when(k % 4 == 0, "").otherwise("q").alias("seq_id"),
    )
    whole = A.table(spark, d, "supplier").select(image.alias("i")).agg(F.collect_list("i").alias("images"))  # one JSON document, as such surveys are
    path = fresh_path(spark, "survey")
    whole.select(F.to_json(F.struct("images"))).write.text(path)
    return parse_metadata(spark, path)


def _lines(spark: SparkSession, d: str) -> str:
    k = F.col("s_suppkey")
    good = F.concat(F.lit('{"k":"r'), k % 10, F.lit('","v":'), k, F.lit("}"))
    text = F.when(k % 5 == 0, "[1]").when(k % 5 == 1, F.concat(F.lit('{"v":'), k, F.lit("}"))).when(k % 5 == 2, F.concat(F.lit('{"k":"r'), k, F.lit('"'))).otherwise(good)
    path = fresh_path(spark, "lines")
    A.table(spark, d, "supplier").orderBy("s_suppkey").select(text).coalesce(1).write.text(path)
    return path


def json_records(spark: SparkSession, d: str) -> DataFrame:
    return read_json_records(spark, _lines(spark, d), "k", "k string, v long")


def torn_lines(spark: SparkSession, d: str) -> DataFrame:
    return json_lines(spark, _lines(spark, d), "k", "k string, v long").agg(F.count_if(F.col("x").isNull()).alias("torn"), F.count("x").alias("good"))


def stored_records(spark: SparkSession, d: str) -> DataFrame:
    """Records in two attempts, the second for every third key; the newest counts."""
    rows = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.lit(1).cast("long").alias("v"))
    store = RecordStore(spark, fresh_path(spark, "records"), "k", rows.schema)
    store.append(rows)
    store.append(rows.filter("k % 3 = 0").withColumn("v", F.lit(2).cast("long")))
    return store.read()


def replaced_table(spark: SparkSession, d: str) -> DataFrame:
    """A table written twice in one place."""
    path = fresh_path(spark, "table")
    rows = A.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    write_table(rows, path)
    return write_table(spark.read.parquet(path).filter("c_custkey % 2 = 0"), path)


def retried_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders as photos of which some fail once, twice or always, fed again until they work or have failed four times."""
    orders = A.table(spark, d, "orders").select("o_orderkey")
    store = RecordStore(spark, fresh_path(spark, "retried"), "o_orderkey", orders.select("o_orderkey", F.lit("").alias("error")).schema)
    fails = F.when(F.col("o_orderkey") % 7 == 0, 9).when(F.col("o_orderkey") % 5 == 0, 2).when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0)

    def attempt(number: int) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: rows.select("o_orderkey", F.when(fails >= number, F.lit("timeout")).alias("error"))

    store.put(attempt(1)(orders), 0)
    for number in range(2, 6):
        folder.feed_again(orders, store, attempt(number), most=4)
    tries = store.history().groupBy("o_orderkey").agg(F.count("*").alias("n_tries"), F.count_if(F.col("error").isNull()).alias("n_good"))
    return store.read().join(tries, "o_orderkey")


def group_medians(spark: SparkSession, d: str) -> DataFrame:
    """The exact median price of each kind of line item, by selection; some prices are missing."""
    price = F.when(F.col("l_partkey") % 9 != 0, F.col("l_extendedprice"))
    rows = A.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", price.alias("price"))
    told = ranges.medians(rows, ["l_returnflag", "l_linestatus"], "price", "median_price", sorted_rows=500)
    return told.withColumn("median_price", F.round("median_price", 4))


def species_bars(spark: SparkSession, d: str) -> DataFrame:
    return charts.top_labels(summaries.species_totals(event_labels(spark, d)), charts.TOP_BARS).select("species", "n_events")


def with_visits(spark: SparkSession, d: str, photos: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Photos of events (`photos` if they are known) with the truth that a camera's year is one visit, and these visits."""
    year = F.year("timestamp")
    key = F.regexp_extract("camera_id", r"(\d+)", 1).cast("long")
    visit = (key * 10_000 + year).alias("truth_visit_id")
    whole = (events.assign_events(counted_photos(spark, d), A.GAP_S) if photos is None else photos).select("*", visit)
    kinds = F.element_at(F.array(*map(F.lit, ("animal", "person", "vehicle", "empty"))), ((key + year) % 4 + 1).cast("int"))
    visits = A.media(spark, d).select(visit, kinds.alias("kind"), (year % 3).cast("long").alias("count"), ((key + year) % 5 != 0).alias("valid_clock")).distinct()
    return whole, visits.withColumnRenamed("truth_visit_id", "visit_id").withColumn("species", F.concat(F.lit("kind "), F.col("visit_id") % 32))


def graded_visits(spark: SparkSession, d: str) -> DataFrame:
    return grading.visit_checks(*with_visits(spark, d))


def graded_events(spark: SparkSession, d: str) -> DataFrame:
    """Types, counts and species of events against their visits."""
    photos, found, labels = built(spark, d, keep_labels=True)
    whole, visits = with_visits(spark, d, photos)
    observed = cut(grading.observed_visits(whole, found, visits))
    kind = F.col("id")
    levels = [F.concat(F.lit(n), kind % m) for n, m in (("class", 2), ("order", 4), ("family", 8), ("genus", 16), ("species", 32))]
    lineages = spark.range(32).select(F.concat(F.lit("kind "), kind).alias("species"), F.concat_ws(";", *levels).alias("lineage"))
    return grading.type_check(observed).unionByName(grading.animal_checks(observed, labels, lineages))


def graded_photos(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("photo_id").cast("long")
    told = photo_table(spark, d).withColumns({
        "truth_camera_clock": F.when(k % 23 == 0, "2000-01-01 00:00:00").otherwise("2004-01-01 00:00:00"), "truth_truncated": k % 29 == 0, "truth_night": k % 11 < 4,
        "truth_blurred": k % 6 == 0,
    })
    return grading.photo_checks(told)


def graded_repeats(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("photo_id").cast("long")
    told = photo_table(spark, d).withColumns({"truth_visit_id": F.year("timestamp").cast("long"), "truth_kind": F.when(k % 2 == 0, "empty").otherwise("animal"), "dup_group": (k % 50).cast("string")})
    return grading.repeat_checks(told)


def graded_outages(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    cameras = A.table(spark, d, "customer").select(F.concat(F.lit("cam"), k).alias("camera_id"), F.when(k % 3 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("outage_days"))
    return grading.outage_check(gaps(spark, d), cameras)


_ROW = "SELECT '{0}' AS name, count(*) FILTER ({1}) AS good, count(*) AS total, {3} AS passed FROM {2}"


def _row(name: str, good: str, rows: str, mark: float = 1.0, some: str = "") -> str:
    return _ROW.format(name, good, rows, f"count(*) FILTER ({good}) >= {mark}::DOUBLE * count(*){some}")


_VISIT = "CAST(regexp_extract(camera_id, '(\\d+)', 1) AS BIGINT) * 10000 + year(timestamp)"
_VISITS = f""", cam_years AS (SELECT DISTINCT CAST(regexp_extract(camera_id, '(\\d+)', 1) AS BIGINT) AS key, CAST(year(timestamp) AS BIGINT) AS y FROM media),
visits AS (SELECT key * 10000 + y AS visit_id, (['animal', 'person', 'vehicle', 'empty'])[(key + y) % 4 + 1] AS kind, y % 3 AS count, (key + y) % 5 <> 0 AS valid_clock,
  'kind ' || (key * 10000 + y) % 32 AS true_species FROM cam_years),
shown AS (SELECT event_id, min({_VISIT}) AS visit_id FROM in_events GROUP BY event_id)"""
_SUPPLIER = "SELECT *, s_suppkey AS k FROM supplier"

QUERIES: dict[str, tuple[Query, str | None]] = {
    "ingest_rules": (ingest_rules, r"""
WITH f AS (SELECT o_orderkey AS k, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS moment FROM orders),
c AS (SELECT k, CAST(moment AS TIMESTAMP) AS moment, CASE WHEN k % 4 = 0 THEN 'img' || k || '.jpg' ELSE 'cam' || k % 7 || '/img' || k || '.jpg' END AS rel_path,
  CASE WHEN k % 8 = 0 AND k % 16 <> 0 THEN 'side' || k % 5 END AS side, CASE WHEN k % 4 <> 0 THEN 'cam' || k % 7 END AS folder, CASE WHEN k % 6 = 0 THEN 'S' || k % 9 END AS serial,
  CASE WHEN k % 2 = 1 THEN 'Acme' END AS exif_make, CASE WHEN k % 3 = 0 THEN 'M' || k % 4 END AS exif_model FROM f),
t AS (SELECT *, nullif(concat_ws(' ', exif_make, exif_model), '') AS model,
  CASE WHEN k % 24 = 0 THEN date_trunc('minute', moment) END AS a, CASE WHEN k % 5 IN (1, 2) THEN moment END AS b, CASE WHEN k % 3 = 0 THEN moment END AS d FROM c)
SELECT rel_path, coalesce(side, folder, serial, model, 'unknown') AS camera_id,
  CASE WHEN side IS NOT NULL THEN 'sidecar' WHEN folder IS NOT NULL THEN 'folder' WHEN coalesce(serial, model) IS NOT NULL THEN 'exif' ELSE 'unknown' END AS camera_source,
  CAST(coalesce(a, b, d) AS TIMESTAMP) AS timestamp, CASE WHEN a IS NOT NULL THEN 'sidecar' WHEN b IS NOT NULL THEN 'exif' WHEN d IS NOT NULL THEN 'exif_datetime' ELSE 'none' END AS timestamp_source,
  coalesce(coalesce(a, b, d) > TIMESTAMP '1995-01-01' AND coalesce(a, b, d) <= TIMESTAMP '1998-01-02', false) AS timestamp_valid, exif_make, exif_model FROM t"""),
    "parsed_stamps": (parsed_stamps, f"""
SELECT event_id, CAST(CASE event_id % {len(WAYS)} {" ".join(f"WHEN {n} THEN date_trunc('{left}', ts)" for n, (_, left) in enumerate(WAYS))} END AS TIMESTAMP) AS read FROM events"""),
    "night_hours": (night_hours, """
SELECT user_id, count(*) FILTER (hour(ts) + minute(ts) / 60.0 < 6.5 OR hour(ts) + minute(ts) / 60.0 >= 19.5) AS n_night, count(*) AS n FROM events GROUP BY user_id"""),
    "names": (names, """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_partkey % 6 >= 4 AND l_partkey % 5 <> 0 THEN 'img ' || l_partkey || CASE WHEN l_partkey % 5 = 1 THEN '.JPG' ELSE '.png' END END AS file,
  'location_loc_' || l_suppkey || CASE WHEN l_partkey % 2 = 0 THEN '_b' ELSE '' END AS folder, CASE l_linenumber WHEN 1 THEN 'animal' WHEN 2 THEN 'person' WHEN 3 THEN 'vehicle' ELSE 'unknown' END AS category FROM lineitem"""),
    "box_rows": (box_rows, """
SELECT CAST(l_orderkey AS VARCHAR) AS photo_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(printf('%.4f', l_discount * 10) AS DOUBLE) DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS box_idx, 'animal' AS category,
  CAST(printf('%.4f', l_discount * 10) AS DOUBLE) AS conf, CAST(printf('%.4f', l_linenumber / 16.0::DOUBLE) AS DOUBLE) AS x, 0.25::DOUBLE AS y, least(0.5, 1 - l_linenumber / 16.0::DOUBLE) AS w, 0.125::DOUBLE AS h, 'm' AS model FROM lineitem WHERE l_orderkey % 13 <> 0"""),
    "run_rows": (run_rows, """
SELECT CAST(l_orderkey AS VARCHAR) AS photo_id, 'm' AS model, CASE WHEN l_orderkey % 13 = 0 THEN 0 ELSE count(*) END AS n_boxes, CASE WHEN l_orderkey % 13 = 0 THEN 'timeout' END AS error FROM lineitem GROUP BY l_orderkey"""),
    "classified": (classified, """
WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 4096 + 4096) / 8192.0::DOUBLE AS top, o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AS good, o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0 AS failed FROM orders)
SELECT CAST(k AS VARCHAR) AS photo_id, CASE WHEN good AND top >= 0.65 THEN 'kind 1 ' || k % 5 ELSE 'animal (unresolved)' END AS species, CASE WHEN good THEN CAST(printf('%.4f', top) AS DOUBLE) ELSE 0.0 END AS species_score,
  CASE WHEN good AND top >= 0.65 THEN 'species' ELSE 'unresolved' END AS species_level, CASE WHEN good AND top >= 0.65 THEN 'c1;o;f;g;' || k % 5 ELSE '' END AS lineage,
  CASE WHEN good THEN 'kind 1 ' || k % 5 END AS top1_label, CASE WHEN good THEN CAST(printf('%.4f', top) AS DOUBLE) END AS top1_score,
  CASE WHEN good THEN '[["kind 1 ' || k % 5 || '", ' || CAST(printf('%.4f', top) AS DOUBLE) || '], ["kind 2 ' || k % 5 || '", ' || CAST(printf('%.4f', 1 - top) AS DOUBLE) || ']]' ELSE '[]' END AS top5_json, CASE WHEN failed THEN 'unreadable' END AS error FROM o"""),
    "quality_rows": (quality_rows, sql("measured", """, j AS (SELECT photo_id, k, k % 9 <> 0 AS readable, k % 7 <> 0 AS known, brightness, ir_score FROM measured), ok AS (
  SELECT *, readable AND known AND k % 29 <> 0 AS decode_ok FROM j)
SELECT photo_id, decode_ok, CASE WHEN NOT readable THEN 'unreadable' WHEN known AND k % 29 = 0 THEN 'cut' END AS quality_error, CASE WHEN known THEN brightness END AS brightness,
  decode_ok AND coalesce(ir_score < 4, false) AS is_ir, decode_ok AND coalesce(brightness < 30, false) AS is_dark, decode_ok AND coalesce(brightness > 225, false) AS is_overexposed, photo_id AS dup_group, false AS is_near_duplicate FROM ok""")),
    "stage_counts": (stage_counts, sql("photos", """SELECT count(*) AS photos, count(DISTINCT camera_id) AS cameras, count(*) FILTER (NOT decode_ok) AS unreadable, count(*) FILTER (NOT timestamp_valid) AS invalid_clock,
  count(*) FILTER (decode_ok) AS decoded, count(*) FILTER (is_near_duplicate) AS near_duplicates, count(*) FILTER (is_blurry) AS blurry, count(*) AS runs, count(detect_error) AS failed FROM photos""")),
    "pixel_figures": (pixel_figures, """
WITH p AS (SELECT p_partkey, p_partkey % 2 = 1 AS ramp, p_partkey % 7 + 1 AS s, p_partkey * 7 % 256 AS r, p_partkey * 11 % 256 AS g, p_partkey * 13 % 256 AS b FROM part)
SELECT p_partkey, CASE WHEN ramp THEN round(8.0::DOUBLE * s * s / 18, 3) ELSE 0.0 END AS sharpness, CASE WHEN ramp THEN 8.5::DOUBLE * s ELSE floor(0.299::DOUBLE * r + 0.587 * g + 0.114 * b + 0.5) END AS brightness,
  CASE WHEN ramp THEN round(s * sqrt((18 * 18 - 1) / 12.0::DOUBLE), 2) ELSE 0.0 END AS contrast, CASE WHEN ramp THEN 0.0 ELSE abs(r - g) + abs(g - b) END::DOUBLE AS ir_score,
  CASE WHEN ramp THEN 'ffffffffffffffff' ELSE '0000000000000000' END AS dhash FROM p"""),
    "sidecar_rows": (sidecar_rows, f"SELECT rel_path, nullif(c, '') AS side_camera FROM (SELECT 'a/' || k // 2 || '.jpg' AS rel_path, arg_max(CASE WHEN k % 4 <> 0 THEN 'c' || k ELSE '' END, k) AS c FROM ({_SUPPLIER}) GROUP BY 1)"),
    "survey_images": (survey_images, f"""SELECT k || '.jpg' AS file_name, CASE WHEN k % 3 = 0 THEN 'L' ELSE 'C' END || k % 5 AS camera_id, CASE WHEN k % 2 = 0 THEN '2020-01-01' ELSE '2019' END AS timestamp,
  CASE WHEN k % 4 <> 0 THEN 'q' END AS seq_id FROM ({_SUPPLIER}) WHERE k % 7 <> 0 AND k % 3 <> 2"""),
    "json_records": (json_records, f"SELECT 'r' || k % 10 AS k, max(s_suppkey) AS v FROM ({_SUPPLIER}) WHERE k % 5 >= 3 GROUP BY 1"),
    "torn_lines": (torn_lines, f"SELECT count(*) FILTER (k % 5 < 3) AS torn, count(*) FILTER (k % 5 >= 3) AS good FROM ({_SUPPLIER})"),
    "stored_records": (stored_records, "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS v FROM supplier"),
    "replaced_table": (replaced_table, "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 2 = 0"),
    "retried_records": (retried_records, """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 9 WHEN o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS fails FROM orders)
SELECT o_orderkey, CASE WHEN fails >= 4 THEN 'timeout' END AS error, least(fails + 1, 4) AS n_tries, CASE WHEN fails < 4 THEN 1 ELSE 0 END AS n_good FROM o"""),
    "group_medians": (group_medians, "SELECT l_returnflag, l_linestatus, round(median(l_extendedprice) FILTER (l_partkey % 9 <> 0), 4) AS median_price FROM lineitem GROUP BY ALL HAVING count(*) FILTER (l_partkey % 9 <> 0) > 0"),
    "species_bars": (species_bars, sql("folds", "SELECT species, count(DISTINCT event_id) AS n_events FROM event_species GROUP BY species ORDER BY n_events DESC, species LIMIT 15")),
    "graded_visits": (graded_visits, sql("events", _VISITS + ", seen AS (SELECT DISTINCT " + _VISIT + " AS visit_id, true AS seen FROM in_events), meant AS (SELECT visit_id, true AS meant FROM visits WHERE valid_clock)\n"
        + _row("visits seen", "coalesce(seen AND meant, false)", "seen FULL JOIN meant USING (visit_id)"))),
    "graded_events": (graded_events, sql("events", _VISITS + """, observed AS (SELECT e.*, v.kind, v.true_species, v.count AS true_count FROM events_ e JOIN shown USING (event_id) JOIN visits v USING (visit_id)),
animals AS (SELECT * FROM observed WHERE observation_type = 'animal'), told_ AS (
  SELECT a.*, l.lineage AS called, (SELECT array_to_string(['class' || n % 2, 'order' || n % 4, 'family' || n % 8, 'genus' || n % 16, 'species' || n % 32], ';') FROM (SELECT CAST(substr(a.true_species, 6) AS INT) AS n)) AS truth
  FROM animals a LEFT JOIN event_species l ON l.event_id = a.event_id AND l.species = a.species)
""" + _row("types", "observation_type = CASE kind WHEN 'empty' THEN 'blank' ELSE kind END", "observed") + " UNION ALL\n" + _row("counts", "max_animals = true_count", "animals") + " UNION ALL\n"
        + _row("species", "coalesce(called <> '' AND starts_with(truth || ';', called || ';'), false)", "told_", 0.9, " AND count(*) > 0"))),
    "graded_photos": (graded_photos, sql("photos", ", told AS (SELECT p.*, CAST(photo_id AS BIGINT) AS k FROM photos p)\n" + " UNION ALL\n".join([
        _row("clocks", "timestamp_valid <> (k % 23 = 0)", "told"), _row("cut files", "decode_ok <> (k % 29 = 0)", "told"), _row("infrared", "is_ir = (k % 11 < 4)", "told WHERE decode_ok"),
        _row("fog", "is_blurry", "told WHERE decode_ok AND k % 6 = 0", 0.8), _row("clear", "NOT is_blurry", "told WHERE decode_ok AND k % 6 <> 0", 0.95)]))),
    "graded_repeats": (graded_repeats, sql("photos", """, decoded AS (SELECT *, CAST(photo_id AS BIGINT) AS k, lag(year(timestamp)) OVER (PARTITION BY camera_id ORDER BY timestamp, rel_path) AS before FROM photos WHERE decode_ok),
repeats AS (SELECT * FROM decoded WHERE before = year(timestamp) AND k % 2 = 0), spread AS (SELECT k % 50 AS g, count(DISTINCT year(timestamp)) AS n FROM decoded GROUP BY 1)
""" + _row("repeats", "is_near_duplicate", "repeats", 0.9) + " UNION ALL\n" + _row("groups", "n = 1", "spread"))),
    "graded_outages": (graded_outages, sql("silences", """, silent AS (SELECT DISTINCT camera_id, true AS silent FROM gaps), out_ AS (SELECT 'cam' || c_custkey AS camera_id, true AS planned FROM customer WHERE c_custkey % 3 = 0)
""" + _row("outages", "coalesce(silent AND planned, false)", "silent FULL JOIN out_ USING (camera_id)"))),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in QUERIES.items() if text}
