"""Queries over the driver's tables, and the SQL that says what each should return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.functions import scalars, taxonomy
from wildtally.operators import charts, events, incremental, photos, quality, summaries
from wildtally.plans import analog as A
from wildtally.plans import grading

Query = Callable[[SparkSession, str], DataFrame]
PHOTO_COLUMNS = (
    "photo_id", "camera_id", "rel_path", "timestamp", "timestamp_valid", "decode_ok", "is_ir", "is_dark", "is_overexposed", "is_blurry", "is_near_duplicate",
    "n_animals", "n_people", "n_vehicles", "max_animal_conf", "detected", "detect_error", "species",
)


def photo_table(spark: SparkSession, d: str) -> DataFrame:
    media = A.media(spark, d)
    whole = photos.build_photo_table(media, A.flags(spark, d), A.detections(spark, d), A.runs(spark, d), A.classifications(spark, d), A.COUNT_CONF)
    return whole.select(*PHOTO_COLUMNS)


def per_photo(spark: SparkSession, d: str) -> DataFrame:
    return photos.photo_species(A.detections(spark, d), A.classifications(spark, d), A.COUNT_CONF)


def counted_photos(spark: SparkSession, d: str) -> DataFrame:
    """What events need of the photos: clock, decoding and box counts, no flags or labels."""
    counts = photos.box_counts(A.detections(spark, d), A.COUNT_CONF)
    whole = A.measured(spark, d).select("photo_id", "camera_id", "rel_path", "timestamp", "timestamp_valid", "decode_ok").join(counts, "photo_id", "left")
    return whole.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_animals", "n_people", "n_vehicles")})


def built(spark: SparkSession, d: str, keep_labels: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    return events.build_events(counted_photos(spark, d), per_photo(spark, d), A.GAP_S, keep_labels)


def sessions(spark: SparkSession, d: str) -> DataFrame:
    """Gap sessions of the event stream's users."""
    rows = A.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("photo_id"), F.concat(F.lit("user"), F.col("user_id")).alias("camera_id"), F.col("ts").alias("timestamp"),
        F.format_string("%012d", "event_id").alias("rel_path"), (F.col("ts") > F.lit("2024-01-02").cast("timestamp_ntz")).alias("timestamp_valid"), F.lit(True).alias("decode_ok"),
    )
    found = events.assign_events(rows, 21600).filter("event_id is not null").groupBy("event_id")
    whole = found.agg(F.min("camera_id").alias("camera_id"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count("*").alias("n_photos"))
    return whole.withColumn("duration_s", scalars.seconds_between(F.col("start"), F.col("end")))


def session_windows(spark: SparkSession, d: str) -> DataFrame:
    """The same sessions by Spark's own session window (no numbers)."""
    rows = A.table(spark, d, "events").filter(F.col("ts") > F.lit("2024-01-02").cast("timestamp_ntz"))
    found = rows.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.count("*").alias("n_photos"), F.min("ts").alias("start"))
    return found.select("user_id", "start", "n_photos")


def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    return A.quality(spark, d).select("photo_id", "decode_ok", "sharpness", "sharpness_rel", "is_ir", "is_dark", "is_overexposed", "is_blurry", "dup_group", "is_near_duplicate")


def near_duplicate_chains(spark: SparkSession, d: str) -> DataFrame:
    return quality.near_duplicate_parents(A.measured(spark, d), 6, 8, 400 * 86400.0).filter("parent is not null")


def selected_boxes(spark: SparkSession, d: str) -> DataFrame:
    return photos.select_boxes(A.detections(spark, d), A.COUNT_CONF, A.PER_PHOTO).select("photo_id", "box_idx", "conf", "box_key")


def boxes_by_photo(spark: SparkSession, d: str) -> DataFrame:
    chosen = photos.select_boxes(A.detections(spark, d), A.COUNT_CONF, A.PER_PHOTO)
    found = photos.photos_with_boxes(chosen)
    return found.select("photo_id", F.size("boxes").cast("long").alias("n_boxes"), F.array_join(F.transform("boxes", lambda b: b["box_idx"].cast("string")), ",").alias("order"))


def event_labels(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d, keep_labels=True)[2]


def event_table(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d)[1]


def gaps(spark: SparkSession, d: str) -> DataFrame:
    return summaries.camera_gaps(A.media(spark, d), A.GAP_HOURS)


def health(spark: SparkSession, d: str) -> DataFrame:
    whole, (_, found, _) = photo_table(spark, d), built(spark, d)
    return summaries.camera_health(whole, found, gaps(spark, d))


def by_camera(spark: SparkSession, d: str) -> DataFrame:
    return summaries.species_by_camera(event_labels(spark, d), summaries.camera_effort(A.media(spark, d), gaps(spark, d)))


def overview(spark: SparkSession, d: str) -> DataFrame:
    """Labels are written once and read by both figures of them; photos need clocks and flags alone, no boxes."""
    _, found, labels = built(spark, d, keep_labels=True)
    return summaries.overview(A.flagged(spark, d), found, labels)


def rolled_up(spark: SparkSession, d: str) -> DataFrame:
    """Each order's lines as the scored labels of one box."""
    k = F.col("l_partkey")
    label = F.concat_ws(";", F.lit("id"), *[F.concat(F.lit(n), k % m) for n, m in (("class", 2), ("order", 4), ("family", 8), ("genus", 16), ("species", 32))], F.concat(F.lit("kind "), k % 32))
    vague = F.when(k % 7 == 0, F.lit("blank")).otherwise(label)
    score = (F.col("l_linenumber") % 4 + 1) / 16.0
    rows = A.table(spark, d, "lineitem").select("l_orderkey", F.struct((-score).alias("minus"), k.alias("key"), vague.alias("label")).alias("x"))
    ranked = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x"))  # a few lines an order
    labels = taxonomy.scored_labels(F.col("classes"), F.col("scores"))
    arrays = ranked.select("l_orderkey", F.col("x.label").alias("classes"), F.transform("x", lambda x: -x["minus"]).alias("scores"))
    called = arrays.select("l_orderkey", labels.alias("labels")).select("l_orderkey", taxonomy.roll_up(F.col("labels"), 0.3).alias("call"))
    return called.select("l_orderkey", "call.species", F.col("call.score").alias("species_score"), F.col("call.level").alias("species_level"), "call.lineage")


def matched_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Each person box of a photo and the animal box it overlaps most, if by a tenth at least."""
    boxes = A.detections(spark, d)
    mine, other = boxes.filter("category = 'person'"), boxes.filter("category = 'animal'")
    corner = lambda p: [F.col(f"{p}.{c}") for c in "xywh"]
    pairs = mine.alias("a").join(other.alias("b"), F.col("a.photo_id") == F.col("b.photo_id")).withColumn("iou", scalars.iou(corner("a"), corner("b")))
    best = pairs.filter(F.col("iou") >= 0.1).groupBy(F.col("a.photo_id").alias("photo_id"), F.col("a.box_idx").alias("box_idx"))
    return best.agg(F.min_by(F.struct(F.col("b.box_idx").alias("m"), "iou"), F.struct(-F.col("iou"), F.col("b.box_idx"))).alias("x")).select("photo_id", "box_idx", F.col("x.m").alias("match_idx"), F.round("x.iou", 9).alias("iou"))


def clean_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of line items; confidences and corners hold exact halves of the fourth decimal and doubles next to one."""
    conf, x = F.col("l_partkey") % 32 / 32.0, F.col("l_partkey") * 7919 % 100_000 / 100_000.0
    box = F.struct(F.lit("animal").alias("category"), conf.alias("conf"), F.array(x, F.col("l_discount") * 12, F.col("l_quantity") / 40, F.lit(0.25)).alias("bbox"))
    one = A.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", F.explode(scalars.clean_boxes(F.array(box))).alias("b"))
    return one.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "b.conf", *[F.get("b.bbox", F.lit(k)).alias(c) for k, c in enumerate("xywh")])


def hour_grid(spark: SparkSession, d: str) -> DataFrame:
    return charts.hour_grid(summaries.activity_by_hour(event_labels(spark, d)))


def hour_shares(spark: SparkSession, d: str) -> DataFrame:
    labels = event_labels(spark, d)
    return charts.hour_shares(summaries.activity_by_hour(labels), summaries.species_totals(labels))


def species_camera_cells(spark: SparkSession, d: str) -> DataFrame:
    labels = event_labels(spark, d)
    table = labels.groupBy("camera_id", "species").agg(F.countDistinct("event_id").alias("n_events"))
    return charts.species_camera_cells(table, summaries.species_totals(labels), 5)


def uptime(spark: SparkSession, d: str) -> DataFrame:
    """Every day of each user of the event stream, and which days lie in a silence of more than 36 hours."""
    stream = A.table(spark, d, "events").select(F.concat(F.lit("user"), "user_id").alias("camera_id"), F.col("ts").alias("timestamp"), F.lit(True).alias("timestamp_valid"))
    return charts.uptime_calendar(summaries.daily_photos(stream), summaries.camera_gaps(stream, 36.0))


def largest(spark: SparkSession, d: str) -> DataFrame:
    return charts.largest_sightings(event_table(spark, d)).select("event_id", "species", "species_count", "n_photos", "start")


def resume_work(spark: SparkSession, d: str) -> DataFrame:
    """Orders still to do: no run, or one that ended in an error."""
    return incremental.still_to_do(A.media(spark, d).select("photo_id"), A.runs(spark, d), "photo_id")


def new_images(spark: SparkSession, d: str) -> DataFrame:
    whole = A.media(spark, d)
    return incremental.find_new_images(whole, whole.filter(F.col("photo_id").cast("long") % 10 != 3))


def last_records(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user and type, by time then number."""
    rows = A.table(spark, d, "events").withColumn("key", F.concat_ws("/", "user_id", "event_type"))
    return incremental.last_of_each(rows, "key", F.struct("ts", "event_id")).select("key", "event_id", "ts", "value")


def sample_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = A.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("camera_id"), F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("file_name"), F.floor(F.col("event_id") / 700).cast("string").alias("seq_id")
    )
    return incremental.contiguous_runs(rows, F.floor(F.col("n") / 3) + 1, 10).select("camera_id", "file_name", F.col("place").cast("long").alias("place"))


def parsed_props(spark: SparkSession, d: str) -> DataFrame:
    """JSON read with a schema, malformed rows and missing keys as null, then summed up."""
    k = F.from_json("props", "k long")["k"]
    return A.table(spark, d, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"), F.countDistinct(k).alias("n_values"))


def kept_visits(spark: SparkSession, d: str) -> DataFrame:
    """Events of each user and day at least an hour after the last one kept."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    second = scalars.micros_between(day, F.col("ts")) / 1e6
    rows = A.table(spark, d, "events").groupBy("user_id", day.alias("day")).agg(F.sort_array(F.collect_list(second)).alias("s"))
    return rows.select("user_id", "day", F.size("s").cast("long").alias("n"), F.size(incremental.spaced(F.col("s"), 3600.0)).cast("long").alias("kept"))


def graded(spark: SparkSession, d: str) -> DataFrame:
    """Events of the sessions held against visits a day long, one row for each check."""
    whole, found, _ = built(spark, d)
    visit = F.concat_ws("/", "camera_id", F.year("timestamp"))
    return grading.event_checks(whole.withColumn("truth_visit_id", visit), found)


def sql(upto: str, select: str) -> str:
    return A.with_tables(upto, select)


_EVENT_SPECIES = "event_id, camera_id, start, species, lineage, max_count, n_photos, max_score"
_TOTALS = """SELECT species, count(DISTINCT event_id) AS n_events, count(DISTINCT camera_id) AS n_cameras, CAST(sum(max_count) AS BIGINT) AS animals,
  min(start) AS first_seen, max(start) AS last_seen FROM event_species GROUP BY species"""
_ACTIVITY = """SELECT s.species, h.hour, count(e.event_id) AS n_events FROM (SELECT DISTINCT species FROM event_species) s CROSS JOIN (SELECT range AS hour FROM range(24)) h
  LEFT JOIN event_species e ON e.species = s.species AND hour(e.start) = h.hour GROUP BY ALL"""
_HEALTH = """steps_ AS (
  SELECT camera_id, max((epoch_us(timestamp) - epoch_us(before)) / 1e6 / 3600) AS longest FROM silences GROUP BY camera_id), own AS (
  SELECT camera_id, count(*) AS n_photos, count(*) FILTER (NOT decode_ok) AS n_unreadable, count(*) FILTER (NOT timestamp_valid) AS n_invalid_timestamp,
    min(timestamp) FILTER (timestamp_valid) AS first_photo, max(timestamp) FILTER (timestamp_valid) AS last_photo,
    count(DISTINCT CAST(timestamp AS DATE)) FILTER (timestamp_valid) AS active_days,
    round_even(100.0::DOUBLE * avg(is_ir::INT) FILTER (decode_ok), 1) AS pct_ir, round_even(100.0::DOUBLE * avg(is_dark::INT) FILTER (decode_ok), 1) AS pct_dark,
    round_even(100.0::DOUBLE * avg(is_blurry::INT) FILTER (decode_ok), 1) AS pct_blurry, round_even(100.0::DOUBLE * avg(is_near_duplicate::INT) FILTER (decode_ok), 1) AS pct_near_duplicate,
    round_even(100.0::DOUBLE * avg((n_animals + n_people + n_vehicles = 0)::INT) FILTER (decode_ok AND detected), 1) AS pct_empty FROM photos GROUP BY camera_id), quiet AS (
  SELECT camera_id, count(*) AS n_gaps, sum(gap_hours) AS silent FROM gaps GROUP BY camera_id), seen AS (
  SELECT camera_id, count(*) AS n_events, count(*) FILTER (observation_type = 'animal') AS n_animal_events FROM events_ GROUP BY camera_id), spans AS (
  SELECT *, coalesce((epoch_us(last_photo) - epoch_us(first_photo)) / 1e6 / 86400, 0.0) AS span FROM own), health AS (
  SELECT camera_id, n_photos, n_unreadable, n_invalid_timestamp, first_photo, last_photo, round_even(span, 2) AS span_days, active_days,
    round_even(greatest(span - coalesce(silent, 0.0) / 24.0, 0.0), 2) AS effort_days, coalesce(n_gaps, 0) AS n_gaps, round_even(longest, 1) AS longest_silence_hours,
    coalesce(n_events, 0) AS n_events, coalesce(n_animal_events, 0) AS n_animal_events, pct_ir, pct_dark, pct_blurry, pct_near_duplicate, pct_empty
  FROM spans LEFT JOIN steps_ USING (camera_id) LEFT JOIN quiet USING (camera_id) LEFT JOIN seen USING (camera_id))"""

_HOURS = ", ".join(f"coalesce(sum(n_events) FILTER (hour = {h}), 0)::BIGINT AS h{h:02d}" for h in range(24))

#: name: the query, its SQL.
QUERIES: dict[str, tuple[Query, str]] = {
    "sessions": (sessions, """
WITH steps AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events WHERE ts > TIMESTAMP '2024-01-02'),
numbered AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM steps)
SELECT 'user' || user_id || '-e' || printf('%05d', CAST(n AS BIGINT)) AS event_id, 'user' || user_id AS camera_id, min(ts) AS start, max(ts) AS "end", count(*) AS n_photos,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s FROM numbered GROUP BY user_id, n"""),
    "session_windows": (session_windows, """
WITH steps AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events WHERE ts > TIMESTAMP '2024-01-02'),
numbered AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM steps)
SELECT user_id, min(ts) AS start, count(*) AS n_photos FROM numbered GROUP BY user_id, n"""),
    "quality_flags": (quality_flags, sql("duplicates", "SELECT photo_id, decode_ok, sharpness, sharpness_rel, is_ir, is_dark, is_overexposed, is_blurry, dup_group, is_near_duplicate FROM quality")),
    "near_duplicate_chains": (near_duplicate_chains, sql("duplicates", "SELECT photo_id, parent FROM parents")),
    "selected_boxes": (selected_boxes, sql("labels", "SELECT photo_id, box_idx, conf, printf('%s:%.4f,%.4f,%.4f,%.4f', photo_id, x, y, w, h) AS box_key FROM selected")),
    "boxes_by_photo": (boxes_by_photo, sql("labels", "SELECT photo_id, count(*) AS n_boxes, string_agg(CAST(box_idx AS VARCHAR), ',' ORDER BY box_idx) AS \"order\" FROM selected GROUP BY photo_id")),
    "photo_table": (photo_table, sql("photos", f"SELECT {', '.join(PHOTO_COLUMNS)} FROM photos")),
    "photo_species": (per_photo, sql("per_photo", "SELECT * FROM per_photo")),
    "event_species": (event_labels, sql("folds", f"SELECT {_EVENT_SPECIES} FROM event_species")),
    "events": (event_table, sql("events", "SELECT * FROM events_")),
    "species_totals": (lambda s, d: summaries.species_totals(event_labels(s, d)), sql("folds", _TOTALS)),
    "activity_by_hour": (lambda s, d: summaries.activity_by_hour(event_labels(s, d)), sql("folds", _ACTIVITY)),
    "camera_gaps": (gaps, sql("silences", "SELECT * FROM gaps")),
    "camera_health": (health, sql("silences", "").rstrip() + ",\n" + _HEALTH + " SELECT * FROM health"),
    "species_by_camera": (by_camera, sql("silences", "").rstrip() + ",\n" + _HEALTH + """, pairs AS (
  SELECT camera_id, species, count(DISTINCT event_id) AS n_events, CAST(sum(max_count) AS BIGINT) AS animals, max(max_count) AS max_group FROM event_species GROUP BY ALL)
SELECT p.*, CASE WHEN effort_days > 0 THEN round_even(100.0::DOUBLE * p.n_events / effort_days, 1) END AS events_per_100_days FROM pairs p LEFT JOIN health h USING (camera_id)"""),
    "daily_photos": (lambda s, d: summaries.daily_photos(A.media(s, d)), sql("media", "SELECT camera_id, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS date, count(*) AS n_photos FROM media WHERE timestamp_valid GROUP BY ALL")),
    "overview": (overview, sql("events", """SELECT p.*, e.*, l.* FROM (
  SELECT count(*) AS n_photos, count(DISTINCT camera_id) AS n_cameras, min(timestamp) FILTER (timestamp_valid) AS first_photo, max(timestamp) FILTER (timestamp_valid) AS last_photo,
    count(*) FILTER (NOT decode_ok) AS n_unreadable, count(*) FILTER (NOT timestamp_valid) AS n_invalid_timestamp,
    round_even(100.0::DOUBLE * avg(is_near_duplicate::INT) FILTER (decode_ok), 1) AS pct_near_duplicate, round_even(100.0::DOUBLE * avg(is_ir::INT) FILTER (decode_ok), 1) AS pct_ir FROM photos) p, (
  SELECT count(*) AS n_events, count(*) FILTER (observation_type = 'animal') AS n_animal_events, count(*) FILTER (observation_type = 'person') AS n_person_events,
    count(*) FILTER (observation_type = 'vehicle') AS n_vehicle_events, count(*) FILTER (observation_type = 'blank') AS n_blank_events FROM events_) e, (
  SELECT count(DISTINCT species) FILTER (len(string_split(lineage, ';')) = 5) AS n_species, count(DISTINCT species) AS n_labels FROM event_species) l""")),
    "rolled_up": (rolled_up, """
WITH lines AS (
  SELECT l_orderkey, l_partkey AS k, (l_linenumber % 4 + 1) / 16.0::DOUBLE AS score, l_partkey % 7 <> 0 AS taxon, ['class' || k % 2, 'order' || k % 4, 'family' || k % 8, 'genus' || k % 16, 'species' || k % 32] AS f,
    CASE WHEN l_partkey % 7 = 0 THEN 'blank' ELSE 'id;' || array_to_string(f, ';') || ';kind ' || k % 32 END AS label FROM lineitem),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, k, label) AS r FROM lines) WHERE r = 1),
sums AS (SELECT l_orderkey, d, array_to_string(f[1:d], ';') AS lineage, sum(score) AS total FROM lines CROSS JOIN range(1, 5) t(d) WHERE taxon GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, d ORDER BY total DESC, lineage) AS r FROM sums) WHERE r = 1 AND total >= 0.3),
deepest AS (SELECT l_orderkey, max(d) AS d, arg_max(lineage, d) AS lineage, arg_max(total, d) AS total FROM best GROUP BY l_orderkey)
SELECT t.l_orderkey, CASE WHEN t.score >= 0.3 AND t.taxon THEN 'kind ' || t.k % 32 WHEN t.score >= 0.3 OR b.d IS NULL THEN 'animal (unresolved)'
    ELSE string_split(b.lineage, ';')[-1] || ' (' || (['class', 'order', 'family', 'genus'])[b.d] || ')' END AS species,
  CASE WHEN t.score >= 0.3 OR b.d IS NULL THEN t.score ELSE b.total END AS species_score,
  CASE WHEN t.score >= 0.3 AND t.taxon THEN 'species' WHEN t.score >= 0.3 OR b.d IS NULL THEN 'unresolved' ELSE (['class', 'order', 'family', 'genus'])[b.d] END AS species_level,
  CASE WHEN t.score >= 0.3 AND t.taxon THEN array_to_string(t.f, ';') WHEN t.score >= 0.3 OR b.d IS NULL THEN '' ELSE b.lineage END AS lineage
FROM top t LEFT JOIN deepest b USING (l_orderkey)"""),
    "matched_boxes": (matched_boxes, sql("boxes", """, pairs AS (
  SELECT a.photo_id, a.box_idx, b.box_idx AS match_idx, greatest(0.0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0.0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS inside,
    a.w * a.h + b.w * b.h AS both_ FROM boxes a JOIN boxes b ON a.photo_id = b.photo_id AND a.category = 'person' AND b.category = 'animal'), shares AS (
  SELECT *, CASE WHEN both_ - inside > 0 THEN inside / (both_ - inside) ELSE 0.0 END AS iou FROM pairs)
SELECT photo_id, box_idx, match_idx, round(iou, 9) AS iou FROM (SELECT *, row_number() OVER (PARTITION BY photo_id, box_idx ORDER BY iou DESC, match_idx) AS r FROM shares WHERE iou >= 0.1) WHERE r = 1""")),
    "clean_boxes": (clean_boxes, """
WITH raw AS (SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_partkey % 32 / 32.0::DOUBLE AS conf, l_partkey * 7919 % 100000 / 100000.0::DOUBLE AS x, greatest(0.0, least(1.0, l_discount * 12)) AS y,
  greatest(0.0, least(1.0, l_quantity / 40)) AS w, 0.25::DOUBLE AS h FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, CAST(printf('%.4f', conf) AS DOUBLE) AS conf, CAST(printf('%.4f', x) AS DOUBLE) AS x, CAST(printf('%.4f', y) AS DOUBLE) AS y, CAST(printf('%.4f', least(w, 1 - x)) AS DOUBLE) AS w,
  CAST(printf('%.4f', least(h, 1 - y)) AS DOUBLE) AS h FROM raw"""),
    "hour_grid": (hour_grid, sql("folds", f"SELECT species, {_HOURS} FROM ({_ACTIVITY}) GROUP BY species")),
    "hour_shares": (hour_shares, sql("folds", f""", totals AS ({_TOTALS}), activity AS ({_ACTIVITY}), shown AS (SELECT species FROM totals ORDER BY n_events DESC, species LIMIT 6)
SELECT species, hour, 100.0::DOUBLE * n_events / sum(n_events) OVER (PARTITION BY species) AS percent FROM activity SEMI JOIN shown USING (species)""")),
    "species_camera_cells": (species_camera_cells, sql("folds", f""", totals AS ({_TOTALS}), shown AS (SELECT species FROM totals ORDER BY n_events DESC, species LIMIT 5),
  pairs AS (SELECT camera_id, species, count(DISTINCT event_id) AS n_events FROM event_species GROUP BY ALL)
SELECT c.camera_id, s.species, coalesce(n_events, 0) AS n_events FROM (SELECT DISTINCT camera_id FROM pairs) c CROSS JOIN shown s LEFT JOIN pairs p ON p.camera_id = c.camera_id AND p.species = s.species""")),
    "uptime_calendar": (uptime, """
WITH ev AS (SELECT 'user' || user_id AS camera_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), daily AS (
  SELECT camera_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS date, count(*) AS n_photos FROM ev GROUP BY ALL), days AS (
  SELECT camera_id, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM daily GROUP BY camera_id), quiet AS (
  SELECT DISTINCT camera_id, unnest(generate_series(CAST(date_trunc('day', before) AS TIMESTAMP), CAST(date_trunc('day', ts) AS TIMESTAMP), INTERVAL 1 DAY)) AS date
  FROM ev WHERE (epoch_us(ts) - epoch_us(before)) / 1e6 / 3600 > 36)
SELECT d.camera_id, d.date, coalesce(n_photos, 0) AS n_photos, n_photos IS NULL AND q.date IS NOT NULL AS silent FROM days d LEFT JOIN daily USING (camera_id, date) LEFT JOIN quiet q USING (camera_id, date)"""),
    "largest_sightings": (largest, sql("events", "SELECT event_id, species, species_count, n_photos, start FROM events_ WHERE observation_type = 'animal' ORDER BY species_count DESC, n_photos DESC, start, event_id LIMIT 12")),
    "resume_work": (resume_work, sql("runs", "SELECT photo_id FROM media WHERE photo_id NOT IN (SELECT photo_id FROM runs WHERE error IS NULL)")),
    "new_images": (new_images, sql("media", "SELECT rel_path FROM media WHERE k % 10 = 3")),
    "last_records": (last_records, """SELECT key, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value
FROM (SELECT *, user_id || '/' || event_type AS key FROM events) GROUP BY key"""),
    "sample_runs": (sample_runs, """
WITH ranked AS (SELECT CAST(user_id AS VARCHAR) AS camera_id, CAST(event_id AS VARCHAR) AS file_name, event_id // 700 AS seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS place,
  count(*) OVER (PARTITION BY user_id) AS n FROM events), runs AS (SELECT *, n // 3 + 1 AS a, least(n // 3 + 10, n) AS b FROM ranked), open AS (SELECT camera_id, seq FROM runs WHERE place = b)
SELECT r.camera_id, file_name, place FROM runs r JOIN open o USING (camera_id) WHERE place BETWEEN a AND b OR place > b AND r.seq = o.seq"""),
    "parsed_props": (parsed_props, "SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, count(DISTINCT k) AS n_values FROM (SELECT event_type, CAST(props ->> '$.k' AS BIGINT) AS k FROM events) GROUP BY event_type"),
    "kept_visits": (kept_visits, """
WITH RECURSIVE d AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, epoch_us(ts) AS us FROM events), walk AS (
  SELECT user_id, day, min(us) AS us FROM d GROUP BY ALL UNION ALL
  SELECT w.user_id, w.day, (SELECT min(d.us) FROM d WHERE d.user_id = w.user_id AND d.day = w.day AND d.us >= w.us + 3600000000) FROM walk w WHERE w.us IS NOT NULL)
SELECT user_id, day, (SELECT count(*) FROM d WHERE d.user_id = w.user_id AND d.day = w.day) AS n, count(us) AS kept FROM walk w GROUP BY ALL"""),
    "graded": (graded, sql("events", """, truth AS (SELECT event_id, camera_id || '/' || year(timestamp) AS visit FROM in_events), per_event AS (SELECT event_id, count(DISTINCT visit) AS n FROM truth GROUP BY 1), per_visit AS (SELECT visit, count(DISTINCT event_id) AS n FROM truth GROUP BY 1)
SELECT 'one visit an event' AS name, bool_and(n = 1) AS passed, count(*) FILTER (n = 1) AS good, count(*) AS total FROM per_event UNION ALL
SELECT 'one event a visit', bool_and(n = 1), count(*) FILTER (n = 1), count(*) FROM per_visit""")),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in QUERIES.items()}
