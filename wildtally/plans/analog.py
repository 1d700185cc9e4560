"""The tables of a camera survey read out of the driver's tables, in Spark and in SQL.

Orders stand for photos (a customer is a camera), line items for detected boxes, parts for labels. What the tables
lack (clock faults, undecodable images, hashes) follows from the order's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wildtally.functions.taxonomy import UNRESOLVED, label_for_lineage
from wildtally.operators import photos as P
from wildtally.operators import quality as Q
from wildtally.settings import Settings

GAP_S, GAP_HOURS, COUNT_CONF, PER_PHOTO = 90 * 86400.0, 24.0 * 400, 0.2, 3
QUALITY = Settings(look_back_s=400 * 86400.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    second = F.expr("make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400)")
    camera = F.concat(F.lit("cam"), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("photo_id"), camera.alias("camera_id"), F.concat(camera, F.lit("/"), F.format_string("%09d", key)).alias("rel_path"),
        (F.col("o_orderdate") + second).alias("timestamp"), (key % 23 != 0).alias("timestamp_valid"),
    )


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media with raw metrics; an undecodable photo has none."""
    key = F.col("photo_id").cast("long")
    ok = key % 29 != 0
    when = lambda c: F.when(ok, c)
    return media(spark, sf_dir).withColumns({
        "decode_ok": ok, "sharpness": when((key * 37 % 1000) / 10.0), "brightness": when((key * 11 % 256).cast("double")),
        "ir_score": when((key % 11).cast("double")), "dhash": when(F.lower(F.lpad(F.hex(key % 64 * 16909061), 16, "0"))),
    })


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each photo, with the groups of near-duplicates."""
    return Q.add_flags(measured(spark, sf_dir), QUALITY).drop("camera_id", "rel_path", "timestamp", "timestamp_valid")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media with flags, without groups: no chain is followed."""
    return Q.photo_flags(measured(spark, sf_dir), QUALITY)


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags of flagged() alone."""
    return flagged(spark, sf_dir).drop("camera_id", "rel_path", "timestamp", "timestamp_valid", "parent")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("conf"), *map(F.col, ("l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity", "l_tax"))]
    named = F.create_map(*[F.lit(x) for x in ("A", "animal", "N", "person", "R", "vehicle")])
    rows = table(spark, sf_dir, "lineitem").withColumns({"conf": F.col("l_discount") * 10, "photo_id": F.col("l_orderkey").cast("string")})
    # what is made of the columns is made behind the window, so that all readers move the same columns and share one shuffle
    placed = rows.select(
        "photo_id", "conf", (F.row_number().over(W.partitionBy("photo_id").orderBy(*order)) - 1).cast("long").alias("box_idx"),
        "l_returnflag", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax",
    )
    return placed.select(
        "photo_id", "box_idx", F.try_element_at(named, F.col("l_returnflag")).alias("category"), "conf", (F.col("l_partkey") % 80 / 100.0).alias("x"), (F.col("l_suppkey") % 70 / 100.0).alias("y"),
        (F.col("l_linenumber") / 50.0 + 0.1).alias("w"), (F.col("l_quantity") / 200.0 + 0.05).alias("h"), F.col("l_partkey"),
        F.round(F.col("l_tax") * 10, 4).alias("score"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").filter(key % 19 != 0)
    return rows.select(key.cast("string").alias("photo_id"), F.when(key % 13 == 0, "timeout").alias("error"))


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    levels = F.array(*[F.concat(F.lit(name), k % n) for name, n in (("class", 2), ("order", 4), ("family", 8), ("genus", 16), ("species", 32))])
    lineage = F.array_join(F.slice(levels, F.lit(1), F.col("p_size") % 6), ";")
    named = F.when(F.col("p_size") % 6 == 5, F.concat(F.lit("kind "), k % 32)).otherwise(label_for_lineage(F.col("lineage")))
    labels = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", k, lineage.alias("lineage"))
    labels = labels.withColumn("species", F.when(F.col("lineage") == "", UNRESOLVED).otherwise(named)).select("l_partkey", "lineage", "species")
    boxes = P.select_boxes(detections(spark, sf_dir), COUNT_CONF, PER_PHOTO)
    return boxes.join(labels, "l_partkey").select("photo_id", "box_idx", "box_key", "species", "lineage", F.col("score").alias("species_score"))


#: The same tables for DuckDB, each query taking the ones it needs.
SQL = {
    "media": """media AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS photo_id, 'cam' || o_custkey AS camera_id, 'cam' || o_custkey || '/' || printf('%09d', o_orderkey) AS rel_path,
    o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS timestamp, o_orderkey % 23 <> 0 AS timestamp_valid, o_orderkey AS k FROM orders)""",
    "measured": """measured AS (
  SELECT *, k % 29 <> 0 AS decode_ok, CASE WHEN k % 29 <> 0 THEN (k * 37 % 1000) / 10.0::DOUBLE END AS sharpness,
    CASE WHEN k % 29 <> 0 THEN CAST(k * 11 % 256 AS DOUBLE) END AS brightness, CASE WHEN k % 29 <> 0 THEN CAST(k % 11 AS DOUBLE) END AS ir_score,
    CASE WHEN k % 29 <> 0 THEN k % 64 * 16909061 END AS bits FROM media)""",
    "flags": """flags AS (
  SELECT *, decode_ok AND coalesce(ir_score < 4, false) AS is_ir, decode_ok AND coalesce(brightness < 30, false) AS is_dark,
    decode_ok AND coalesce(brightness > 225, false) AS is_overexposed FROM measured), medians AS (
  SELECT camera_id, is_ir, median(sharpness) AS m FROM flags WHERE decode_ok GROUP BY ALL), judged AS (
  SELECT f.*, CASE WHEN decode_ok AND m > 0 THEN round_even(sharpness / m, 4) END AS sharpness_rel FROM flags f LEFT JOIN medians USING (camera_id, is_ir))""",
    "duplicates": """ordered AS (
  SELECT photo_id, camera_id, timestamp, bits, row_number() OVER (PARTITION BY camera_id ORDER BY timestamp, rel_path) AS n FROM measured WHERE bits IS NOT NULL), parents AS (
  SELECT a.photo_id, arg_max(b.photo_id, b.n) AS parent FROM ordered a JOIN ordered b
    ON a.camera_id = b.camera_id AND b.n BETWEEN a.n - 8 AND a.n - 1 AND epoch_us(a.timestamp) - epoch_us(b.timestamp) <= 400 * 86400 * 1000000::BIGINT
      AND bit_count(xor(a.bits, b.bits)) <= 6 GROUP BY a.photo_id), chains AS (
  SELECT photo_id, parent AS up FROM parents UNION ALL SELECT c.photo_id, p.parent FROM chains c JOIN parents p ON p.photo_id = c.up), dup_groups AS (
  SELECT photo_id, arg_min(up, n) AS dup_group FROM chains c JOIN (SELECT photo_id AS up, n FROM ordered) o USING (up) GROUP BY photo_id), quality AS (
  SELECT j.*, coalesce(sharpness_rel < 0.35, false) AND decode_ok AS is_blurry, coalesce(g.dup_group, j.photo_id) AS dup_group,
    decode_ok AND g.dup_group IS NOT NULL AS is_near_duplicate FROM judged j LEFT JOIN dup_groups g USING (photo_id))""",
    "boxes": """boxes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS photo_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount * 10 DESC, l_extendedprice, l_partkey,
      l_suppkey, l_linenumber, l_shipdate, l_quantity, l_tax) - 1 AS box_idx,
    CASE l_returnflag WHEN 'A' THEN 'animal' WHEN 'N' THEN 'person' WHEN 'R' THEN 'vehicle' END AS category, l_discount * 10 AS conf, l_partkey % 80 / 100.0::DOUBLE AS x,
    l_suppkey % 70 / 100.0::DOUBLE AS y, l_linenumber / 50.0::DOUBLE + 0.1 AS w, l_quantity / 200.0::DOUBLE + 0.05 AS h, l_partkey, round(l_tax * 10, 4) AS score FROM lineitem)""",
    "runs": """runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS photo_id, CASE WHEN o_orderkey % 13 = 0 THEN 'timeout' END AS error FROM orders WHERE o_orderkey % 19 <> 0)""",
    "labels": """part_labels AS (
  SELECT p_partkey AS l_partkey, p_size % 6 AS d, p_partkey % 32 AS kind, array_to_string(list_slice(['class' || p_partkey % 2, 'order' || p_partkey % 4,
    'family' || p_partkey % 8, 'genus' || p_partkey % 16, 'species' || p_partkey % 32], 1, p_size % 6), ';') AS lineage FROM part), named AS (
  SELECT l_partkey, lineage, CASE WHEN d = 0 THEN 'animal (unresolved)' WHEN d = 5 THEN 'kind ' || kind
    ELSE string_split(lineage, ';')[d] || ' (' || (['class', 'order', 'family', 'genus', 'species'])[d] || ')' END AS species FROM part_labels), selected AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY photo_id ORDER BY conf DESC, box_idx) AS place FROM boxes WHERE category = 'animal' AND conf >= 0.2) t WHERE place <= 3), classes AS (
  SELECT photo_id, box_idx, species, lineage, score AS species_score FROM selected JOIN named USING (l_partkey))""",
    "photos": """counts AS (
  SELECT photo_id, count(*) FILTER (category = 'animal') AS n_animals, count(*) FILTER (category = 'person') AS n_people,
    count(*) FILTER (category = 'vehicle') AS n_vehicles, max(conf) FILTER (category = 'animal') AS max_animal_conf FROM boxes WHERE conf >= 0.2 GROUP BY photo_id), first_label AS (
  SELECT photo_id, arg_min(species, box_idx) AS species FROM classes GROUP BY photo_id), photos AS (
  SELECT q.photo_id, q.camera_id, q.rel_path, q.timestamp, q.timestamp_valid, q.decode_ok, q.is_ir, q.is_dark, q.is_overexposed, q.is_blurry, q.is_near_duplicate,
    coalesce(n_animals, 0) AS n_animals, coalesce(n_people, 0) AS n_people, coalesce(n_vehicles, 0) AS n_vehicles, max_animal_conf,
    r.photo_id IS NOT NULL AND r.error IS NULL AS detected, r.error AS detect_error, l.species
  FROM quality q LEFT JOIN counts c USING (photo_id) LEFT JOIN runs r USING (photo_id) LEFT JOIN first_label l USING (photo_id))""",
    "per_photo": """per_photo AS (
  SELECT b.photo_id, coalesce(c.species, 'animal (unresolved)') AS species, coalesce(c.lineage, '') AS lineage, count(*) AS count, max(species_score) AS max_score
  FROM boxes b LEFT JOIN classes c ON b.photo_id = c.photo_id AND b.box_idx = c.box_idx WHERE category = 'animal' AND conf >= 0.2 GROUP BY ALL)""",
    "sessions": """steps AS (
  SELECT *, epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY camera_id ORDER BY timestamp, rel_path) AS gap FROM photos WHERE timestamp_valid AND decode_ok), numbered AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap > 90 * 86400 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY camera_id ORDER BY timestamp, rel_path
    ROWS UNBOUNDED PRECEDING) AS number FROM steps), in_events AS (
  SELECT *, camera_id || '-e' || printf('%05d', CAST(number AS BIGINT)) AS event_id FROM numbered)""",
    "folds": """most AS (
  SELECT event_id, max(n_animals) AS most, min(camera_id) AS camera_id, min(timestamp) AS start FROM in_events GROUP BY event_id), rows_ AS (
  SELECT event_id, p.* FROM per_photo p JOIN in_events USING (photo_id)), names AS (
  SELECT event_id, species, min((photo_id, lineage)) AS first, arg_max(lineage, (photo_id, lineage)) AS lineage FROM rows_ GROUP BY ALL), mixed AS (
  SELECT n.*, most <= 1 AS single FROM names n JOIN most USING (event_id) WHERE event_id IN (SELECT event_id FROM names GROUP BY 1 HAVING count(*) > 1)), leaves AS (
  SELECT * FROM mixed a WHERE NOT EXISTS (SELECT 1 FROM mixed b WHERE a.event_id = b.event_id
    AND ((a.lineage = '' AND b.lineage <> '') OR starts_with(b.lineage, a.lineage || ';')))), below AS (
  SELECT a.event_id, a.species, count(*) AS n, any_value(b.species) AS to_species, any_value(b.lineage) AS to_lineage FROM mixed a JOIN leaves b
    ON a.event_id = b.event_id AND ((a.lineage = '' AND b.lineage <> '') OR starts_with(b.lineage, a.lineage || ';')) GROUP BY ALL), fold AS (
  SELECT m.*, CASE WHEN n = 1 THEN b.to_species ELSE m.species END AS to_species, CASE WHEN n = 1 THEN b.to_lineage ELSE m.lineage END AS to_lineage
  FROM mixed m LEFT JOIN below b USING (event_id, species)), differ AS (
  SELECT event_id FROM fold WHERE single GROUP BY event_id HAVING count(DISTINCT to_species) > 1), shared AS (
  SELECT event_id, coalesce(max(prefix), '') AS lineage FROM (
    SELECT event_id, any_value(array_to_string(list_slice(string_split(lineage, ';'), 1, d), ';')) AS prefix
    FROM mixed SEMI JOIN differ USING (event_id) CROSS JOIN range(1, 6) t(d) GROUP BY event_id, d
    HAVING min(CASE WHEN lineage = '' THEN 0 ELSE len(string_split(lineage, ';')) END) >= d
      AND count(DISTINCT array_to_string(list_slice(string_split(lineage, ';'), 1, d), ';')) = 1) GROUP BY event_id), common AS (
  SELECT d.event_id, coalesce(s.lineage, '') AS lineage FROM differ d LEFT JOIN shared s USING (event_id)), called AS (
  SELECT c.event_id, c.lineage, coalesce(arg_min(m.species, m.first), CASE WHEN c.lineage = '' THEN 'animal (unresolved)' ELSE string_split(c.lineage, ';')[-1] || ' ('
    || (['class', 'order', 'family', 'genus', 'species'])[len(string_split(c.lineage, ';'))] || ')' END) AS species
  FROM common c LEFT JOIN mixed m ON m.event_id = c.event_id AND m.lineage = c.lineage GROUP BY c.event_id, c.lineage), told AS (
  SELECT r.event_id, r.photo_id, r.count, r.max_score, coalesce(c.species, f.to_species, r.species) AS species, coalesce(c.lineage, f.to_lineage, r.lineage) AS lineage
  FROM rows_ r LEFT JOIN fold f USING (event_id, species) LEFT JOIN called c ON c.event_id = r.event_id), frames AS (
  SELECT event_id, photo_id, species, lineage, sum(count) AS count, max(max_score) AS max_score FROM told GROUP BY ALL), event_species AS (
  SELECT f.event_id, camera_id, start, species, lineage, CAST(max(count) AS BIGINT) AS max_count, count(*) AS n_photos, max(max_score) AS max_score
  FROM frames f JOIN most USING (event_id) GROUP BY ALL)""",
    "events": """grouped AS (
  SELECT event_id, min(camera_id) AS camera_id, min(timestamp) AS start, max(timestamp) AS "end", count(*) AS n_photos, count(*) FILTER (n_animals > 0) AS n_animal_photos,
    max(n_animals) AS max_animals, max(n_people) > 0 AS has_person, max(n_vehicles) > 0 AS has_vehicle FROM in_events GROUP BY event_id), best AS (
  SELECT event_id, photo_id AS best_photo_id FROM (SELECT event_id, photo_id, row_number() OVER (PARTITION BY event_id
    ORDER BY n_animals DESC, max_animal_conf DESC NULLS LAST, timestamp, rel_path) AS r FROM in_events) WHERE r = 1), prime AS (
  SELECT event_id, species, max_count FROM (SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY max_count DESC, n_photos DESC, max_score DESC NULLS LAST, species) AS r FROM event_species) WHERE r = 1), events_ AS (
  SELECT event_id, camera_id, start, "end", (epoch_us("end") - epoch_us(start)) / 1e6 AS duration_s, n_photos, n_animal_photos, max_animals, has_person, has_vehicle,
    CASE WHEN n_animal_photos > 0 THEN 'animal' WHEN has_person THEN 'person' WHEN has_vehicle THEN 'vehicle' ELSE 'blank' END AS observation_type,
    p.species, coalesce(p.max_count, 0) AS species_count, best_photo_id FROM grouped LEFT JOIN prime p USING (event_id) LEFT JOIN best USING (event_id))""",
    "silences": """silences AS (
  SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY camera_id ORDER BY timestamp))) / 1e6 / 3600 AS hours,
    lag(timestamp) OVER (PARTITION BY camera_id ORDER BY timestamp) AS before FROM photos WHERE timestamp_valid), gaps AS (
  SELECT camera_id, before AS gap_start, timestamp AS gap_end, round_even(hours, 1) AS gap_hours FROM silences WHERE hours > 9600)""",
}
ORDER = list(SQL)


def with_tables(upto: str, select: str, recursive: bool = True) -> str:
    """A query over the analog tables, those up to `upto` defined before it."""
    return "WITH RECURSIVE " + ",\n".join(SQL[k] for k in ORDER[: ORDER.index(upto) + 1]) + "\n" + select
