import json
import struct
import sys
import zlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from wildtally.cli import build_parser, main
from wildtally.errors import InputError
from wildtally.functions import pixels, scalars
from wildtally.plans import grading, stages
from wildtally.plans.pipeline import Pipeline
from wildtally.schemas import DETECTION_RECORDS, METRICS
from wildtally.settings import Settings
from wildtally.sources import images, tables
from wildtally.storage import Files
from wildtally.streaming import stream_sessions


def png(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + r.tobytes() for r in rgb)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def exif_jpeg(stamp: str) -> bytes:
    text = stamp.encode() + b"\0"
    make = b"Acme\0\0\0\0"
    ifd = struct.pack("<H", 2) + struct.pack("<HHII", 0x010F, 2, 8, 38) + struct.pack("<HHII", 0x0132, 2, len(text), 46) + struct.pack("<I", 0)
    tiff = b"II*\0" + struct.pack("<I", 8) + ifd + make + text
    app = b"Exif\0\0" + tiff
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(app) + 2) + app + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 48, 64, 1) + b"\0" * 6


def test_headers():
    h = images.read_header(exif_jpeg("2026:04:06 06:30:00"))
    assert (h.width, h.height, h.make.strip("\0"), h.date_time.strip("\0")) == (64, 48, "Acme", "2026:04:06 06:30:00")
    assert images.read_header(png(np.zeros((5, 7, 3), np.uint8))).width == 7
    with pytest.raises(ValueError):
        images.read_header(b"\xff\xd8\xff")
    with pytest.raises(ValueError):
        images.read_header(b"text")


def test_pixel_metrics():
    flat = np.full((32, 48, 3), 90, np.uint8)
    assert pixels.laplacian_variance(pixels.grey(flat)) == 0
    assert pixels.ir_score(flat) == 0
    ramp = np.repeat(np.arange(48, dtype=np.uint8)[None, :, None] * 5, 32, axis=0).repeat(3, axis=2)
    assert pixels.dhash(pixels.grey(ramp)) == "f" * 16
    assert pixels.dhash(pixels.grey(ramp[:, ::-1])) == "0" * 16
    assert pixels.crop_strips(flat, 0.1, 0.2).shape[0] == 32 - 3 - 6
    assert pixels.crop_strips(flat[:9], 0.4, 0.4).shape[0] == 9
    assert pixels.shrink(flat, 24).shape == (16, 24, 3)
    assert pixels.oriented(ramp, 6).shape == (48, 32, 3)
    grid = np.array([[1.0, 2, 3], [4, 9, 6], [7, 8, 9]])
    around = np.array([[2 * 4 + 2 * 2 - 4, 2 * 9 + 1 + 3 - 8, 2 * 2 + 2 * 6 - 12], [2 * 9 + 1 + 7 - 16, 2 + 8 + 4 + 6 - 36, 2 * 9 + 3 + 9 - 24], [2 * 4 + 2 * 8 - 28, 2 * 9 + 7 + 9 - 32, 2 * 6 + 2 * 8 - 36]])
    assert pixels.laplacian_variance(grid) == pytest.approx(float(around.var()))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests


class FromTruth:
    """A detector and classifier that knows what is in each photo, and breaks off at some."""

    name = "from-truth"

    def __init__(self, truth, stop=()):
        self.truth, self.stop = truth, stop

    def detect(self, image, *, path):
        if path in self.stop:
            raise RuntimeError(f"broken off at {path}")
        return [{"category": o["category"], "conf": 0.9, "bbox": o["bbox"]} for o in self.truth[path]["objects"]]

    def classify(self, image, boxes, *, path):
        o = self.truth[path]["objects"][0]
        return [{"classes": [f"id;{o['lineage']};{o['species']}"], "scores": [0.9]} for _ in boxes]


@pytest.fixture()
def survey(tmp_path):
    rng, start, truth = np.random.default_rng(3), datetime(2026, 4, 6, 8), {}
    root, lines = tmp_path / "photos", ["file,camera_id,timestamp"]
    scene = rng.integers(40, 200, (48, 64, 3), dtype=np.uint8)
    for visit in range(3):
        for k in range(2):
            path = f"cam_01/_v{visit}_{k}.png" if visit == 2 else f"cam_01/v{visit}_{k}.png"
            (root / "cam_01").mkdir(parents=True, exist_ok=True)
            (root / path).write_bytes(png(scene if visit < 2 else scene[::-1]))
            lines.append(f"{path},,{start + timedelta(hours=visit, seconds=2 * k):%Y-%m-%d %H:%M:%S}")
            deer = {"category": "animal", "species": "deer", "lineage": "m;c;f;g;d", "bbox": [0.2, 0.2, 0.3, 0.4]}
            truth[path] = {"night": False, "objects": [deer] if visit == 0 else []}
    (root / "cam_01" / "bad.png").write_bytes(b"cut")
    (root / "metadata.csv").write_text("\n".join(lines) + "\n")
    return root, truth


def test_pipeline_resumes_and_redoes(spark, survey, tmp_path):
    root, truth = survey
    out = tmp_path / "run"
    models = (lambda: FromTruth(truth), lambda: FromTruth(truth))
    run = Pipeline(spark, str(root), str(out), None, *models)
    assert all(line.split()[1] == "done" for line in run.run())
    events = run.read("events").orderBy("start").collect()
    assert run.read("media").count() == 7 and run.read("media").filter("not readable").count() == 1
    assert [e.observation_type for e in events][0] == "animal" and events[0].species == "deer"
    assert (out / "report.html").read_text().startswith("<!doctype html>")
    assert json.loads((out / "summary" / "overview.json").read_text())["n_photos"] == 7

    def never():
        raise AssertionError("no model should be built")

    (root / "cam_01" / "new.png").write_bytes(png(np.zeros((8, 8, 3), np.uint8)))
    again = Pipeline(spark, str(root), str(out), None, never, never)
    again.run(redo=["events"])
    assert again.new_images == ["cam_01/new.png"]
    assert again.read("events").count() == len(events)
    with pytest.raises(InputError):
        again.run(redo=["nothing"])
    with pytest.raises(InputError):
        Pipeline(spark, str(tmp_path / "none"), str(out))


def test_record_store_keeps_the_newest(spark, tmp_path):
    store = tables.RecordStore(spark, str(tmp_path / "r"), "k", "k string, v long")
    store.schema = spark.createDataFrame([], "k string, v long").schema
    assert store.read().count() == 0
    store.append(spark.createDataFrame([("a", 1), ("b", 1)], store.schema))
    store.append(spark.createDataFrame([("a", 2)], store.schema))
    assert sorted((r.k, r.v) for r in store.read().collect()) == [("a", 2), ("b", 1)]


def test_json_sources(spark, tmp_path):
    lines = tmp_path / "x.jsonl"
    lines.write_text('{"k":"a","v":1}\n{"v":9}\n[1]\n{"k":"a","v":2}\n{"k":"b"')
    assert [(r.k, r.v) for r in tables.read_json_records(spark, str(lines), "k", "k string, v long").collect()] == [("a", 2)]
    coco = tmp_path / "m.json"
    coco.write_text(json.dumps({"images": [{"file_name": "a.jpg", "location": 7, "datetime": "2026", "seq_id": "s"}, {"file_name": "b.jpg", "location": "", "camera": "c", "date_captured": "2025"}, {"file_name": "", "site": "x"}, {"file_name": "d.jpg"}]}))
    assert sorted((r.file_name, r.camera_id, r.timestamp) for r in tables.parse_metadata(spark, str(coco)).collect()) == [("a.jpg", "7", "2026"), ("b.jpg", "c", "2025")]
    coco.write_text("not json")
    with pytest.raises(InputError):
        tables.parse_metadata(spark, str(coco))
    side = tmp_path / "s.csv"
    side.write_text("file,camera_id\na\\b.jpg,x\na/b.jpg,y\n")
    assert [(r.rel_path, r.side_camera) for r in tables.load_sidecar(spark, str(side)).collect()] == [("a/b.jpg", "y")]
    side.write_text("name\nx\n")
    with pytest.raises(InputError):
        tables.load_sidecar(spark, str(side))


def test_grading_finds_tampering(spark):
    schema = "photo_id string, event_id string, truth_visit_id long"
    good = spark.createDataFrame([("a", "e1", 1), ("b", "e1", 1), ("c", "e2", 2)], schema)
    events = spark.createDataFrame([("e1",), ("e2",)], "event_id string")
    assert all(r.passed for r in grading.event_checks(good, events).collect())
    bad = spark.createDataFrame([("a", "e1", 1), ("b", "e1", 2), ("c", "e2", 2)], schema)
    assert not any(r.passed for r in grading.event_checks(bad, events).collect())


def test_streams(spark, tmp_path):
    rows = [("a", "c", "2026-04-06 08:00:00", True, True, "00"), ("b", "c", "2026-04-06 08:01:00", True, True, "01"), ("d", "c", "2026-04-06 08:02:01", True, True, "ff" * 8), ("z", "c", "2026-04-09 08:00:00", True, True, None)]
    df = spark.createDataFrame([(p, c, t, v, d, None if h is None else h.zfill(16)) for p, c, t, v, d, h in rows], "photo_id string, camera_id string, t string, timestamp_valid boolean, decode_ok boolean, dhash string")
    df.selectExpr("photo_id", "camera_id", "cast(t as timestamp_ntz) timestamp", "timestamp_valid", "decode_ok", "dhash").coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = stream_sessions(source, 60).writeStream.format("memory").queryName("s").outputMode("append").option("checkpointLocation", str(tmp_path / "s")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n_photos for r in spark.table("s").collect()) == [1, 2]


def test_command_line(tmp_path, capsys):
    assert main(["status", str(tmp_path)]) == 2
    assert "no run" in capsys.readouterr().err
    for bad in (["run", "x", "--out", "y", "--count-conf", "2"], ["run", "x", "--out", "y", "--valid-from", "soon"], ["fetch-sample", "x", "--cameras", "0"]):
        with pytest.raises(SystemExit):
            build_parser().parse_args(bad)


def test_a_run_is_graded_and_published(spark, survey, tmp_path, capsys):
    root, truth = survey
    images = {p: {"camera_id": "cam_01", "camera_clock": "2026-04-06 08:00:00", "visit_id": int(p.rpartition("v")[2][0]), "kind": "animal" if t["objects"] else "empty", "blurred": False, "truncated": False} | t for p, t in truth.items()}
    visits = [{"visit_id": k, "camera_id": "cam_01", "kind": "empty" if k else "animal", "species": None if k else "deer", "count": int(k == 0), "valid_clock": True} for k in range(3)]
    (root / "ground_truth.json").write_text(json.dumps({"images": images, "visits": visits, "cameras": [{"camera_id": "cam_01", "outage_days": []}]}))
    (root / "cam_01" / "bad.png").unlink()
    run = str(tmp_path / "run")
    Pipeline(spark, str(root), run, None, lambda: FromTruth(truth), lambda: FromTruth(truth)).run()
    assert main(["grade", str(root), "--out", run]) == 0, capsys.readouterr().out
    assert main(["publish", run, "--to", str(tmp_path / "out")]) == 0
    names = {p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith(".")}
    assert {"report.html", "plots/camera_uptime.svg", "summary/events.csv", "summary/species_totals.csv"} <= names
    for name in names:
        data = (tmp_path / "out" / name).read_bytes()
        assert b"\r\n" not in data and data.endswith(b"\n") and str(tmp_path).encode() not in data
    events = spark.read.parquet(f"{run}/events.parquet")
    tables.write_table(events.withColumn("max_animals", F.col("max_animals") + 1), f"{run}/events.parquet")
    assert main(["grade", str(root), "--out", run]) == 1


def test_a_crash_in_detection_keeps_what_came_before(spark, survey, tmp_path):
    root, truth = survey
    whole = Pipeline(spark, str(root), str(tmp_path / "run"), Settings(batch_photos=2), lambda: FromTruth(truth), lambda: FromTruth(truth))
    decoded = [(p,) for p in truth]
    rounds = {r.rel_path: r.k for r in spark.createDataFrame(decoded, "rel_path string").select("rel_path", F.pmod(F.xxhash64(pixels.photo_id_for("rel_path")), F.lit(3)).alias("k")).collect()}
    last = max(rounds.values())
    assert last > min(rounds.values())
    stop = {p for p, k in rounds.items() if k == last}
    broken = Pipeline(spark, str(root), str(tmp_path / "run"), Settings(batch_photos=2), lambda: FromTruth(truth, stop), lambda: FromTruth(truth))
    with pytest.raises(Exception, match="broken off"):
        broken.run()
    kept = broken.records("detect", "photo_id", DETECTION_RECORDS).read().count()
    assert kept == sum(k < last for k in rounds.values()) > 0
    assert all(line.split()[1] == "done" for line in whole.run())


def test_a_run_and_a_redo_on_another_file_system(spark, survey, tmp_path):
    root, truth = survey
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    (tmp_path / "far").mkdir()
    conf.set("fs.viewfs.mounttable.store.link./far", f"file://{tmp_path}/far")
    out = "viewfs://store/far/run"
    run = Pipeline(spark, str(root), out, None, lambda: FromTruth(truth), lambda: FromTruth(truth))
    assert all(line.split()[1] == "done" for line in run.run())
    before = run.read("detections").count()
    assert before == 2 and (tmp_path / "far" / "run" / "summary" / "camera_health.csv").exists()
    none = {p: {"night": False, "objects": []} for p in truth}
    again = Pipeline(spark, str(root), out, None, lambda: FromTruth(none), lambda: FromTruth(none))
    again.run(redo=["detect"])
    assert again.read("detections").count() == 0  # the kept records were deleted there, too


def test_what_a_crash_leaves_between_two_moves(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    tables.write_table(spark.range(3), path)
    move = Files.move

    def fails(self, a, b):
        if a.endswith(".new"):
            raise OSError("broken off")
        move(self, a, b)

    monkeypatch.setattr(Files, "move", fails)
    with pytest.raises(OSError, match="broken off"):
        tables.write_table(spark.range(5), path)
    monkeypatch.undo()
    assert not (tmp_path / "t").exists()
    assert tables.read_table(spark, path).count() == 3
    monkeypatch.setattr(Files, "move", fails)
    with pytest.raises(OSError, match="broken off"):
        tables.write_table(spark.range(5), path)
    monkeypatch.undo()
    assert tables.write_table(spark.range(7), path).count() == 7  # the old one isn't deleted before
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]
    torn = tmp_path / "r.jsonl"
    torn.write_text('{"k":"a","v":1}\n{"k":"c"')
    monkeypatch.setattr(Files, "put", lambda self, new, to: (move(self, to, f"{to}.old"), (_ for _ in ()).throw(OSError("broken off"))))
    with pytest.raises(OSError, match="broken off"):
        tables.mended_json_records(spark, f"file://{torn}", "k", "k string, v long")
    monkeypatch.undo()
    assert tables.mended_json_records(spark, f"file://{torn}", "k", "k string, v long") == 1
    assert torn.read_text() == '{"k":"a","v":1}\n'


SURVEY = [
    {"file_name": "a1.jpg", "location": "46", "datetime": "2013-10-04 13:31:53", "seq_id": "s1"}, {"file_name": "a2.jpg", "location": "46", "datetime": "2013-10-04 13:31:54", "seq_id": "s1"},
    {"file_name": "../evil.jpg", "location": "46", "datetime": "2013-10-04 13:31:55"},
    *({"file_name": f"b{k}.jpg", "location": "7", "date_captured": f"2012-01-01 01:00:0{k}", "seq_id": "t1"} for k in range(4)), {"file_name": "no_camera.jpg", "datetime": "2012"},
]


def test_sample_is_fetched_once_and_within_limits(spark, tmp_path):
    import io

    from wildtally.sources import sample

    base = ("https://example.org/meta.json", "https://example.org/images/")
    files, calls = {base[0]: json.dumps({"images": SURVEY}).encode()} | {base[1] + i["file_name"]: b"jpeg" for i in SURVEY if i["file_name"] != "b1.jpg"}, []

    def opener(request, timeout):
        calls.append(request.full_url)
        if request.full_url not in files:
            raise OSError("not there")
        return io.BytesIO(files[request.full_url])

    assert sample.fetch_sample(spark, str(tmp_path), 2, 4, 1, opener, base) == 5
    lines = (tmp_path / "metadata.csv").read_text().splitlines()
    assert lines[0] == "file,camera_id,timestamp" and "location_46/a1.jpg,46,2013-10-04 13:31:53" in lines and not any("evil" in x for x in lines)
    assert (tmp_path / "location_7" / "b3.jpg").read_bytes() == b"jpeg" and "LILA" in (tmp_path / "ATTRIBUTION.txt").read_text()
    before = len(calls)
    sample.fetch_sample(spark, str(tmp_path), 2, 4, 1, opener, base)
    assert calls[before:] == [base[1] + "b1.jpg"]
    for bad in ("http://example.org/x", "file:///etc/passwd"):
        with pytest.raises(InputError):
            sample.https_only(bad)
    with pytest.raises(InputError):
        sample.fetched(base[0], tmp_path / "new", 3, opener)
    chosen = sample.choose(tables.parse_metadata(spark, str(tmp_path / ".cache" / "meta.json")), 2, 2, 3).collect()
    assert {r.camera_id for r in chosen} == {"46", "7"} and "b3.jpg" in {r.file_name for r in chosen}


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = [0.78125, 1.6937499999999999, 0.25, 2.5, -0.125, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(scalars.rounded(F.col("v"), 4)).collect()]
    assert got == [None if v is None else float(np.round(v, 4)) for v in values] and got[:2] == [0.7812, 1.6938]


def test_tables_survive_and_lines_are_mended(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    assert tables.write_table(spark.read.parquet(path).filter("id > 0"), path).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]
    torn = tmp_path / "r.jsonl"
    torn.write_text('{"k":"a","v":1}\n[1]\n{"v":3}\n{"k":"b","v":2}\n{"k":"c"')
    assert tables.mended_json_records(spark, str(torn), "k", "k string, v long") == 3
    assert torn.read_text() == '{"k":"a","v":1}\n{"k":"b","v":2}\n' and tables.mended_json_records(spark, str(torn), "k", "k string, v long") == 0
    told = spark.createDataFrame([("a,b", 'say "x"', None)], "x string, y string, z long")
    tables.write_csv(told, f"file://{tmp_path}/x.csv")
    assert (tmp_path / "x.csv").read_text() == 'x,y,z\n"a,b","say ""x""",\n'


def with_exif(orientation: int, order: str = "<", big: bool = False) -> bytes:
    """A TIFF header with a make, a time and an orientation."""
    make, time = b"Maker of cameras\0", b"2026:04:06 06:30:00\0"
    head, entry, room = (16, 20, 8) if big else (8, 12, 4)
    data = head + (8 if big else 2) + 3 * entry + (8 if big else 4)
    n, wide = ("Q", "Q") if big else ("H", "I")
    out = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, 16) if big else struct.pack(order + "HI", 42, 8))
    out += struct.pack(order + n, 3)
    out += struct.pack(order + "HH" + wide + wide, 0x010F, 2, len(make), data)
    out += struct.pack(order + "HH" + wide, 0x0112, 3, 1) + struct.pack(order + "H", orientation).ljust(room, b"\0")
    out += struct.pack(order + "HH" + wide + wide, 0x0132, 2, len(time), data + len(make))
    return out + struct.pack(order + wide, 0) + make + time


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("big", [False, True])
def test_tiff_directories(order, big):
    h = images.read_header(with_exif(6, order, big))
    assert (h.make.strip("\0"), h.date_time.strip("\0"), h.orientation) == ("Maker of cameras", "2026:04:06 06:30:00", 6)
    with pytest.raises(ValueError):
        images.read_header(with_exif(6, order, big)[:-25])


def test_exif_of_png_before_and_behind_the_pixels(tmp_path):
    plain = png(np.zeros((300, 300, 3), np.uint8))
    chunk = struct.pack(">I", len(with_exif(3))) + b"eXIf" + with_exif(3) + struct.pack(">I", zlib.crc32(b"eXIf" + with_exif(3)))
    noise = png(np.random.default_rng(1).integers(0, 255, (300, 300, 3), np.uint8))  # longer than the first look
    for k, data in enumerate((plain[:33] + chunk + plain[33:], plain[:-12] + chunk + plain[-12:], noise[:-12] + chunk + noise[-12:])):
        (tmp_path / f"{k}.png").write_bytes(data)
        with images._opened(str(tmp_path))[0].open_input_file(f"{tmp_path}/{k}.png") as file:
            h = images.header_of(file)
        assert (h.width, h.height, h.orientation, h.make.strip("\0")) == (300, 300, 3, "Maker of cameras")


def test_markers_of_jpeg_with_fill_bytes():
    data = exif_jpeg("2026:04:06 06:30:00")
    filled = data[:2] + b"\xff\xff" + data[2:].replace(b"\xff\xc0", b"\xff\xff\xff\xc0")
    h = images.read_header(filled)
    assert (h.width, h.height, h.date_time.strip("\0")) == (64, 48, "2026:04:06 06:30:00")
    with pytest.raises(ValueError):
        images.read_header(b"\xff\xd8\xff\xda\0\x04abcd")


def figures(spark, root, names):
    return images.measured_images(spark, str(root), names, lambda rgb: pixels.measure(rgb, Settings()), pixels.METRICS)


def test_photos_are_turned_before_they_are_measured(spark, tmp_path):
    ramp = np.repeat(np.arange(48, dtype=np.uint8)[None, :, None] * 5, 32, axis=0).repeat(3, axis=2)
    chunk = struct.pack(">I", len(with_exif(3))) + b"eXIf" + with_exif(3) + struct.pack(">I", zlib.crc32(b"eXIf" + with_exif(3)))
    turned = png(ramp[::-1, ::-1])
    (tmp_path / "c").mkdir()
    for name, data in {"plain": png(ramp), "a [b] {c}": png(ramp), "tür%20 x": png(ramp), "turned": turned[:33] + chunk + turned[33:], "_under": png(ramp), "cut": b"\x89PNG"}.items():
        (tmp_path / "c" / f"{name}.png").write_bytes(data)
    told = {r.rel_path: r for r in figures(spark, tmp_path, sorted(f"c/{p.name}" for p in (tmp_path / "c").iterdir())).collect()}
    assert len(told) == 6 and told.pop("c/cut.png").error == "unreadable"
    assert len({r.dhash for r in told.values()}) == 1 and all(r.error is None for r in told.values())
    assert images.HEADS[0] < images.HEADS[1]


def test_only_pending_photos_are_decoded(spark, survey, tmp_path, monkeypatch):
    root, truth = survey
    plans = []
    append = tables.RecordStore.append

    def watched(self, records):
        plans.append((records._jdf.queryExecution().toString(), records.count()))
        append(self, records)

    monkeypatch.setattr(tables.RecordStore, "append", watched)
    store = tables.RecordStore(spark, f"file://{tmp_path}/records", "photo_id", METRICS)
    look = lambda: stages.run_quality(spark, stages.ingest(spark, str(root)), str(root), store, Settings())
    look()
    assert [n for _, n in plans] == [6]
    (root / "cam_01" / "late.png").write_bytes(png(np.full((8, 8, 3), 7, np.uint8)))
    plans.clear()
    table = look()
    assert [n for _, n in plans] == [1]  # one new photo, one decoded
    assert all("Exchange" not in plan and "Join" not in plan for plan, _ in plans)  # so no pixels move
    assert table.filter("decode_ok").count() == 7
