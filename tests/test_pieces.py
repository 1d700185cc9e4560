"""JSON read by pieces against the whole document."""

import json
import random
import resource
import zipfile

import pytest

from wildtally.errors import InputError
from wildtally.sources import pieces, tables


def random_value(pick, depth):
    kind = pick.randrange(8 if depth else 5)
    if kind < 5:
        return [pick.randrange(99), None, True, pick.choice(['a "b" \\', "}{][,:", "é😀\n", "", "x" * 50]), -1.5][kind]
    if kind == 5:
        return [random_value(pick, depth - 1) for _ in range(pick.randrange(4))]
    return {pick.choice(["k", "a:b", 'q"', "é", "images"]) + str(k): random_value(pick, depth - 1) for k in range(pick.randrange(4))}


def cut_up(data, size):
    return [data[at : at + size] for at in range(0, len(data), size)]


@pytest.mark.parametrize("size", [1, 7, 64, 100_000])
def test_elements_are_those_of_the_document(size):
    pick = random.Random(size)
    for _ in range(60):
        document = {f"m{k}": random_value(pick, 4) for k in range(pick.randrange(5))}
        text = json.dumps(document, ensure_ascii=pick.random() < 0.5, indent=pick.choice([None, 1]))
        told = [(m, k, json.loads(v)) for m, k, v in pieces.elements(cut_up(text.encode(), size))]
        want = [(m, None, x) for m, v in document.items() if isinstance(v, list) for x in v] + [(m, k, x) for m, v in document.items() if isinstance(v, dict) for k, x in v.items()]
        assert sorted(told, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("text", ["", "  ", "not json", "[1, 2]", '{"a": [1, 2', '{"a": [1}', '{"a": "b', '{"a": 1} {"b": 2}', '"text"', "{} x"])
def test_what_is_malformed(text):
    with pytest.raises(pieces.MalformedJson):
        list(pieces.elements(cut_up(text.encode(), 3)))


def test_memory_stays_with_one_chunk():
    element = '{"file_name": "%d.jpg", "location": "a", "datetime": "2026", "text": "' + "y" * 900 + '"},'

    def chunks():
        yield b'{"images": ['
        for k in range(150_000):  # 140 MB
            yield (element % k).encode()
        yield b'{"file_name": "end.jpg"}]}'

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(1 for _ in pieces.elements(chunks()))
    assert n == 150_001
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 40_000  # kB


def test_survey_in_a_zip_and_a_truth(spark, tmp_path):
    survey = {"info": {"year": 2026}, "images": [{"file_name": f"{k}.jpg", "location": k % 3, "datetime": "2026", "id": k} for k in range(500)], "annotations": []}
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as archive:
        archive.writestr("inner/meta.json", json.dumps(survey))
    rows = tables.parse_metadata(spark, str(tmp_path / "s.zip"))
    assert sorted((r.file_name, r.camera_id) for r in rows.collect()) == sorted((f"{k}.jpg", str(k % 3)) for k in range(500))
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as archive:
        archive.writestr("a.txt", "x")
    with pytest.raises(InputError):
        tables.parse_metadata(spark, str(tmp_path / "none.zip"))
    (tmp_path / "t.json").write_text(json.dumps({"images": {"a/é.jpg": {"kind": "empty", "visit_id": 3, "objects": []}}, "visits": [{"visit_id": 3}], "cameras": []}))
    truth = tables.load_ground_truth(spark, f"file://{tmp_path}/t.json")
    assert [(r.rel_path, r.kind, r.visit_id) for r in truth["images"].collect()] == [("a/é.jpg", "empty", 3)]
    assert truth["visits"].first().visit_id == 3 and truth["cameras"].count() == 0
