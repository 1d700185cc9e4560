"""Photo folders: finding images, reading their headers, measuring their pixels."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from wildtally.functions.pixels import oriented, to_rgb
from wildtally.storage import fresh_path

EXTENSIONS = ("jpg", "jpeg", "png", "tif", "tiff")
#: TIFF tags (fixed values).
MAKE, MODEL, ORIENTATION, DATE_TIME, EXIF_IFD, ORIGINAL, SERIAL, WIDTH, HEIGHT = 0x010F, 0x0110, 0x0112, 0x0132, 0x8769, 0x9003, 0xA431, 0x0100, 0x0101


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if "://" in root else f"file://{root}")


def listed(root: str, folder: str = "", recursive: bool = True) -> tuple[list[str], list[str]]:
    """Paths of image files under a folder of `root`, and of its folders; no part of a path begins with a dot. Names with a leading _ count."""
    store, base = _opened(root)
    files, folders = [], []
    for info in store.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=recursive)):
        path = info.path[len(base) :].lstrip("/")
        if any(p.startswith(".") for p in path.split("/")):
            continue
        if info.type == pafs.FileType.Directory:
            folders.append(path)
        elif info.type == pafs.FileType.File and path.rpartition(".")[2].lower() in EXTENSIONS:
            files.append(path)
    return files, folders


def find_images(root: str) -> list[str]:
    """Sorted relative paths of image files."""
    return sorted(listed(root)[0])


def image_paths(spark: SparkSession, root: str) -> DataFrame:
    """rel_path of each image. The driver lists the uppermost folder; each folder in it, a camera's as a rule, is listed by a task."""
    files, folders = listed(root, recursive=False)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                yield pd.DataFrame({"rel_path": listed(root, folder)[0]}, dtype=object)

    top = spark.createDataFrame([(p,) for p in files], "rel_path string")
    if not folders:
        return top
    deeper = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), 1000), "folder")
    return top.unionByName(deeper.mapInPandas(work, "rel_path string"))


@dataclass
class Header:
    width: int | None = None
    height: int | None = None
    original: str | None = None
    date_time: str | None = None
    make: str | None = None
    model: str | None = None
    serial: str | None = None
    orientation: int = 1
    open: bool = False


#: Bytes of a value of each TIFF type (fixed values); 13 and 16 to 18 are those of BigTIFF.
TYPE_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
#: Codes of whole numbers by their bytes, as struct has them.
WHOLE = {1: "B", 2: "H", 4: "I", 8: "Q"}


def _tiff(data: bytes, header: Header) -> None:
    """Fills in a header from the directories of a TIFF or BigTIFF."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    at = lambda code, place: struct.unpack_from(order + code, data, place)[0]
    big = at("H", 2) == 43
    counts, wide, step = ("Q", "Q", 20) if big else ("H", "I", 12)  # number of entries; counts and offsets; bytes of an entry
    room, behind = (8, 8) if big else (4, 2)  # bytes of a value in its entry; where entries begin

    def entries(place: int) -> Iterator[tuple[int, bytes, int]]:
        for k in range(at(counts, place)):
            entry = place + behind + step * k
            tag, kind, count = at("H", entry), at("H", entry + 2), at(wide, entry + 4)
            size, own = TYPE_SIZES.get(kind, 1) * count, entry + step - room
            start = own if size <= room else at(wide, own)
            if start + size > len(data) and tag in READ:
                raise struct.error("a value lies behind the end")
            yield tag, data[start : start + size], kind

    def number(raw: bytes, kind: int) -> int:
        size = TYPE_SIZES.get(kind, 1)
        return struct.unpack(order + WHOLE[size], raw[:size])[0]

    todo, seen = [at("Q", 8) if big else at("I", 4)], set()
    texts = {MAKE: "make", MODEL: "model", DATE_TIME: "date_time", ORIGINAL: "original", SERIAL: "serial"}
    while todo:
        place = todo.pop()
        if place in seen:  # a directory that names itself
            continue
        seen.add(place)
        for tag, raw, kind in entries(place):
            if tag in texts:
                setattr(header, texts[tag], raw.decode("utf-8", "ignore"))
            elif tag == EXIF_IFD:
                todo.append(number(raw, kind))
            elif tag == ORIENTATION:
                header.orientation = number(raw, kind)
            elif tag in (WIDTH, HEIGHT):
                setattr(header, "width" if tag == WIDTH else "height", number(raw, kind))


READ = {MAKE, MODEL, DATE_TIME, ORIGINAL, SERIAL, EXIF_IFD, ORIENTATION, WIDTH, HEIGHT}


def _png(data: bytes, header: Header) -> None:
    """Size, and the EXIF of the eXIf chunk, which may stand before or behind the pixels."""
    at, size = 8, None
    while at + 8 <= len(data):
        (length,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        if kind == b"IHDR":
            size = struct.unpack_from(">II", data, at + 8)
        elif kind == b"eXIf":
            if at + 8 + length > len(data):
                raise struct.error("the chunk is cut")
            _tiff(data[at + 8 : at + 8 + length], header)
        elif kind == b"IEND":
            break
        at += 12 + length
    else:
        if at < 33:
            raise struct.error("no header chunk")
        header.open = True  # chunks go on behind what was read
    header.width, header.height = size


def _jpeg(data: bytes, header: Header) -> None:
    at, size = 2, None
    while size is None:
        if data[at] != 0xFF:
            raise ValueError("no marker where one has to be")
        while data[at + 1] == 0xFF:  # fill bytes before a marker
            at += 1
        marker = data[at + 1]
        if marker == 0x01 or 0xD0 <= marker <= 0xD7:  # these stand alone
            at += 2
            continue
        if marker in (0xD9, 0xDA):
            raise ValueError("no size before the pixels")
        (length,) = struct.unpack_from(">H", data, at + 2)
        if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            if at + 2 + length > len(data):
                raise struct.error("the segment is cut")
            _tiff(data[at + 10 : at + 2 + length], header)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            size = struct.unpack_from(">HH", data, at + 5)
        at += 2 + length
    header.height, header.width = size  # not that of a thumbnail


def read_header(data: bytes) -> Header:
    """Size and EXIF of a JPEG, PNG, TIFF or BigTIFF, without its pixels; ValueError if it is none of these or cut short.

    `open` is true of a PNG whose chunks go on behind `data`: EXIF may follow there.
    """
    header = Header()
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            _png(data, header)
        elif data[:2] in (b"II", b"MM"):
            _tiff(data, header)
        elif data[:2] == b"\xff\xd8":
            _jpeg(data, header)
        else:
            raise ValueError("unknown image format")
    except (struct.error, KeyError, IndexError) as error:
        raise ValueError("image header cut short") from error
    return header


#: Bytes read of a file to begin with, and then, if its header reaches further; after that all of it.
HEADS = (1 << 16, 1 << 20)


def header_of(file: pa.NativeFile) -> Header:
    """The header of an open file, of which no more is read than it needs."""
    size, found = file.size(), None
    for head in (*(h for h in HEADS if h < size), size):
        try:
            found = read_header(file.read_at(head, 0))
        except ValueError:
            if head == size:
                raise
            continue
        if not found.open:
            return found
    if found is None:
        raise ValueError("an empty file")
    return found


HEADERS = "rel_path string, width long, height long, file_bytes long, original string, date_time string, exif_make string, exif_model string, exif_serial string, orientation int, readable boolean, error string"


def read_headers(paths: DataFrame, root: str) -> DataFrame:
    """A row of HEADERS for each rel_path; files are opened by the tasks, and a failure is an error of its row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _opened(root)
        for batch in batches:
            rows = []
            for path in batch["rel_path"]:
                size, header, error = None, Header(), None
                try:
                    with store.open_input_file(f"{base}/{path}") as file:
                        size = file.size()
                        header = header_of(file)
                except (OSError, ValueError) as problem:
                    error = type(problem).__name__
                rows.append((path, header.width, header.height, size, header.original, header.date_time, header.make, header.model, header.serial, header.orientation, error is None, error))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in HEADERS.split(", ")], dtype=object)
            yield frame.astype({c: "Int64" for c in ("width", "height", "file_bytes", "orientation")})

    return paths.select("rel_path").mapInPandas(work, HEADERS)


def measured_images(spark: SparkSession, root: str, paths: list[str], measure: Callable[[np.ndarray], tuple], schema: str) -> DataFrame:
    """rel_path and the columns of `schema` for each of a list of images: what `measure` says of its pixels (RGB, turned
    as its EXIF says), and an error instead for one that can't be decoded.

    Only these files are read, each by the task that measures it. Pixels never leave that task: what goes on is a row of
    figures. `paths` are as many as the caller cares to hold at a time.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    known = _readable(spark, root, paths)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for origin, high, wide, channels, data in zip(*(batch[c] for c in ("origin", "height", "width", "nChannels", "data")), strict=True):
                path = unquote(origin.partition("://")[2] if "://" in origin else origin.removeprefix("file:"))
                name, folder = known[path]
                told = (*[None] * (len(names) - 1), "unreadable")
                if high > 0:
                    with _opened(folder)[0].open_input_file(path) as file:
                        turn = header_of(file).orientation
                    told = (*measure(oriented(to_rgb(data, int(high), int(wide), int(channels)), turn)), None)
                rows.append((name, *told))
            yield pd.DataFrame(rows, columns=["rel_path", *names])

    files = list(known)
    scheme = root.partition("://")[0] if "://" in root else "file"
    rows = spark.read.format("image").option("dropInvalid", False).load([f"{scheme}://{_escaped(f)}" for f in files])
    return rows.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(work, f"rel_path string, {schema}")


def _escaped(path: str) -> str:
    """A path in which the marks of a glob stand for themselves."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def _readable(spark: SparkSession, root: str, paths: list[str]) -> dict[str, tuple[str, str]]:
    """Where Spark finds each image: its rel_path and the folder that it lies in. It passes over names that begin with _, so tasks copy those files to the shared folder under other names."""
    base = _opened(root)[1].rstrip("/")
    hidden = [p for p in paths if p.rpartition("/")[2].startswith("_")]
    known = {f"{base}/{p}": (p, root) for p in paths if not p.rpartition("/")[2].startswith("_")}
    if not hidden:
        return known
    folder = fresh_path(spark, "images")
    names = [(p, f"copy{k}.{p.rpartition('.')[2]}") for k, p in enumerate(hidden)]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, top = _opened(root)
        target, copy = _opened(folder)
        target.create_dir(copy, recursive=True)
        for batch in batches:
            for path, name in zip(batch["path"], batch["name"], strict=True):
                pafs.copy_files(f"{top}/{path}", f"{copy}/{name}", source_filesystem=source, destination_filesystem=target)
            yield batch[["name"]]

    spark.createDataFrame(names, "path string, name string").repartition(min(len(names), 200)).mapInPandas(work, "name string").write.format("noop").mode("overwrite").save()
    copies = _opened(folder)[1].rstrip("/")
    return known | {f"{copies}/{name}": (path, folder) for path, name in names}
