"""Large JSON documents read by pieces: the elements of their top-level lists and maps, one at a time."""

from __future__ import annotations

import codecs
import re
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from wildtally.storage import cut, located

CHUNK = 4 << 20
#: A whole string, one that hasn't ended yet, or a mark of structure.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|"|[{}\[\],:]', re.DOTALL)
_CLOSES = {"{": "}", "[": "]"}


class MalformedJson(ValueError):
    pass


def elements(chunks: Iterable[bytes]) -> Iterator[tuple[str, str | None, str]]:
    """(member, key, text) of each element of the lists and maps that a JSON object holds at its top; key is null in a list.

    Memory holds one chunk and one element. What isn't an object, or doesn't end, is a MalformedJson.
    """
    decode = codecs.getincrementaldecoder("utf-8")().decode
    held, done = "", 0  # text that is still needed, and how far it is read
    open_: list[str] = []  # marks that close what is open
    member = key = None
    name = None  # the last string at the top or in a map, until a colon makes it a name
    start = None  # where the element begins in `held`
    ended = False
    chunks = iter(chunks)
    while True:
        chunk = next(chunks, None)
        held += decode(chunk or b"", chunk is None)
        at = done
        while match := _TOKEN.search(held, at):
            mark = match[0]
            if mark == '"':  # goes on in the next chunk
                break
            if ended or (not open_ and (mark != "{" or held[at : match.start()].strip())):
                raise MalformedJson("not one JSON object")
            at, depth = match.end(), len(open_)
            if mark in "{[":
                if depth == 2 and start is None:
                    start = match.start()
                open_.append(_CLOSES[mark])
            elif mark in "}]":
                if open_.pop() != mark:
                    raise MalformedJson("brackets don't match")
                if depth == 2:  # the list or map ends, and its last element, if it has one
                    if start is not None and (text := held[start : match.start()].strip()):
                        yield member, key, text
                    start = key = None
                ended = not open_
            elif mark == "," and depth == 2:
                if start is not None:
                    yield member, key, held[start : match.start()].strip()
                start = key = None
            elif mark == ":" and depth == 1:
                member = name
            elif mark == ":" and depth == 2 and open_[1] == "}" and key is None:
                key, start = name, match.end()
            elif mark[0] == '"':
                if depth == 1 or (depth == 2 and open_[1] == "}" and key is None):
                    name = _unquoted(mark)
                elif depth == 2 and start is None:
                    start = match.start()
            if len(open_) == 2 and open_[1] == "]" and start is None and mark in "[,":
                start = at
        if not open_ and not ended and held[at:].strip() and not _TOKEN.search(held, at):
            raise MalformedJson("not one JSON object")
        keep = at if start is None else start
        held, done = held[keep:], at - keep
        start = None if start is None else 0
        if chunk is None:
            if open_ or not ended or held.strip():
                raise MalformedJson("the document doesn't end")
            return


def _unquoted(text: str) -> str:
    import json

    return json.loads(text, strict=False)


def _chunks(store: pafs.FileSystem, path: str) -> Iterator[bytes]:
    """A file's bytes; of a zip those of its first JSON."""
    with store.open_input_file(path) as file:
        if not path.lower().endswith(".zip"):
            while data := file.read(CHUNK):
                yield data
            return
        with zipfile.ZipFile(file) as archive:
            name = next((n for n in archive.namelist() if n.lower().endswith(".json")), None)
            if name is None:
                raise MalformedJson("the zip holds no JSON")
            with archive.open(name) as inside:
                while data := inside.read(CHUNK):
                    yield data


def _files(store: pafs.FileSystem, path: str) -> list[str]:
    info = store.get_file_info(path)
    if info.type != pafs.FileType.Directory:
        return [path]
    found = store.get_file_info(pafs.FileSelector(path))
    return sorted(f.path for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._" and f.size)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """member, key, value (JSON text) of the elements of a JSON document, or a folder of such, and error of a document that is malformed.

    A document is read by one task as a stream, whose memory holds a chunk and an element; elements are written as a
    table, so all that follows works on them in many tasks.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                store, top = pafs.FileSystem.from_uri(uri)
                for file in _files(store, top):
                    held, size = [], 0
                    frame = lambda rows: pd.DataFrame(rows, columns=["member", "key", "value", "error"], dtype=object)
                    try:
                        for member, key, text in elements(_chunks(store, file)):
                            held.append((member, key, text, None))
                            size += len(text)
                            if len(held) >= 10_000 or size >= CHUNK:
                                yield frame(held)
                                held, size = [], 0
                    except (MalformedJson, UnicodeDecodeError, zipfile.BadZipFile) as problem:
                        held.append((None, None, None, str(problem)))
                    if held:
                        yield frame(held)

    one = spark.createDataFrame([(located(path),)], "uri string").coalesce(1)
    return cut(one.mapInPandas(work, "member string, key string, value string, error string"))
