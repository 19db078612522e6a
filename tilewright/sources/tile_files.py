"""Published tiles as files: <run>/<first six digits>/<tile>.json.gz, written and read record by record."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs

#: Digits of a folder's name.
PREFIX = 6
#: Characters that a reader takes from a tile at a time.
CHUNK = 1 << 18


@dataclass(frozen=True)
class Head:
    """What every tile says of itself."""

    collection: str
    source: str
    license: str
    generated_at: str
    repo: str

    def text(self) -> str:
        fields = {"collection": self.collection, "source": self.source, "license": self.license, "generated_at": self.generated_at}
        return json.dumps(fields, ensure_ascii=False, separators=(",", ":"))[:-1]


def canonical(data) -> str:
    return json.dumps(data, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def record_digest(record: dict) -> int:
    return int.from_bytes(hashlib.sha256(canonical(record).encode("utf-8", "surrogatepass")).digest()[:16])


def head_digest(head: dict) -> str:
    """Of all that a tile says besides its records and its time."""
    return hashlib.sha256(canonical({k: v for k, v in head.items() if k not in ("records", "generated_at")}).encode("utf-8", "surrogatepass")).hexdigest()[:32]


class Writer:
    """Writes tiles below a root, one open at a time, so no tile is ever held whole. The same records give the same
    bytes: a task that runs twice replaces its files by equal ones."""

    def __init__(self, root: str, head: Head):
        self.system, self.base = fs.FileSystem.from_uri(root)
        self.head, self.mark, self.at = head, uuid.uuid4().hex, None
        self.told = head_digest(json.loads(head.text() + "}"))

    def add(self, tile: str, value: str) -> tuple[str, int, str, str] | None:
        """Takes the next record; where it begins a new tile, gives what finish() gives of the one before."""
        done = None
        if tile != self.at:
            done = self.finish()
            self.at, self.n, self.sum = tile, 0, 0
            self.system.create_dir(f"{self.base}/{tile[:PREFIX]}", recursive=True)
            self.stream = self.system.open_output_stream(f"{self.base}/{tile[:PREFIX]}/.{tile}.{self.mark}", compression=None)
            self.out = gzip.GzipFile("", "wb", fileobj=self.stream, mtime=0)
            self.out.write(f'{self.head.text()},"records":['.encode())
        self.out.write((b"," if self.n else b"") + value.encode())
        self.n += 1
        self.sum = (self.sum + record_digest(json.loads(value))) % (1 << 128)
        return done

    def finish(self) -> tuple[str, int, str, str] | None:
        """Closes the open tile: its name, number of records, and the digests of head and records (in any order)."""
        if self.at is None:
            return None
        self.out.write(b"]}")
        self.out.close()
        self.stream.close()
        self.system.move(f"{self.base}/{self.at[:PREFIX]}/.{self.at}.{self.mark}", f"{self.base}/{self.at[:PREFIX]}/{self.at}.json.gz")
        done, self.at = (self.at, self.n, self.told, f"{self.sum:032x}"), None
        return done

    def drop(self) -> None:
        """Leaves nothing of the open tile."""
        if self.at is not None:
            self.stream.close()
            self.system.delete_file(f"{self.base}/{self.at[:PREFIX]}/.{self.at}.{self.mark}")
            self.at = None


def folders(root: str) -> list[str]:
    """Names of a run's folders of tiles: 4**6 + 4**5 + ... + 4 at most."""
    system, base = fs.FileSystem.from_uri(root)
    found = system.get_file_info(fs.FileSelector(base))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.strip("0123") == "" and len(f.base_name) <= PREFIX)


def tiles(root: str, folder: str) -> list[str]:
    """Names of the tiles in a folder."""
    system, base = fs.FileSystem.from_uri(root)
    found = system.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True))
    return sorted(f.base_name.removesuffix(".json.gz") for f in found if f.base_name.endswith(".json.gz") and not f.base_name.startswith("."))


def carry(before: str, root: str, folder: str) -> None:
    """The tiles of a folder of another run, as they are: the same files where both are local, else copies."""
    (old, a), (new, b) = fs.FileSystem.from_uri(before), fs.FileSystem.from_uri(root)
    new.create_dir(f"{b}/{folder}", recursive=True)
    for tile in tiles(before, folder):
        name = f"{folder}/{tile}.json.gz"
        if isinstance(old, fs.LocalFileSystem) and isinstance(new, fs.LocalFileSystem):
            mark = f"{b}/{folder}/.{tile}.{uuid.uuid4().hex}"
            os.link(f"{a}/{name}", mark)
            os.replace(mark, f"{b}/{name}")
        else:
            fs.copy_files(f"{a}/{name}", f"{b}/{name}", source_filesystem=old, destination_filesystem=new)


def read(root: str, tile: str) -> Iterator[tuple[dict, dict | None]]:
    """Head and record for each record of a tile, a part of the file at a time; once with None where it has none."""
    system, base = fs.FileSystem.from_uri(root)
    begin, decoder = '"records":[', json.JSONDecoder()
    with system.open_input_stream(f"{base}/{tile[:PREFIX]}/{tile}.json.gz", compression=None) as stream, gzip.GzipFile(fileobj=stream) as raw, io.TextIOWrapper(raw, "utf-8") as text:
        held = ""
        while begin not in held:
            more = text.read(CHUNK)
            if not more:
                raise ValueError(f"{tile} has no records")
            held += more
        front, _, held = held.partition(begin)
        head, at, n = json.loads(front.rstrip().removesuffix(",") + "}"), 0, 0
        while True:
            while at < len(held) and held[at] in ", \n\r\t":
                at += 1
            try:
                if at == len(held):
                    raise ValueError("more is needed")
                if held[at] == "]":
                    break
                record, at = decoder.raw_decode(held, at)
            except ValueError:
                more = text.read(CHUNK)
                if not more:
                    raise ValueError(f"{tile} is broken off") from None
                held, at = held[at:] + more, 0
                continue
            n += 1
            yield head, record
        if not n:
            yield head, None
