"""Small driver-side work on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def matching(self, pattern: str) -> list[str]:
        """Paths that a glob matches, in order."""
        fs, p = self._at(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])

    def names(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def modified(self, path: str) -> int:
        """Newest time of change of a file or of anything in a folder, in milliseconds."""
        fs, p = self._at(path)
        status = fs.getFileStatus(p)
        if not status.isDirectory():
            return status.getModificationTime()
        return max([status.getModificationTime(), *(s.getModificationTime() for s in fs.listStatus(p))])

    def listing(self, pattern: str) -> list[tuple[str, int, int]]:
        """Path, size and time of change of every file that a glob matches or that lies in a folder it matches, in
        order; hidden ones don't count."""
        fs, p = self._at(pattern)
        out = []
        for status in fs.globStatus(p) or []:
            found = fs.listFiles(status.getPath(), True)
            while found.hasNext():
                f = found.next()
                if not f.getPath().getName().startswith("."):
                    out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(out)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, a: str, b: str) -> None:
        fs, p = self._at(a)
        _, q = self._at(b)
        fs.mkdirs(q.getParent())
        if not fs.rename(p, q):
            raise OSError(f"{a} can't become {b}")

    def write_text(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def write_pieces(self, path: str, pieces: Iterator[str]) -> None:
        """Text piece by piece, some megabytes of it at a time."""
        fs, p = self._at(path)
        out, held, size = fs.create(p, True), [], 0
        try:
            for piece in pieces:
                held.append(piece)
                size += len(piece)
                if size > 1 << 20:
                    out.write("".join(held).encode())
                    held, size = [], 0
            out.write("".join(held).encode())
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def claim(self, path: str) -> bool:
        """Makes a file that must not exist yet; False where it does."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        return fs.createNewFile(p)
