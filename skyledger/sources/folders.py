"""File system calls of the driver on the folders of a store: names only, no content of tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: So many folders are moved at once.
MOVERS = 16


class Folders:
    """Paths are relative to ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._base = self._files.makeQualified(self._path(self.root)).toString()

    def _at(self, path: str):
        return self._path(f"{self.root}/{path}")

    def _relative(self, status) -> str:
        return status.getPath().toString().removeprefix(self._base).lstrip("/")

    def exists(self, path: str) -> bool:
        return self._files.exists(self._at(path))

    def glob(self, pattern: str) -> list[str]:
        return [self._relative(s) for s in self._files.globStatus(self._at(pattern)) or []]

    def children(self, path: str) -> list[str]:
        return [self._relative(s) for s in self._files.listStatus(self._at(path))] if self.exists(path) else []

    def make(self, path: str) -> None:
        self._files.mkdirs(self._at(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._at(path), True)

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._at(target).getParent())
        if not self._files.rename(self._at(source), self._at(target)):
            raise OSError(f"{self.root}/{source} cannot be moved to {target}")

    def put_in_place(self, source: str, target: str, depth: int) -> None:
        """Move the folders ``depth`` levels below ``source`` to the same places below ``target``, where they replace those there are.

        A folder that is new on its level is moved whole, with all below it; the others are dealt over threads.
        """
        self.make(target)

        def step(place: tuple[str, str, int]) -> list[tuple[str, str, int]]:
            old, new, levels = place
            there, below = {path.rsplit("/", 1)[1] for path in self.children(new)}, []
            for name in (path.rsplit("/", 1)[1] for path in self.children(old)):
                if "=" not in name:
                    continue  # the mark of a finished write
                if name in there and levels > 1:
                    below.append((f"{old}/{name}", f"{new}/{name}", levels - 1))
                    continue
                if name in there:
                    self.delete(f"{new}/{name}")
                if not self._files.rename(self._at(f"{old}/{name}"), self._at(f"{new}/{name}")):
                    raise OSError(f"{self.root}/{old}/{name} cannot be moved to {new}")
            return below

        places = [(source, target, depth)]
        with ThreadPoolExecutor(MOVERS) as pool:
            while places:
                places = [place for found in pool.map(step, places) for place in found]

    def copy(self, source: str, target: str) -> None:
        """Copy a file to the path ``target``, which appears when it is whole."""
        part = self._path(f"{target}.part")
        conf = self._files.getConf()
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._files, self._at(source), self._files, part, False, conf)
        self._files.rename(part, self._path(target))

    def write_lines(self, path: str, lines: list[str]) -> None:
        """Write a small file; it appears under its name only when it is whole."""
        part = self._at(f"{path}.part")
        out = self._files.create(part, True)
        try:
            out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
        finally:
            out.close()
        self.move(f"{path}.part", path)

    def read_lines(self, path: str) -> list[str]:
        source = self._files.open(self._at(path))
        try:
            data = self._jvm.org.apache.commons.io.IOUtils.toByteArray(source)
        finally:
            source.close()
        return bytes(data).decode().splitlines()
