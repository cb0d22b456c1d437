"""Versions of stored state: small manifests that name the folders each version consists of."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifests:
    """Manifests below *path*; a version exists once its manifest does (written, then renamed)."""

    KEEP = 2

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join((self.path, *map(str, parts))))
        self.fs = self._at("manifests").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, *parts: str) -> list[str]:
        """Names in a folder (none if it is absent)."""
        folder = self._at(*parts)
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def versions(self) -> list[int]:
        return sorted(int(n[6:-5]) for n in self.names("manifests") if n.startswith("batch=") and n.endswith(".json"))

    def load(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest one before a batch; empty if there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return {}
        stream = self.fs.open(self._at("manifests", f"batch={found[-1]}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def save(self, version: int, manifest: dict) -> None:
        part = self._at("manifests", f".{uuid.uuid4().hex}")
        stream = self.fs.create(part, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self.fs.rename(part, self._at("manifests", f"batch={version}.json")):
            raise RuntimeError(f"manifest of batch {version} exists already")

    def prune(self, folders) -> None:
        """Drop all but the last manifests, and the folders that only dropped ones name."""
        versions = self.versions()
        old, kept = versions[: -self.KEEP], set()
        loaded = {v: self.load(v + 1) for v in versions}
        for version in versions[-self.KEEP :]:
            kept |= set(folders(loaded[version]))
        for version in old:
            for folder in set(folders(loaded[version])) - kept:
                self.fs.delete(self._at(folder), True)
            self.fs.delete(self._at("manifests", f"batch={version}.json"), False)
