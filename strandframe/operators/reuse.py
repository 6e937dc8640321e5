"""Reuse of finished results.

A result is known by a digest of its name, its input files (paths, sizes, times), its parameters and this package's code.
Its tables are written below a folder of the attempt, then, last, a manifest that names them. Readers go by manifests
alone: an attempt that broke off, or is still writing, has none. All files are listed, read and written by Spark.
"""

from __future__ import annotations

import functools
import hashlib
import json
import time
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]


@functools.cache
def code_version() -> str:
    """sha256 of this package's source, without the subpackage llm."""
    root, out = Path(__file__).resolve().parent.parent, hashlib.sha256()
    for path in sorted(root.rglob("*.py")):
        name = path.relative_to(root).as_posix()
        if not name.startswith("llm/"):
            out.update(name.encode() + b"\0" + path.read_bytes() + b"\0")
    return out.hexdigest()


def listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length, modified) of the files at or below the paths; their content isn't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def input_digest(spark: SparkSession, paths: str | list[str]) -> str:
    """What tells one state of the files from another: their number and two sums of hashes, however many there are."""
    files = listing(spark, paths)
    sums = [F.sum(F.xxhash64(F.lit(seed), "path", "length", "modified").cast("decimal(38,0)")) for seed in (1, 2)]
    return ":".join(str(x) for x in files.agg(F.count("*"), *sums).first())


class ResultStore:
    """Results below one folder."""

    def __init__(self, spark: SparkSession, folder: str, version: str | None = None) -> None:
        self.spark, self.folder, self.version = spark, folder.rstrip("/"), version or code_version()

    def key(self, name: str, inputs: list[str], params: dict[str, Any]) -> str:
        """The digest of a result. params: what json can write; their order doesn't matter."""
        parts = [name, input_digest(self.spark, inputs) if inputs else "", json.dumps(params, sort_keys=True), self.version]
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()

    def get(self, key: str) -> Tables | None:
        """The tables of the latest attempt that has a manifest; None if there is none."""
        try:
            found = [json.loads(r["value"]) for r in self.spark.read.text(f"{self.folder}/manifests/{key}/*").collect()]  # a line for each attempt
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if not found:
            return None
        last = max(found, key=lambda m: (m["made"], m["attempt"]))
        return {name: self.spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{self.folder}/data/{key}/{last['attempt']}/{name}") for name, schema in last["tables"].items()}

    def put(self, key: str, tables: Tables) -> Tables:
        """Write the tables, then their manifest; the tables as they are read back."""
        attempt = uuid.uuid4().hex
        for name, df in tables.items():
            df.write.parquet(f"{self.folder}/data/{key}/{attempt}/{name}")
        manifest = {"attempt": attempt, "made": time.time_ns(), "tables": {name: df.schema.jsonValue() for name, df in tables.items()}}
        self.spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{self.folder}/manifests/{key}/{attempt}")
        return self.get(key)

    def reuse(self, name: str, inputs: list[str], params: dict[str, Any], make: Callable[[], Tables], overwrite: bool = False) -> Tables:
        """The stored tables, or those that make() gives, once they are stored. overwrite: make them in any case."""
        key = self.key(name, inputs, params)
        return (None if overwrite else self.get(key)) or self.put(key, make())
