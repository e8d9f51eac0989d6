"""Kept tables that change together: immutable files, a manifest per run, and one atomic switch.

A run writes new files first, then a manifest that names the files of every table, and becomes visible by
creating that manifest under the next version number. Creation fails if the number is taken
(compare-and-set), in which case the run starts again on the newer version. A run has a name of the
caller's choice; a name that is already in the history is not applied again. So a run that fails at any
step leaves nothing visible, and one that is repeated has its effect once.

Keyed tables are cut into buckets by the hash of their key. A run reads and writes the buckets that its
keys fall into; the others are named again by the new manifest and not touched.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


@dataclass(frozen=True)
class Keyed:
    """A table with one or more rows per key, kept in ``buckets`` parts."""

    schema: str
    key: tuple[str, ...]
    buckets: int = 64


@dataclass(frozen=True)
class Log:
    """A table that only grows, one folder per run that added rows."""

    schema: str


@dataclass
class Manifest:
    """A version: folders of each table, by bucket for keyed ones (``""`` for logs)."""

    version: int = 0
    run: str = ""
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)


@dataclass
class Replace:
    """New content of the ``touched`` buckets of a keyed table."""

    rows: DataFrame
    touched: list[int]


@dataclass
class Append:
    rows: DataFrame


Change = Replace | Append


class Store:
    """``tables`` below ``root``, which all executors share."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Keyed | Log]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)
        self._keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    # ---- versions -----------------------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(path)] if self._files.exists(path) else []

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:020d}.json"

    def head(self) -> Manifest:
        """The version in force; an empty one before the first run."""
        versions = [int(n[:-5]) for n in self._names(f"{self.root}/manifests") if n.endswith(".json") and n[:-5].isdigit()]
        return self.at(max(versions)) if versions else Manifest()

    def at(self, version: int) -> Manifest:
        line = self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0]
        return Manifest(**json.loads(line))

    def done(self, run: str) -> Manifest | None:
        """The version that ``run`` made, if it is in the history."""
        if not self._names(f"{self.root}/manifests"):
            return None
        lines = self.spark.read.text(f"{self.root}/manifests/*.json")
        found = lines.where(F.get_json_object("value", "$.run") == run).first()
        return Manifest(**json.loads(found[0])) if found else None

    def _publish(self, manifest: Manifest) -> bool:
        """Create the manifest unless its version exists. It is complete before it gets its name."""
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        out = self._files.create(self._path(draft), False)
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        out.close()
        self._files.mkdirs(self._path(f"{self.root}/manifests"))
        try:
            self._context.rename(self._path(draft), self._path(self._manifest_path(manifest.version)), self._keep)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    # ---- reading --------------------------------------------------------------------------------------

    def bucket(self, name: str) -> Column:
        spec = self.tables[name]
        return F.pmod(F.xxhash64(*spec.key), F.lit(spec.buckets)).cast("int")

    def touched(self, name: str, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into: at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self.bucket(name).alias("b")).distinct().collect())

    def read(self, name: str, manifest: Manifest | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table in a version (the one in force by default), or only some of its buckets."""
        manifest = self.head() if manifest is None else manifest
        parts = manifest.tables.get(name, {})
        wanted = parts if buckets is None else {str(b): parts.get(str(b), []) for b in buckets}
        folders = [f"{self.root}/{folder}" for listed in wanted.values() for folder in listed]
        schema = self.tables[name].schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- writing --------------------------------------------------------------------------------------

    def _write(self, name: str, change: Change, before: dict[str, list[str]]) -> dict[str, list[str]]:
        folder = f"data/{name}-{uuid.uuid4().hex}"
        columns = self.spark.createDataFrame([], self.tables[name].schema).columns
        rows = change.rows.select(*columns)
        if isinstance(change, Append):
            rows.write.parquet(f"{self.root}/{folder}")
            return {"": [*before.get("", []), folder]}
        # files of even size; a bucket with a large share of the rows gets several
        laid = rows.withColumn(BUCKET, self.bucket(name)).hint("rebalance", BUCKET)
        laid.write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        made = {n.removeprefix(f"{BUCKET}=") for n in self._names(f"{self.root}/{folder}") if n.startswith(f"{BUCKET}=")}
        stray = made - {str(b) for b in change.touched}
        if stray:
            raise ValueError(f"rows of {name} outside the touched buckets: {sorted(stray)[:5]}")
        kept = {b: listed for b, listed in before.items() if int(b) not in set(change.touched)}
        return kept | {b: [f"{folder}/{BUCKET}={b}"] for b in made}

    def run(self, run: str, build: Callable[[Manifest], dict[str, Change]]) -> Manifest:
        """Apply the changes that ``build`` makes of the version in force, once for this ``run``; all tables
        switch together. ``build`` is called again when another run was faster."""
        while True:
            made = self.done(run)
            if made is not None:
                return made
            base = self.head()
            changes = build(base)
            tables = dict(base.tables)
            for name, change in changes.items():
                tables[name] = self._write(name, change, base.tables.get(name, {}))
            after = Manifest(base.version + 1, run, tables)
            if self._publish(after):
                return after

    def load(self, run: str, **tables: DataFrame) -> Manifest:
        """Replace whole tables (logs get the rows added)."""

        def build(base: Manifest) -> dict[str, Change]:
            return {
                name: Append(rows) if isinstance(self.tables[name], Log) else Replace(rows, list(range(self.tables[name].buckets)))
                for name, rows in tables.items()
            }

        return self.run(run, build)
