"""Layer tables, named ``layer.table``, in the catalog or under a folder.

A table is never overwritten in place. A write makes a new version beside the old one, checks
that all rows arrived, and then moves one pointer: a small file for folders, a view for
catalog tables. A reader sees the old version or the new one, whole, and a write that dies
leaves the old one as it was.
"""

import time
from collections.abc import Iterable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold", "quality")
#: Where a folder's readers look up its version.
POINTER = "_current"
#: Versions that stay after a write: the new one, and the one that readers may still be in.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class LayerStore:
    """Where layer tables live.

    With a ``root`` a table is the folder ``root/layer/table``; without one it is a
    catalog table, in a database per layer, whose name may have a prefix. Writing
    replaces the whole table.
    """

    spark: SparkSession
    root: str | None = None
    format: str = "parquet"
    prefix: str = ""

    def create_layers(self, layers: Iterable[str] = LAYERS) -> None:
        """Create the layer databases that are missing. Nothing is ever dropped."""
        if self.root is None:
            for layer in layers:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")

    def read(self, name: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(f"{self.prefix}{name}")
        version = self._version(name)
        if version is None:
            raise FileNotFoundError(f"no table {name} in {self.root}")
        return self._load(name, version)

    def write(self, df: DataFrame, name: str) -> None:
        """Replace the table. Raises, and changes nothing, unless all rows arrived."""
        version = f"v{time.time_ns():020d}_{uuid4().hex[:8]}"
        seen = Observation()
        writer = df.observe(seen, F.count("*").alias("rows")).write.format(self.format)
        if self.root is None:
            writer.saveAsTable(self._versioned(name, version))
        else:
            writer.save(f"{self._folder(name)}/{version}")
        arrived = self._load(name, version).count()
        if arrived != seen.get["rows"]:
            raise OSError(f"{name}: {arrived} of {seen.get['rows']} rows arrived")
        self._point(name, version)
        for old in sorted(self.versions(name))[:-KEPT_VERSIONS]:
            self._remove(name, old)

    def exists(self, name: str) -> bool:
        if self.root is None:
            return self.spark.catalog.tableExists(f"{self.prefix}{name}")
        return self._version(name) is not None

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows to a table, or make it. For small tables with one writer: the new version
        holds the old rows too, so that readers see all of an append or none of it."""
        self.write(self.read(name).unionByName(df) if self.exists(name) else df, name)

    def versions(self, name: str) -> list[str]:
        """The versions there are, of dead writes too."""
        if self.root is None:
            layer, table = name.split(".")
            listed = self.spark.sql(f"SHOW TABLES IN {self.prefix}{layer} LIKE '{table}__v*'")
            return [r.tableName.removeprefix(f"{table}__") for r in listed.collect()]
        fs, folder = self._files(self._folder(name))
        found = fs.listStatus(folder) if fs.exists(folder) else []
        return [s.getPath().getName() for s in found if s.isDirectory()]

    def _load(self, name: str, version: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(self._versioned(name, version))
        return self.spark.read.format(self.format).load(f"{self._folder(name)}/{version}")

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _versioned(self, name: str, version: str) -> str:
        return f"{self.prefix}{name}__{version}"

    def _files(self, path: str):
        """The file system of a path, and the path as it takes it."""
        context = self.spark.sparkContext
        found = context._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(context._jsc.hadoopConfiguration()), found

    def _version(self, name: str) -> str | None:
        fs, pointer = self._files(f"{self._folder(name)}/{POINTER}")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return stream.readLine()
        finally:
            stream.close()

    def _point(self, name: str, version: str) -> None:
        if self.root is None:
            view = f"CREATE OR REPLACE VIEW {self.prefix}{name} AS SELECT * FROM "
            self.spark.sql(view + self._versioned(name, version))
            return
        jvm = self.spark.sparkContext._jvm
        fs, aside = self._files(f"{self._folder(name)}/_{version}")
        stream = fs.create(aside, True)
        stream.writeBytes(version)
        stream.close()
        # One rename, which replaces the old pointer or leaves it.
        _, pointer = self._files(f"{self._folder(name)}/{POINTER}")
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            pointer.toUri() if pointer.toUri().getScheme() else fs.getUri(), fs.getConf()
        )
        context.rename(aside, pointer, options)

    def _remove(self, name: str, version: str) -> None:
        if self.root is None:
            self.spark.sql(f"DROP TABLE {self._versioned(name, version)}")
        else:
            fs, folder = self._files(f"{self._folder(name)}/{version}")
            fs.delete(folder, True)
