"""Published tables of an output folder.

Every publication writes into a folder of its own and then adds a numbered manifest, which
names the current folder of each table, by one rename. A reader takes the highest manifest, so
it sees all tables of a publication or none of them; a publication that fails, or that
another one has overtaken, leaves what was there. A table may consist of parts, such as the
periods of the data, of which a publication replaces some.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ebbtide.sources.sinks import write_table
from ebbtide.sources.tables import read_parquet

MANIFESTS = "_manifests"


class Overtaken(RuntimeError):
    """Another publication came first."""


class Folder:
    """File operations on a path that any node can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.context = spark, spark.sparkContext
        self.hadoop = self.context._jvm.org.apache.hadoop.fs
        self.path = path
        self.system = self.at(path).getFileSystem(self.context._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.hadoop.Path(path)

    def names(self, path: str) -> list[str]:
        if not self.system.exists(self.at(path)):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self.at(path)))

    def read(self, path: str) -> str:
        return self.spark.read.text(path, wholetext=True).first()[0]

    def create(self, path: str, text: str) -> None:
        """Write a file under another name, then rename it; fails if it is there."""
        draft = self.at(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self.system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = self.hadoop.FileContext.getFileContext(draft.toUri(), self.context._jsc.hadoopConfiguration())
        options = self.context._gateway.new_array(self.context._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self.system.makeQualified(draft), self.system.makeQualified(self.at(path)), options)
        except Exception as error:
            self.system.delete(draft, False)
            raise Overtaken(path) from error

    def delete(self, path: str) -> None:
        self.system.delete(self.at(path), True)


@dataclass
class Draft:
    """A publication in the making."""

    store: Versions
    name: str
    tables: dict[str, str]

    @property
    def path(self) -> str:
        return f"{self.store.root}/{self.name}"

    def write(self, df: DataFrame, table: str, partition_by: str | None = None) -> None:
        write_table(df, f"{self.path}/{table}", partition_by)
        self.tables[table] = f"{self.name}/{table}"

    def write_parts(self, df: DataFrame, table: str, column: str, parts: list[int]) -> None:
        """Replace the given parts of a table by the rows of ``df``; a part without rows goes."""
        write_table(df, f"{self.path}/{table}", column)
        found = set(self.store.folder.names(f"{self.path}/{table}"))
        for part in parts:
            folder = f"{column}={part}"
            if folder in found:
                self.tables[f"{table}/{part}"] = f"{self.name}/{table}/{folder}"
            else:
                self.tables.pop(f"{table}/{part}", None)

    def read_parts(self, table: str, schema: StructType) -> DataFrame:
        """All parts of a table, those just written among them."""
        return self.store.read_parts(table, schema, self.tables)


class Versions:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.folder = Folder(spark, root)

    def _numbers(self) -> list[int]:
        names = self.folder.names(f"{self.root}/{MANIFESTS}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> dict[str, str]:
        return json.loads(self.folder.read(self._manifest_path(number))) if number else {}

    def _manifest_path(self, number: int) -> str:
        return f"{self.root}/{MANIFESTS}/{number:08d}.json"

    @property
    def current(self) -> dict[str, str]:
        """Folder of each table, or part of one, below the root."""
        return self._manifest(max(self._numbers(), default=0))

    def path(self, table: str) -> str:
        return f"{self.root}/{self.current[table]}"

    def read(self, *tables: str, current: dict[str, str] | None = None) -> list[DataFrame]:
        """Tables of one manifest, the last one unless given."""
        current = self.current if current is None else current
        return [read_parquet(self.spark, f"{self.root}/{current[table]}") for table in tables]

    def read_parts(self, table: str, schema: StructType, current: dict[str, str] | None = None) -> DataFrame:
        """All parts of a table of one manifest, the last one unless given."""
        current = self.current if current is None else current
        paths = [f"{self.root}/{path}" for name, path in sorted(current.items()) if name.startswith(f"{table}/")]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @contextmanager
    def publish(self) -> Iterator[Draft]:
        """A draft that becomes current when the block ends, and goes if it fails."""
        base = max(self._numbers(), default=0)
        draft = Draft(self, f"v-{base + 1:08d}-{uuid.uuid4().hex[:8]}", self._manifest(base))
        try:
            yield draft
            self.folder.create(self._manifest_path(base + 1), json.dumps(draft.tables, indent=1))
        except BaseException:
            self.folder.delete(draft.path)
            raise

    def prune(self, keep: int) -> None:
        """Delete what only manifests before the last ``keep`` name. Drafts in the making are
        in no manifest and stay."""
        numbers = self._numbers()
        old, new = numbers[:-keep], numbers[-keep:]
        needed = {path for number in new for path in self._manifest(number).values()}
        for number in old:
            gone = set(self._manifest(number).values()) - needed
            for path in gone:
                self.folder.delete(f"{self.root}/{path}")
            for version in {path.split("/")[0] for path in gone} - {path.split("/")[0] for path in needed}:
                self.folder.delete(f"{self.root}/{version}")
            self.folder.delete(self._manifest_path(number))
