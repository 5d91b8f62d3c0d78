"""Versioned split tables: ``<root>/<type>/version=<v>/revision=<n>/split=<s>/*.parquet``.

A version is a name such as ``v-1`` or ``v-downloaded``; writing it again adds a
revision. A writer first claims its revision by a marker file that only one can create, so two
writers never share one. A revision counts once its write has been committed (``_SUCCESS``), so a
job that died half-way is never read; its claim stays, and its number is not used again. Readers name the folders they want and
partition discovery fills in version, revision and split.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillwork.schemas import SPLITS
from quillwork.sources.counts import counted

_VERSION = re.compile(r"v-(\d+|downloaded)")


def version_name(version: int | str) -> str:
    """``v-<number>`` or ``v-downloaded``; anything else is refused."""
    name = str(version) if str(version).startswith("v-") else f"v-{version}"
    if not _VERSION.fullmatch(name):
        raise ValueError(f"version must be a number or 'downloaded', not {version!r}")
    return name


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.written: dict[tuple[str, str, int], dict[str, int]] = {}

    def _children(self, path: str, prefix: str) -> list[str]:
        """Values of ``prefix=<value>`` folders: one metadata listing, no data read."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(name[len(prefix) + 1 :] for name in names if name.startswith(prefix + "="))

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _folder(self, kind: str, version: str, revision: int) -> str:
        return f"{self.root}/{kind}/version={version}/revision={revision}"

    def versions(self, kind: str) -> list[str]:
        return [v for v in self._children(f"{self.root}/{kind}", "version") if self.latest(kind, v) is not None]

    def latest(self, kind: str, version: int | str) -> int | None:
        """Newest committed revision of a version, if there is one."""
        version = version_name(version)
        revisions = sorted(map(int, self._children(f"{self.root}/{kind}/version={version}", "revision")), reverse=True)
        for revision in revisions:
            if self._exists(f"{self._folder(kind, version, revision)}/_SUCCESS"):
                return revision
        return None

    def _claim(self, kind: str, version: str, revision: int) -> bool:
        """Create the marker of a revision; false if another writer did."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/version={version}")
        marker = jvm.org.apache.hadoop.fs.Path(folder, f"_claim={revision}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        try:
            if files.getUri().getScheme() == "file":  # there Hadoop looks first and creates afterwards
                jvm.java.nio.file.Files.createFile(jvm.java.io.File(marker.toUri().getPath()).toPath(), self.spark._sc._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            else:
                files.create(marker, False).close()
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def write(
        self, df: DataFrame, kind: str, version: int | str, revise: bool = False, rebalance: bool = False
    ) -> int:
        """Write all splits of ``df``; refuse to replace unless a revision is asked for.

        Of several writers at once that did not ask for a revision one goes on, the others are refused; those
        that did get a number each. The rows of each split are counted by the write itself, for ``written``.

        Every task writes one file per split it holds. ``rebalance`` shuffles once
        before, so that a stage of many small tasks ends in files of even size: the
        adaptive plan splits the large train split and merges the small ones.
        """
        version = version_name(version)
        last = self.latest(kind, version)
        if last is not None and not revise:
            raise FileExistsError(f"{kind} {version} already exists")
        base = f"{self.root}/{kind}/version={version}"
        taken = [int(r) for prefix in ("revision", "_claim") for r in self._children(base, prefix)]
        if taken and last is None and not revise:
            raise FileExistsError(f"{kind} {version} is being written or was left unfinished; ask for a revision")
        revision = max(taken, default=-1) + 1
        while not self._claim(kind, version, revision):
            if not revise:
                raise FileExistsError(f"{kind} {version} is being written")
            revision += 1
        out = df.drop("version", "revision")
        if rebalance:
            out = out.hint("rebalance", "split")
        out, counts = counted(out, "split", SPLITS)
        out.write.mode("errorifexists").partitionBy("split").parquet(self._folder(kind, version, revision))
        self.written[kind, version, revision] = counts.get
        return revision

    def counts(self, kind: str) -> DataFrame:
        """(version, revision, split, rows) of what this object wrote, counted by the writes; splits without rows left out."""
        rows = [(v, r, s, n) for (k, v, r), counts in self.written.items() if k == kind for s, n in counts.items() if n and s != "rows"]
        return self.spark.createDataFrame(rows, "version string, revision int, split string, rows long")

    def _read(self, kind: str, folders: list[str], schema: T.StructType) -> DataFrame:
        full = T.StructType(
            [
                *schema.fields,
                T.StructField("version", T.StringType()),
                T.StructField("revision", T.IntegerType()),
                T.StructField("split", T.StringType()),
            ]
        )
        if not folders:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/{kind}").parquet(*folders)

    def read(self, kind: str, version: int | str, schema: T.StructType) -> DataFrame:
        """The newest revision of one version."""
        version = version_name(version)
        revision = self.latest(kind, version)
        if revision is None:
            raise FileNotFoundError(f"no {kind} {version}")
        return self._read(kind, [self._folder(kind, version, revision)], schema)

    def read_all(self, kind: str, schema: T.StructType) -> DataFrame:
        """The newest revision of every version, in one scan.

        Versions may hold different columns; the schema names those that are kept
        (union by name). With no version at all the frame is empty, not an error.
        """
        newest = {v: self.latest(kind, v) for v in self._children(f"{self.root}/{kind}", "version")}
        folders = [self._folder(kind, v, revision) for v, revision in newest.items() if revision is not None]
        return self._read(kind, folders, schema)


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)
