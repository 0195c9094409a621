"""Landing files as real files: written one per document, and listed.

``write_documents`` writes each row's document to a file of its own,
``<root>/<source>/<endpoint>/<key>_<yyyymmdd>.json``, from the tasks: to a
temporary name first, then renamed, so a reader never sees half a file and a
task that runs again writes the same file again.

``LandingFiles`` is a data source (format ``landing_files``) that lists them.
The driver lists only the folders of sources and endpoints; each endpoint
folder is a partition and is listed in its task, which streams the names on,
so no process holds the list of all files. The options ``source`` and
``endpoint`` choose the folders before anything is listed.

Both reach what Arrow's file systems do (local, HDFS, S3, GCS); a landing zone
behind another scheme is listed by ``list_landing``, through Spark's file index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SUFFIX = ".json"
FILES_SCHEMA = "source string, endpoint string, file string, path string, bytes long"
#: Rows given on at once.
ROWS = 5000


def _files(root: str):
    """(file system, path) of a root given as a path or a URI."""
    from pyarrow import fs as arrow

    if "://" not in root and not root.startswith("file:"):
        return arrow.LocalFileSystem(), root.rstrip("/")
    system, path = arrow.FileSystem.from_uri(root.rstrip("/") if not root.startswith("file:/") or root.startswith("file://") else "file://" + root[5:].rstrip("/"))
    return system, path


def write_documents(documents: DataFrame, root: str) -> int:
    """(source, endpoint, key, batch_date, value) -> files; returns how many rows there were."""
    import pyarrow as pa

    def write(batches):
        system, base = _files(root)
        made, n = set(), 0
        for batch in batches:
            for source, endpoint, key, day, value in zip(*(c.to_pylist() for c in batch.columns)):
                folder = f"{base}/{source}/{endpoint}"
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                name = f"{folder}/{key}_{day}{SUFFIX}"
                with system.open_output_stream(f"{name}.tmp") as out:
                    out.write(value.encode())
                system.move(f"{name}.tmp", name)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    cols = documents.select("source", "endpoint", F.col("key").cast("string"), "batch_date", "value")
    return cols.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


class _Folder(InputPartition):
    def __init__(self, source: str, endpoint: str, path: str):
        self.source, self.endpoint, self.path = source, endpoint, path


class _Reader(DataSourceReader):
    def __init__(self, root: str, source: str | None, endpoint: str | None):
        self.root, self.only = root, {"source": source, "endpoint": endpoint}

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs as arrow

        system, base = _files(self.root)

        def folders(path: str, only: str | None) -> list[str]:
            if only is not None:
                info = system.get_file_info(f"{path}/{only}")
                return [only] if info.type == arrow.FileType.Directory else []
            return sorted(i.base_name for i in system.get_file_info(arrow.FileSelector(path, allow_not_found=True)) if i.type == arrow.FileType.Directory)

        return [_Folder(s, e, f"{base}/{s}/{e}") for s in folders(base, self.only.get("source")) for e in folders(f"{base}/{s}", self.only.get("endpoint"))]

    def read(self, partition: _Folder | None):
        import pyarrow as pa
        from pyarrow import fs as arrow

        if partition is None:  # what a zone without folders is read as
            return
        system, _ = _files(self.root)
        found = [i for i in system.get_file_info(arrow.FileSelector(partition.path, allow_not_found=True)) if i.type == arrow.FileType.File]
        for at in range(0, len(found), ROWS):
            part = found[at : at + ROWS]
            yield pa.RecordBatch.from_arrays([
                pa.array([partition.source] * len(part)), pa.array([partition.endpoint] * len(part)), pa.array([i.base_name for i in part]),
                pa.array([i.path for i in part]), pa.array([i.size for i in part], pa.int64())], ["source", "endpoint", "file", "path", "bytes"])


class LandingFiles(DataSource):
    """``spark.read.format("landing_files").load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "landing_files"

    def schema(self) -> str:
        return FILES_SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("source"), self.options.get("endpoint"))


def walk_landing(spark: SparkSession, root: str, source: str | None = None, endpoint: str | None = None) -> DataFrame:
    """(source, endpoint, file, path, bytes) of the files of a landing zone,
    or of one source or endpoint: other folders aren't listed."""
    spark.dataSource.register(LandingFiles)
    reader = spark.read.format("landing_files")
    for name, value in (("source", source), ("endpoint", endpoint)):
        reader = reader.option(name, value) if value is not None else reader
    return reader.load(root)


def list_landing(spark: SparkSession, root: str) -> DataFrame:
    """File paths under ``root`` by Spark's own file index, for any scheme
    Spark reads (metadata only: the content column is pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{SUFFIX}").load(root).select("path"))
