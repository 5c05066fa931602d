"""A document store behind Spark's Python data source interface: partitioned reads, writes that commit or leave nothing.

The store is a folder in any file system that Arrow reaches (``file://``, ``hdfs://``, ``s3://``, ...): segments, which
are Parquet files written one per task, and commits, small JSON files that name the segments of one write. Only what a
commit names is part of the store, so a write shows whole or not at all; a failed write deletes its segments, and a
commit deletes those that retried or speculative tasks of its write have left. The folder of a write's segments is made
before its tasks begin, and no task makes it anew: one that runs on after its write has failed finds it gone and stops.

A read has one partition per segment. A commit knows the values that each segment holds in the store's ``by`` column
(``collection_date`` unless told otherwise), so a read that asks for one value skips the other segments before they are
opened. It asks by an option, not by a pushed filter: this Spark keeps the pushed state of a Python source with the
relation, where another query on the same frame would find it.
Documents keep the number of their commit in ``_sequence``: of several with one key, the greatest is the stored one
(:func:`current_documents`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators.silver import newest_per_key
from voxlake.sinks.upsert import DOCUMENT_KEY, with_text_keys

FORMAT = "voxlake_documents"
SEQUENCE = "_sequence"
#: Distinct values of the ``by`` column that a commit lists for a segment; a segment with more is never skipped.
LISTED = 200


def document_source() -> type:
    """The data source class; made in a function, so that it travels to workers that do not have this library."""
    import json
    import time
    import uuid
    from dataclasses import dataclass

    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

    name, sequence, listed = FORMAT, SEQUENCE, LISTED

    def opened(options) -> tuple[fs.FileSystem, str]:
        path = options["path"]
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))

    def commits(store: fs.FileSystem, root: str) -> list[dict]:
        found = store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
        names = sorted(f.path for f in found if f.base_name.endswith(".json"))
        out = []
        for path in names:
            with store.open_input_stream(path) as stream:
                out.append(json.loads(stream.read()))
        return out

    class Segment(InputPartition):
        def __init__(self, path: str, number: int):
            self.path, self.number = path, number

    @dataclass
    class Written(WriterCommitMessage):
        path: str | None
        rows: int
        values: list | None

    class Reader(DataSourceReader):
        def __init__(self, options, schema):
            self.options, self.schema, self.wanted = dict(options), schema, options.get("only")

        def partitions(self):
            store, root = opened(self.options)
            out = []
            for commit in commits(store, root):
                for segment in commit["segments"]:
                    if self.wanted is None or segment["values"] is None or self.wanted in segment["values"]:
                        out.append(Segment(f"{root}/{segment['path']}", commit["number"]))
            return out or [Segment("", 0)]

        def read(self, partition):
            if not partition.path:
                return
            from pyspark.sql.pandas.types import to_arrow_schema

            store, _ = opened(self.options)
            target = to_arrow_schema(self.schema)
            with store.open_input_file(partition.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(8192):
                    columns = []
                    for field in target:
                        if field.name == sequence:
                            columns.append(pa.array([partition.number] * len(batch), pa.int64()))
                        elif field.name in batch.schema.names:
                            columns.append(batch.column(field.name).cast(field.type))
                        else:
                            columns.append(pa.nulls(len(batch), field.type))
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    class Writer(DataSourceArrowWriter):
        def __init__(self, options):
            self.options, self.job = dict(options), uuid.uuid4().hex

        def begin(self):
            store, root = opened(self.options)
            store.create_dir(f"{root}/segments/{self.job}", recursive=True)
            return self

        def write(self, iterator):
            store, root = opened(self.options)
            by = self.options.get("by", "collection_date")
            path, rows, values, out, sink = f"segments/{self.job}/{uuid.uuid4().hex}.parquet", 0, set(), None, None
            for batch in iterator:
                if not len(batch):
                    continue
                if out is None:
                    if store.get_file_info(f"{root}/segments/{self.job}").type == fs.FileType.NotFound:
                        raise RuntimeError("the write has been given up")
                    sink = store.open_output_stream(f"{root}/{path}")
                    out = pq.ParquetWriter(sink, batch.schema)
                out.write_batch(batch)
                rows += len(batch)
                if by in batch.schema.names and values is not None:
                    values |= {str(v) for v in pc.unique(batch.column(by)).to_pylist()}
                    values = values if len(values) <= listed else None
                elif by not in batch.schema.names:
                    values = None
            if out is None:
                return Written(None, 0, None)
            out.close()
            sink.close()
            return Written(path, rows, None if values is None else sorted(values))

        def commit(self, messages):
            store, root = opened(self.options)
            kept = [m for m in messages if m is not None and m.path]
            named = {f"{root}/{m.path}" for m in kept}
            for file in store.get_file_info(fs.FileSelector(f"{root}/segments/{self.job}", allow_not_found=True)):
                if file.path not in named:
                    store.delete_file(file.path)
            if not kept:
                self.abort(messages)
            before = commits(store, root)
            number = 1 + max((c["number"] for c in before), default=0)
            body = {"number": number, "at": time.time(), "segments": [{"path": m.path, "rows": m.rows, "values": m.values} for m in kept]}
            store.create_dir(f"{root}/commits", recursive=True)
            # Written aside and moved, so that no reader sees a part of it.
            with store.open_output_stream(f"{root}/commits/{self.job}.tmp") as stream:
                stream.write(json.dumps(body).encode())
            store.move(f"{root}/commits/{self.job}.tmp", f"{root}/commits/{number:012d}-{self.job}.json")

        def abort(self, messages):
            store, root = opened(self.options)
            if store.get_file_info(f"{root}/segments/{self.job}").type != fs.FileType.NotFound:
                store.delete_dir(f"{root}/segments/{self.job}")

    class Documents(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            from pyspark.sql.pandas.types import from_arrow_schema
            from pyspark.sql.types import LongType, StructType

            store, root = opened(self.options)
            fields = {}
            for commit in commits(store, root):
                for segment in commit["segments"][:1]:
                    with store.open_input_file(f"{root}/{segment['path']}") as file:
                        for field in from_arrow_schema(pq.read_schema(file)):
                            fields.setdefault(field.name, field)
            out = StructType(list(fields.values()))
            return out.add(sequence, LongType())

        def reader(self, schema):
            return Reader(self.options, schema)

        def writer(self, schema, overwrite):
            if overwrite:
                raise ValueError("a document store is added to; delete its folder to begin anew")
            return Writer(self.options).begin()

    return Documents


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(document_source())


def write_documents(documents: DataFrame, path: str, by: str = "collection_date") -> None:
    """Add documents to the store in one commit."""
    register(documents.sparkSession)
    documents.write.format(FORMAT).option("path", path).option("by", by).mode("append").save()


def read_documents(spark: SparkSession, path: str, by: str = "collection_date", only: str | None = None) -> DataFrame:
    """All documents that were ever written, or those with one value of ``by``, with the number of their commit."""
    register(spark)
    reader = spark.read.format(FORMAT).option("path", path).option("by", by)
    if only is None:
        return reader.load()
    return reader.option("only", only).load().filter(F.col(by).cast("string") == only)


def current_documents(spark: SparkSession, path: str, keys: Sequence[str] = DOCUMENT_KEY, by: str = "collection_date") -> DataFrame:
    """The stored document of every key: the one of the last commit that has it."""
    every = with_text_keys(read_documents(spark, path, by), keys)
    return newest_per_key(every, keys, [F.col(SEQUENCE).desc()]).drop(SEQUENCE)
