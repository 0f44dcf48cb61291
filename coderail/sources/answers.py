"""The answer store: paid answers by request, kept apart from every table that can be made again.

Layout: one Parquet table clustered by ``request_id``, a digest of the request key (hash of all that is sent, model,
temperature), into a fixed number of buckets.  A join on it therefore reads the store bucket by bucket where it lies; only the other side is
shuffled.  Rows are only ever added, never overwritten: a run that is started again under its own id, however it ended,
finds all it has paid for.  The bucket count is written beside the table when it is created and holds for good.

:class:`CallLog` holds answers that no job has committed yet.
"""

from __future__ import annotations

import hashlib
import io
import json
import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["prompt_hash", "model", "temperature"]
ROWS = "request_id string, prompt_hash string, model string, temperature double, attempts int, response string, error string, run_id string"
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


def with_request_id(requests: DataFrame) -> DataFrame:
    """``requests`` with the one column that stands for their key: joins on several columns, one of them a double, would not
    keep to a bucketing by one of them."""
    temperature = (F.col("temperature") + F.lit(0.0)).cast("string")  # no negative zero
    return requests.withColumn("request_id", F.sha2(F.concat_ws("\u0000", "prompt_hash", "model", temperature), 256))


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is no such path; any other failure is raised (an unreadable store
    must not look like an empty one, or every answer would be paid for again)."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


class AnswerStore:
    """Answers below ``path``, in ``buckets`` buckets (by default as many as shuffle partitions; of a store that exists:
    as many as it was created with)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}_layout"
        known = read_store(spark, layout)
        if known is None:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(layout)
            known = read_store(spark, layout)
        self.buckets = known.first()["buckets"]
        # A name in this session's catalog for the files below the path, which are all that lasts.
        self.name = "coderail_answers_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({ROWS}) USING parquet CLUSTERED BY (request_id) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        """All rows, failed attempts as well."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def answered(self) -> DataFrame:
        """request_id and response: one answer per key (the least where a key was answered twice)."""
        return self.table().where(F.col("error").isNull()).groupBy("request_id").agg(F.min("response").alias("response"))

    def without_answer(self, requests: DataFrame) -> DataFrame:
        """The requests (with ``request_id``) that have no stored answer.  The store is read in its buckets, not shuffled."""
        return requests.join(self.table().where(F.col("error").isNull()).select("request_id"), "request_id", "left_anti")

    def add(self, rows: DataFrame, run_id: str) -> None:
        """Adds rows (keys, attempts, response, error): one file per bucket."""
        rows = with_request_id(rows).withColumn("run_id", F.lit(run_id)).select(*COLUMNS)
        rows.repartition(self.buckets, "request_id").write.insertInto(self.name)

    def absorb(self, log: str, run_id: str) -> None:
        """Takes in the answers that killed jobs left in the call log, then drops the log."""
        left = CallLog.left(self.spark, log)
        if left is not None:
            self.add(self.without_answer(with_request_id(left)).withColumn("error", F.lit(None).cast("string")), run_id)
            CallLog.drop(log)


class CallLog:
    """Answers of a running job, durable one by one, below a shared folder.

    On a file system mounted by the workers each attempt at a task adds lines to a file of its own, written through with
    each answer; a last line that its writer could not finish does not count. Object stores and HDFS show a file when it is
    closed, so there each answer is a small file, written under a hidden name and renamed.  A task
    that is tried again first reads what its earlier attempts left under its partition's number and pays for none of it again; what a
    killed job leaves is taken in by the next run (:meth:`AnswerStore.absorb`).  The files of a job go once its answers
    are committed.  The folder is reached through ``pyarrow.fs`` (local, HDFS, S3, GCS).
    """

    FIELDS = "prompt_hash string, model string, temperature double, attempts int, response string"

    def __init__(self, path: str, partition: int):
        self.files, root = file_system(path)
        self.folder = f"{root}/part-{partition:06d}"
        self.files.create_dir(self.folder, recursive=True)
        self.adds_lines, self.lines, self.lock = self.files.type_name == "local", None, threading.Lock()

    def earlier(self) -> Iterator[tuple[tuple, tuple[str, int, None]]]:
        """Key and (answer, attempts, no error) of what the earlier attempts of this task have logged, one by one."""
        from pyarrow import fs

        for info in self.files.get_file_info(fs.FileSelector(self.folder)):
            if info.base_name.endswith(".json") and not info.base_name.startswith("."):
                with self.files.open_input_file(info.path) as raw, io.BufferedReader(raw) as f:
                    for line in f:
                        try:
                            row = json.loads(line)
                        except ValueError:  # the worker died while it wrote
                            continue
                        yield tuple(row[k] for k in KEYS), (row["response"], row["attempts"], None)

    def known(self) -> dict[tuple, tuple[str, int, None]]:
        """(answer, attempts, no error) by key, of the earlier attempts of this task."""
        return dict(self.earlier())

    def record(self, key: tuple, response: str, attempts: int) -> None:
        row = json.dumps(dict(zip(KEYS, key), response=response, attempts=attempts)).encode()
        if self.adds_lines:
            with self.lock:  # calls of one task may overlap
                if self.lines is None:
                    self.lines = self.files.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}.json", buffer_size=0)
                self.lines.write(row + b"\n")
                self.lines.flush()
            return
        name = uuid.uuid4().hex
        with self.files.open_output_stream(f"{self.folder}/.{name}") as f:
            f.write(row)
        self.files.move(f"{self.folder}/.{name}", f"{self.folder}/{name}.json")

    def close(self) -> None:
        if self.lines is not None:
            self.lines.close()

    @staticmethod
    def left(spark: SparkSession, path: str) -> DataFrame | None:
        """What is in the logs below a path, one row per request; None where there is no log."""
        try:
            rows = spark.read.schema(CallLog.FIELDS).option("recursiveFileLookup", True).json(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return rows.where("prompt_hash is not null and response is not null").dropDuplicates(KEYS)

    @staticmethod
    def drop(path: str) -> None:
        from pyarrow import fs

        files, root = file_system(path)
        if files.get_file_info(root).type != fs.FileType.NotFound:
            files.delete_dir(root)


class Answered:
    """Answers of one task by request. They lie in a temporary file, whatever their number; memory holds 16 bytes each: a
    digest of the key and the place in the file, where the whole key is compared."""

    RECENT = 65_536

    def __init__(self, answers: Iterator[tuple[tuple, tuple]] = ()):
        self.file, self.lock, self.recent = tempfile.TemporaryFile(), threading.Lock(), {}
        self.digests, self.places = np.empty(0, "u8"), np.empty(0, "i8")  # by digest
        for key, got in answers:
            self.put(key, got)

    @staticmethod
    def digest(key: tuple) -> int:
        return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little")

    def get(self, key: tuple) -> tuple | None:
        digest = self.digest(key)
        with self.lock:
            place = self.recent.get(digest)
            if place is None:
                at = np.searchsorted(self.digests, np.uint64(digest))
                if at == len(self.digests) or int(self.digests[at]) != digest:
                    return None
                place = int(self.places[at])
            self.file.seek(place)
            *own, response, attempts = json.loads(self.file.readline())
        return (response, attempts, None) if tuple(own) == key else None

    def put(self, key: tuple, got: tuple) -> None:
        with self.lock:
            self.recent[self.digest(key)] = self.file.seek(0, 2)
            self.file.write(json.dumps([*key, got[0], got[1]]).encode() + b"\n")
            if len(self.recent) == self.RECENT:
                digests = np.concatenate([self.digests, np.fromiter(self.recent, "u8", len(self.recent))])
                places = np.concatenate([self.places, np.fromiter(self.recent.values(), "i8", len(self.recent))])
                order = np.argsort(digests, kind="stable")
                self.digests, self.places, self.recent = digests[order], places[order], {}

    def close(self) -> None:
        self.file.close()


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)
