"""Tables that grow by one folder per micro-batch.

A micro-batch that is run again after a failure reads only what earlier batches left and
writes only what its first attempt did not finish, so every batch counts once.

So that a trigger does not read a folder for every batch there ever was, ``FANOUT`` folders in a
row are rewritten as one block, as many blocks as one larger block, and so on. The blocks that make
up a history follow from the number of batches; one that a failure has left out is replaced by
its parts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FANOUT = 8


class BatchTables:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType | str]):
        self.root = root.rstrip("/")
        self.schemas = {
            name: T.StructType.fromDDL(s) if isinstance(s, str) else s for name, s in schemas.items()
        }
        for name, schema in self.schemas.items():
            if not self._exists(spark, self._folder(name, -1)):
                spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._folder(name, -1))

    def _folder(self, name: str, start: int, size: int = 1) -> str:
        if size == 1:
            return f"{self.root}/{name}/batch_id={start}"
        return f"{self.root}/{name}_blocks/{start}-{start + size - 1}"

    @staticmethod
    def _exists(spark: SparkSession, path: str) -> bool:
        """A folder is complete when its job has left the success mark."""
        try:
            spark.read.schema("value string").text(path + "/_SUCCESS")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def done(self, spark: SparkSession, name: str, batch_id: int) -> bool:
        return self._exists(spark, self._folder(name, batch_id))

    def last(self, spark: SparkSession, name: str) -> int:
        """The last batch that wrote the table, -1 before the first. Batches are numbered without gaps."""
        low, high = -1, 1
        while self.done(spark, name, high - 1):
            low, high = high - 1, 2 * high
        while high - 1 > low + 1:
            mid = (low + high) // 2
            if self.done(spark, name, mid):
                low = mid
            else:
                high = mid + 1
        return low

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Write a batch's rows once; a table that an earlier attempt finished stays as it is,
        so a stream that reads it never sees its rows twice."""
        if not self.done(df.sparkSession, name, batch_id):
            columns = self.schemas[name].names
            df.select(*columns).write.mode("overwrite").parquet(self._folder(name, batch_id))

    def compact(self, spark: SparkSession, names, batch_id: int) -> None:
        """Write the blocks that end with this batch."""
        for name in names:
            size = FANOUT
            while (batch_id + 1) % size == 0:
                start = batch_id + 1 - size
                if not self._exists(spark, self._folder(name, start, size)):
                    part = size // FANOUT
                    rows = self._read(spark, name, [p for i in range(FANOUT) for p in self._parts(spark, name, start + i * part, part)])
                    rows.hint("rebalance").write.mode("overwrite").parquet(self._folder(name, start, size))
                size *= FANOUT

    def _parts(self, spark: SparkSession, name: str, start: int, size: int) -> list[str]:
        """The folders that hold the batches from ``start`` on, as few as there are."""
        if size == 1 or self._exists(spark, self._folder(name, start, size)):
            return [self._folder(name, start, size)]
        part = size // FANOUT
        return [p for i in range(FANOUT) for p in self._parts(spark, name, start + i * part, part)]

    def _read(self, spark: SparkSession, name: str, folders: list[str]) -> DataFrame:
        return spark.read.schema(self.schemas[name]).parquet(*(folders or [self._folder(name, -1)]))

    def between(self, spark: SparkSession, name: str, first: int, end: int) -> DataFrame:
        """What the batches from ``first`` on and before ``end`` wrote."""
        folders, at = [], max(first, 0)
        while at < end:
            size = 1
            while at % (size * FANOUT) == 0 and at + size * FANOUT <= end:
                size *= FANOUT
            folders += self._parts(spark, name, at, size)
            at += size
        return self._read(spark, name, folders)

    def earlier(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """Everything that batches before this one wrote."""
        return self.between(spark, name, 0, batch_id)

    def one(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """What this batch wrote."""
        return self._read(spark, name, [self._folder(name, batch_id)])

    def previous(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """What the batch before this one wrote (for tables that are replaced as a whole)."""
        last = batch_id - 1
        return self.one(spark, name, last if self.done(spark, name, last) else -1)

    def stream(self, spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
        """The table as a stream, oldest folders first."""
        reader = spark.readStream.schema(self.schemas[name])
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(f"{self.root}/{name}/batch_id=*")

    def everything(self, spark: SparkSession, name: str) -> DataFrame:
        return self.earlier(spark, name, self.last(spark, name) + 1)
