"""Appends that a table remembers by itself: a ledger of the source files it holds.

A checkpoint says what a stream has read. If it is lost, a table that only the checkpoint
knows about would be filled again. A ledger beside the table lists every source file, with its
length, whose rows were committed; whatever is appended passes it first.

A commit has three steps: rows are written to a folder that no reader sees; one rename of the
list of their source files commits them; the written files are moved into the table. What
stopped before the second step is deleted at the next start, what stopped after it is moved.
So each file's rows are in the table once, whether or not a checkpoint survives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.sketches import NOTED, Profile
from tarnlake.plans.workspace import remove

#: Formats whose files are rows by themselves and may be moved into a folder one by one.
FILE_FORMATS = ("parquet", "orc", "json", "csv")
#: ``way`` is how a file was read: a file that one reader could not read may be read by another.
ENTRY = "source_file STRING, length BIGINT, way STRING, commit_no BIGINT"
FIRST_WAY = "stream"
#: The column of records that did not parse.
CORRUPT = "_corrupt_record"


def path_of(spark: SparkSession, source_file: str) -> str:
    """The path to read for a file as lineage names it, which is as a URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(source_file)).toString()


@dataclass(frozen=True)
class Ledger:
    """The source files of the table whose files lie in ``data``, in folder ``root``.

    With a ``profile``, each commit notes what an audit of the table needs (``operators.sketches``).
    One writer at a time. ``data`` and ``root`` must be on one file system and must not hold
    each other.
    """

    spark: SparkSession
    root: str
    data: str
    fmt: str = "parquet"
    profile: Profile | None = None

    def __post_init__(self) -> None:
        if self.fmt not in FILE_FORMATS:
            raise ValueError(f"{self.fmt} keeps a log of its own; a ledger is for {', '.join(FILE_FORMATS)}")

    # Folders

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list:
        system, place = self._system(), self._path(folder)
        return list(system.listStatus(place)) if system.exists(place) else []

    def _commits(self) -> dict[str, int]:
        """Token of each commit, and its number."""
        names = [status.getPath().getName() for status in self._listed(f"{self.root}/commits")]
        return {name.split("-")[1]: int(name.split("-")[0]) for name in names}

    # Reading

    def last(self) -> int:
        """Number of the last commit; 0 for none."""
        return max(self._commits().values(), default=0)

    def committed_after(self, number: int) -> DataFrame:
        """Rows of the commits after ``number``; files of earlier ones are not opened."""
        rows = self.spark.read.format(self.fmt).load(self.data)
        return rows.where(F.col("_metadata.file_name") >= f"{number + 1:09d}-")

    def entries(self) -> DataFrame:
        """One row for each source file and the way it was read, with the commit that holds its rows."""
        if not self._listed(f"{self.root}/commits"):
            return self.spark.createDataFrame([], ENTRY)
        # A commit's folder is a whole list: it came there by one rename.
        return self.spark.read.schema(ENTRY).option("recursiveFileLookup", True).json(f"{self.root}/commits")

    def table(self, name: str) -> DataFrame:
        """The table over what is committed, named ``name`` in the catalog."""
        if not self.spark.catalog.tableExists(name):
            self.spark.catalog.createTable(name, path=self.data, source=self.fmt)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    # Writing

    def recover(self) -> None:
        """Bring the table to what the ledger says after a run that stopped anywhere."""
        if self._system().exists(self._path(f"{self.data}/_spark_metadata")):
            raise ValueError(f"{self.data} was filled by a stream without a ledger, whose log readers go by")
        commits = self._commits()
        for status in self._listed(f"{self.root}/staged"):
            token = status.getPath().getName()
            if token in commits:
                self._move(token, commits[token])
            else:
                remove(self.spark, status.getPath().toString())
        remove(self.spark, f"{self.root}/lists")

    def _move(self, token: str, number: int) -> None:
        system = self._system()
        system.mkdirs(self._path(self.data))
        for status in self._listed(f"{self.root}/staged/{token}"):
            file = status.getPath()
            if not file.getName().startswith(("_", ".")):
                target = self._path(f"{self.data}/{number:09d}-{file.getName()}")
                if not system.rename(file, target):
                    raise OSError(f"{file} could not be moved to {target}")
        remove(self.spark, f"{self.root}/staged/{token}")

    def _with_lengths(self, files: Sequence[str], way: str) -> DataFrame:
        """Rows of the ledger for files of one append, whose names the driver holds as it reads them."""
        rows = []
        for file in files:
            place = self._path(path_of(self.spark, file))
            system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
            rows.append((file, system.getFileStatus(place).getLen(), way, 0))
        return self.spark.createDataFrame(rows, ENTRY)

    def append(self, df: DataFrame, way: str = FIRST_WAY, source: str = "source_file") -> list[str]:
        """Commit the rows of ``df`` whose source file the ledger does not have; returns those files.

        ``source`` names the column with the file of each row. ``df`` is written once; the files
        are taken from what was written, so that the feed is parsed once. Only where some of
        them are known already is what was written filtered and written again. A file of the
        same name and another length is another file.
        """
        token = uuid4().hex
        staged = f"{self.root}/staged/{token}"
        self._write(df, token)
        written = self.spark.read.schema(df.schema).format(self.fmt).load(staged)
        files = [row[0] for row in written.select(source).where(F.col(source).isNotNull()).distinct().collect()]
        listed = self._with_lengths(files, way)
        known = self.entries().where(F.col("way") == way).select("source_file", "length")
        old = [row[0] for row in listed.join(known, ["source_file", "length"], "left_semi").select("source_file").collect()]
        if old:
            # The names are those of one micro-batch, as the driver holds them.
            seen = self.spark.createDataFrame([(file,) for file in old], "__seen STRING")
            fresh = written.join(F.broadcast(seen), F.col(source) == F.col("__seen"), "left_anti")
            again = uuid4().hex
            self._write(fresh, again)
            remove(self.spark, staged)
            token = again
        taken = sorted(set(files) - set(old))
        if not taken:
            remove(self.spark, f"{self.root}/staged/{token}")
            return []
        self._commit(token, self._with_lengths(taken, way))
        return taken

    def _write(self, df: DataFrame, token: str) -> None:
        """Write the rows of a commit to come, and note what is observed of them."""
        staged = f"{self.root}/staged/{token}"
        if self.profile is None:
            df.write.format(self.fmt).save(staged)
            return
        seen = Observation()
        df.observe(seen, *self.profile.columns(df.columns, CORRUPT)).write.format(self.fmt).save(staged)
        written = self.spark.read.schema(df.schema).format(self.fmt).load(staged)
        distinct = written.agg(F.count_distinct(self.profile.key)).first()[0]
        row = (token, distinct, *self.profile.note(seen.get))
        notes = self.spark.createDataFrame([row], f"token STRING, distinct_keys BIGINT, {NOTED}")
        notes.coalesce(1).write.parquet(f"{self.root}/notes/{token}")

    def notes(self) -> DataFrame:
        """What each commit noted, one row each, with its number."""
        schema = f"token STRING, distinct_keys BIGINT, {NOTED}"
        numbers = self.spark.createDataFrame(list(self._commits().items()), "token STRING, commit_no BIGINT")
        if not self._listed(f"{self.root}/notes"):
            return self.spark.createDataFrame([], schema).join(numbers, "token")
        noted = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/notes")
        return noted.join(numbers, "token")  # what was noted for no commit is not there

    def note(self, files: Sequence[str], way: str) -> None:
        """Enter files without rows, such as those that ``way`` could not read."""
        if files:
            self._commit(uuid4().hex, self._with_lengths(files, way))

    def _commit(self, token: str, listed: DataFrame) -> None:
        number = self.last() + 1
        entries = listed.withColumn("commit_no", F.lit(number).cast("bigint"))
        entries.coalesce(1).write.json(f"{self.root}/lists/{token}")
        system = self._system()
        system.mkdirs(self._path(f"{self.root}/commits"))
        target = self._path(f"{self.root}/commits/{number:09d}-{token}")
        if not system.rename(self._path(f"{self.root}/lists/{token}"), target):
            raise OSError(f"{target} could not be committed")
        self._move(token, number)


def append_once(df: DataFrame, table: str, checkpoint: str, ledger: Ledger, source: str = "source_file") -> DataFrame:
    """Append the new rows of the stream ``df`` to ``table``; return the table.

    As ``append_stream``, but a run without its checkpoint, or with another one, adds no file
    twice: the ledger decides, the checkpoint only spares reading files again.
    """
    ledger.recover()
    query = (
        df.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: _appended(ledger, batch, source))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not ledger._listed(ledger.data):
        df.sparkSession.createDataFrame([], df.schema).write.format(ledger.fmt).mode("append").save(ledger.data)
    return ledger.table(table)


def _appended(ledger: Ledger, batch: DataFrame, source: str) -> None:
    ledger.append(batch, source=source)
