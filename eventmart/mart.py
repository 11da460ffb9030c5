"""The stored star schema: seven Parquet tables and one record per commit.

Layout below the root::

    fact_sales/load=<n>/event_type=<t>/...   appended, one folder per load
    dead_letter_events/load=<n>/...          appended, one folder per load
    dim_*/load=<n>/bucket=<b>/...            members of one hash bucket, written when one of them changed
    known_ids/load=<n>/...                   event ids of this and earlier loads, see operators/known_ids.py
    claims/<n>                               numbers that attempts have taken
    commits/<k>.json                         state after the k-th commit
    commits/newest                           where to begin to look for the newest
    checked/<kind>/<k>                       the k-th commit breaks none of a kind of constraints
    staging/<n>/...                          work of a load in progress

Every attempt to load a batch claims a number nobody had before, and writes only
below it, so no attempt touches files of another. It becomes visible in all
tables at once when its commit appears. A commit follows the one its attempt
started from; if another was published meanwhile, publishing fails and the batch
is tried again under a new number. Numbers that were skipped by then are dead:
the commit lists them, and readers leave their folders out.

A dimension's members lie in a fixed number of buckets by the hash of their id, and
a commit says for each bucket which load wrote it last. A load rewrites the buckets in
which a member is new or changed, and no others.

Facts are split by event type because nearly every report asks for one or two
of the six types: the scan then reads a fifth of the table. Event times are no
use as a split: no report filters on them.
"""

import json
import threading
import uuid
from collections import defaultdict
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.domain import TABLE_DDL, TABLES

APPENDED = {"fact_sales": ("event_type",), "dead_letter_events": ()}


KNOWN_IDS = "known_ids"

# A commit remembers the newest loads that brought rows to an appended table, until
# they hold this many rows.
RECENT_ROWS = 100

# Their files appear when they are closed, and they have no rename of their own.
OBJECT_STORES = ("s3a", "gs", "abfs", "abfss")

_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)


class ConflictError(RuntimeError):
    """Another commit was published since the attempt began."""


@dataclass(frozen=True)
class Commit:
    """State after a load."""

    number: int  # position among the commits
    load: int  # the number under which its files lie
    snapshots: dict[str, int] = field(default_factory=dict)  # table -> load that last wrote it
    max_keys: dict[str, int] = field(default_factory=dict)  # table -> largest surrogate key
    applied: dict[str, int] = field(default_factory=dict)  # source -> its last batch id
    counts: dict[str, int] = field(default_factory=dict)  # what this load did
    dead: list[int] = field(default_factory=list)  # numbers of attempts that were never published
    recent: dict[str, list] = field(default_factory=dict)  # table -> newest [load, rows], newest first
    buckets: dict[str, list[int]] = field(default_factory=dict)  # dimension -> load that last wrote each bucket, 0 for none
    runs: list[list[int]] = field(default_factory=list)  # index of event ids: [load, rows, buckets] of each run
    loose: list[list[int]] | None = None  # [load, rows] of loads whose ids are in no run; None where nothing is indexed

    def with_recent(self, table: str, load: int, rows: int) -> list:
        """A table's entry of ``recent`` after one more load."""
        kept, held = [], 0
        for entry in [[load, rows], *self.recent.get(table, [])] if rows else self.recent.get(table, []):
            if held < RECENT_ROWS:
                kept.append(entry)
            held += entry[1]
        return kept


class Files:
    """The few file operations Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def put_new(self, path: str, text: str, hidden: str) -> bool:
        """Make a file appear whole; False if there is one, whoever else tries at the same time.

        Each kind of file system has another step that only one of several processes
        can win: a hard link on a local disk, a conditional put on an object store, and
        elsewhere, as in HDFS, a rename that does not overwrite.
        """
        target, scheme = self._fs.makeQualified(self._path(path)), self._fs.getScheme()
        if scheme in OBJECT_STORES:
            if self._fs.exists(target):
                return False
            builder = self._fs.createFile(target).overwrite(False).recursive()
            stream = builder.opt("fs.option.create.conditional.overwrite", "true").build()
            try:
                stream.write(bytearray(text, "utf-8"))
                stream.close()
            except Py4JJavaError as error:
                return self._lost(error)
            return True
        self.write(hidden, text)
        source = self._fs.makeQualified(self._path(hidden))
        self._fs.mkdirs(target.getParent())
        try:
            if scheme == "file":
                to_local = self._jvm.java.nio.file.Paths.get
                self._jvm.java.nio.file.Files.createLink(to_local(target.toUri()), to_local(source.toUri()))
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
                kind = self._jvm.org.apache.hadoop.fs.Options.Rename
                once = self._gateway.new_array(kind, 1)
                once[0] = kind.NONE
                context.rename(source, target, once)
        except Py4JJavaError as error:
            return self._lost(error)
        finally:
            self._fs.delete(source, False)
        return True

    def _lost(self, error: Py4JJavaError) -> bool:
        """False for an error that says the file exists; any other goes on."""
        kinds = ("FileAlreadyExistsException", "PreconditionFailed", "412")
        if any(kind in str(error.java_exception) for kind in kinds):
            return False
        raise error

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


class Mart:
    """A star schema under ``root``, a folder all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Files(spark, self.root)

    def lock(self) -> threading.RLock:
        """Held while a batch is loaded: within a process, loads into one root follow each other."""
        return _locks[self.root]

    # --- commits

    def _newest_number(self) -> int | None:
        """The pointer says where to begin; the commit after the last one does not exist."""
        pointer = f"{self.root}/commits/newest"
        try:
            number = int(self._files.read(pointer))
        except (Py4JJavaError, ValueError):  # being replaced, or never written
            names = self._files.names(f"{self.root}/commits")
            number = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=-1)
        while self._files.exists(self._commit_path(number + 1)):
            number += 1
        return number if number >= 0 else None

    def commit_record(self, number: int | None = None) -> Commit | None:
        """The newest commit, or that of a given number; None for a root without tables."""
        if number is None:
            number = self._newest_number()
        return None if number is None else Commit(**json.loads(self._files.read(self._commit_path(number))))

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:020d}.json"

    def bootstrap(self) -> Commit:
        """Create the tables, empty, unless they exist."""
        found = self.commit_record()
        if found is None:
            try:
                self.publish(Commit(0, 0, snapshots={t: 0 for t in TABLES}, max_keys={t: 0 for t in TABLES}, loose=[]))
            except ConflictError:  # somebody else did
                pass
            found = self.commit_record()
        return found

    def claim(self, after: Commit) -> int:
        """A number for an attempt, above that of ``after`` and of every attempt before."""
        taken = [int(n) for n in self._files.names(f"{self.root}/claims") if n.isdigit()]
        number = max([after.load, *taken]) + 1
        while not self._files.put_new(f"{self.root}/claims/{number}", "", f"{self.root}/claims/.{uuid.uuid4().hex}"):
            number += 1
        return number

    def publish(self, commit: Commit) -> None:
        """Make a commit visible; raises :class:`ConflictError` if its number is taken."""
        path, hidden = self._commit_path(commit.number), f"{self.root}/commits/.{uuid.uuid4().hex}"
        if not self._files.put_new(path, json.dumps(asdict(commit)), hidden):
            raise ConflictError(path)
        self._files.write(f"{self.root}/commits/newest", str(commit.number))
        for name in self._files.names(f"{self.root}/claims"):
            if name.isdigit() and int(name) < commit.load:
                self._files.remove(f"{self.root}/claims/{name}")

    def mark_checked(self, commit: Commit, kind: str) -> None:
        """Remember that a commit breaks none of a kind of constraints."""
        self._files.write(f"{self.root}/checked/{kind}/{commit.number}", "")
        for number in self._checked_numbers(kind):
            if number < commit.number:
                self._files.remove(f"{self.root}/checked/{kind}/{number}")

    def checked(self, kind: str) -> Commit | None:
        """The newest commit that was marked."""
        numbers = self._checked_numbers(kind)
        return self.commit_record(max(numbers)) if numbers else None

    def _checked_numbers(self, kind: str) -> list[int]:
        return [int(n) for n in self._files.names(f"{self.root}/checked/{kind}") if n.isdigit()]

    # --- tables

    def path(self, table: str, load: int) -> str:
        return f"{self.root}/{table}/load={load}"

    def staging(self, load: int, name: str = "") -> str:
        return f"{self.root}/staging/{load}/{name}".rstrip("/")

    def clear_staging(self, load: int) -> None:
        self._files.remove(self.staging(load))

    def clear_load(self, load: int) -> None:
        """Remove what an attempt has written, after it failed."""
        for table in (*TABLES, KNOWN_IDS):
            self._files.remove(self.path(table, load))
        self.clear_staging(load)

    def clear_run(self, load: int) -> None:
        """Remove a run of the index of event ids that a later one has taken in."""
        self._files.remove(self.path(KNOWN_IDS, load))

    def table_exists(self, table: str) -> bool:
        found = self.commit_record()
        return found is not None and table in found.snapshots

    def table(self, name: str, at: Commit | None = None, loads: list[int] | None = None, after: int = 0) -> DataFrame:
        """A table as of commit ``at``, by default the newest; of an appended one, ``loads`` only where given, and loads ``after`` one."""
        at = at or self.commit_record()
        if at is None or name not in at.snapshots:
            raise LookupError(f"no table {name} under {self.root}")
        ddl, newest = TABLE_DDL[name], at.snapshots[name]
        if newest == 0:
            return self.spark.createDataFrame([], ddl)
        if name in at.buckets:
            return self.members(name, at)
        if name not in APPENDED:
            return self.spark.read.schema(ddl).parquet(self.path(name, newest))
        columns = self.spark.createDataFrame([], ddl).columns
        rows = self.spark.read.schema(f"{ddl}, load BIGINT").parquet(f"{self.root}/{name}")
        visible = F.col("load") <= newest
        if at.dead:
            visible &= ~F.col("load").isin(*at.dead)
        if loads is not None:
            visible &= F.col("load").isin(*loads)
        if after:
            visible &= F.col("load") > after
        return rows.filter(visible).select(*columns)

    def members(self, name: str, at: Commit, buckets: list[int] | None = None) -> DataFrame:
        """A dimension's members in some of its buckets, by default all."""
        loads = at.buckets[name]
        wanted = range(len(loads)) if buckets is None else buckets
        paths = [f"{self.path(name, loads[b])}/bucket={b}" for b in wanted if loads[b]]
        if not paths:
            return self.spark.createDataFrame([], TABLE_DDL[name])
        return self.spark.read.schema(TABLE_DDL[name]).parquet(*paths)

    def buckets_written(self, name: str, load: int) -> list[int]:
        """The buckets of a dimension that a load has written."""
        names = self._files.names(self.path(name, load))
        return [int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")]

    def newest_rows(self, name: str, rows: int) -> DataFrame:
        """An appended table's newest loads, as many as it takes to hold ``rows`` rows.

        Where the commit remembers fewer rows than that, the whole table.
        """
        at, loads, held = self.commit_record(), [], 0
        for load, count in at.recent.get(name, []) if at else []:
            if held < rows:
                loads.append(load)
            held += count
        return self.table(name, at, loads if held >= rows else None)

    def list_tables(self) -> DataFrame:
        """Names of the existing tables, ordered."""
        found = self.commit_record()
        names = sorted(found.snapshots) if found else []
        return self.spark.createDataFrame([(n,) for n in names], "table_name string").orderBy("table_name")

    def create_views(self) -> None:
        """Make the tables available to ``spark.sql`` under their own names."""
        at = self.commit_record()
        for name in TABLES:
            self.table(name, at).createOrReplaceTempView(name)
