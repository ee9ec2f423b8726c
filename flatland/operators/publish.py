"""Publish: delete target rows whose key is in the stage, insert the stage (K4).

Parquet tables cannot be updated in place, and a table cannot be overwritten
while it is being read. Two target layouts:

* ``VersionedTable``: every publish writes a new version folder next to the
  old ones and the reader takes the newest committed version. A replay of the
  same version number rewrites only that version, so re-running a batch is
  idempotent, and readers always see one whole version. The whole target is
  rewritten per publish (bucketed by key, so it is never shuffled).
* ``PartitionedTable``: the target is partitioned by a column computed from
  the key, and a publish rewrites only the partitions the stage touches. What
  it wrote becomes the table by one commit: readers see all of it or nothing.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland import storage
from flatland.operators.joins import join_small

# Fixed value: the name of a partition value that is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_VERSION_RE = re.compile(r"/v(\d{6})$")
_COMMIT_RE = re.compile(r"/c(\d{8})$")
_MADE_FOR_RE = re.compile(r"/c(\d{8})-[0-9a-f]{12}(\.json)?$")
_FOLDER = "_folder"
_NAME = "_part_name"
#: The folder of a write in the path of one of its files.
_WRITE_OF_FILE = r"^.*/(data/c[0-9]{8}-[0-9a-f]{12})/[^/]+$"
#: Partitions of one write that get a folder each; those of a write that has more share files.
OWN_FOLDERS = 256
#: Partitions that one statement adds to a catalog table.
PARTITIONS_AT_ONCE = 500


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str],
           stage_key_rows: int | None = None, inserts: DataFrame | None = None) -> DataFrame:
    """Target minus rows matched by a stage key, plus stage rows with full keys.

    ``DELETE ... WHERE EXISTS (stage.k = target.k)`` is a left anti join on the
    keys: null key parts never match, so target rows with a null key survive
    (J1), and stage rows with a null key part are not inserted (P11). When the
    caller knows the stage row count and it is small, the stage keys are
    broadcast and the target is not shuffled at all. ``inserts``: the rows to insert, if
    they are not simply those of the stage.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("publish needs key columns")
    # Target rows with a null key part can never match: they pass around the
    # join instead of all hashing to one shuffle partition.
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(f"`{k}`").isNull()
    kept_null = target.filter(any_null)
    with_key = stage.dropna(subset=keys)
    inserts = with_key if inserts is None else inserts
    stage_keys = with_key.select(*keys)
    survivors = join_small(target.filter(~any_null), stage_keys, keys, "left_anti", stage_key_rows)
    return survivors.unionByName(kept_null).unionByName(inserts.select(*target.columns))


def assert_unique_keys(stage: DataFrame, keys: Sequence[str]) -> None:
    """Publish expects a de-duplicated stage (D23). Rows with a null key part are not published and don't count."""
    if not stage.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"{_DUPLICATE} on {list(keys)}; run dedup_latest first")


_DUPLICATE = "stage has duplicate keys"


def refuse_duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, which fail when they are read if two have one key. Rows that are dealt by key already (a bucketed
    publish) are not shuffled for it."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]))
    refused = F.raise_error(F.lit(f"{_DUPLICATE} on {list(keys)}; run dedup_latest first"))
    return rows.withColumn("_same", n).filter(F.when(F.col("_same") > 1, refused).isNull()).drop("_same")


class VersionedTable:
    """A parquet table kept as numbered version folders ``v000001``, ``v000002``...

    With ``keys`` and ``buckets`` every version is written bucketed by the key
    (an external catalog table over the version folder). A publish then joins
    the target bucket by bucket with the stage, and only the stage is
    shuffled: the cost of a publish grows with the stage, while the target is
    read once and written once, never moved between executors.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] | None = None,
                 buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys or [])
        self.buckets = buckets if self.keys else None

    @property
    def bucketed(self) -> bool:
        return bool(self.keys and self.buckets)

    def versions(self) -> list[int]:
        out = []
        for path, is_dir in storage.list_dir(self.spark, self.root):
            m = _VERSION_RE.search(path.rstrip("/"))
            if is_dir and m and storage.exists(self.spark, f"{path}/_SUCCESS"):
                out.append(int(m.group(1)))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v{version:06d}"

    def table_name(self, version: int) -> str:
        digest = hashlib.sha1(self.root.encode()).hexdigest()[:12]
        return f"flatland_{digest}_v{version:06d}"

    def _register(self, version: int) -> str:
        name = self.table_name(version)
        if not self.spark.catalog.tableExists(name):
            # A version written by another session: register it again, with its
            # columns as the files have them (bucketing needs the column list).
            schema = self.spark.read.parquet(self.path(version)).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                           f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path(version)}'")
        return name

    def read(self, version: int | None = None) -> DataFrame | None:
        version = self.current_version() if version is None else version
        if version is None:
            return None
        if self.bucketed:
            return self.spark.table(self._register(version))
        return self.spark.read.parquet(self.path(version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as a version (next one by default) and return its number.

        A bucketed version is dealt by bucket first, so each bucket is one
        file; a frame that already is (a publish) is not shuffled again.
        """
        if version is None:
            version = (self.current_version() or 0) + 1
        if self.bucketed:
            name = self.table_name(version)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")   # external: drops the entry, not the files
            dealt = df.repartition(self.buckets, *[F.col(f"`{k}`") for k in self.keys])
            (dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, *self.keys)
             .sortBy(*self.keys).option("path", self.path(version)).saveAsTable(name))
        else:
            df.write.mode("overwrite").parquet(self.path(version))
        return version

    def expire(self, keep_last: int) -> list[int]:
        """Drop all but the newest ``keep_last`` versions; returns what was dropped."""
        old = self.versions()[:-keep_last] if keep_last > 0 else self.versions()
        for v in old:
            if self.bucketed:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(v)}")
            storage.delete(self.spark, self.path(v))
        return old


def publish(spark: SparkSession, stage: DataFrame, table: VersionedTable, keys: Sequence[str],
            version: int | None = None, stage_key_rows: int | None = None) -> int:
    """Publish ``stage`` into ``table`` by key; returns the new version number.

    With ``version`` given (a streaming batch id, say) the base is the newest
    version below it, so a replay of that version gives the same result. For
    a bucketed table the stage is hash-partitioned into the table's buckets
    (its keys for the anti join, its rows for the insert); the target is read
    bucket by bucket and never shuffled.
    """
    keys = list(keys)
    inserts = None
    if table.bucketed:
        # Checked where the stage's rows lie by key anyway: no pass and shuffle for the check alone.
        stage = stage.repartition(table.buckets, *keys)
        inserts = refuse_duplicates(stage.dropna(subset=keys), keys)
    else:
        assert_unique_keys(stage, keys)
    existing = [v for v in table.versions() if version is None or v < version]
    if existing:
        target = table.read(existing[-1])
        new = upsert(target, stage, keys, stage_key_rows, inserts)
    else:
        new = stage.dropna(subset=keys) if inserts is None else inserts
    try:
        return table.write(new, version)
    except Exception as e:  # noqa: BLE001 - the check's own error is told as such
        if _DUPLICATE in str(e):
            raise ValueError(f"{_DUPLICATE} on {keys}; run dedup_latest first") from e
        raise


def _rebalanced(df: DataFrame, part: str) -> DataFrame:
    """Rows of one partition value together before a partitioned write, so
    each value gets few files rather than one per task. REBALANCE lets AQE
    split a value that holds many rows and merge small ones."""
    return df.hint("rebalance", part)


class ConcurrentPublish(RuntimeError):
    """Another publish committed first; read the table again and publish anew."""


@dataclass(frozen=True)
class Commit:
    """One state of a ``PartitionedTable``: where each partition's rows are, and what made it."""

    number: int
    schema: T.StructType
    folders: dict[str, str]         # partition value as text -> folder below the root, its own or one that others share
    done: dict[str, int]            # by source: the last of its numbered loads that is in the table
    files: dict[str, dict[str, list[str]]]      # shared folder -> file -> the partition values it was written with


class PartitionedTable:
    """A keyed target stored by a column computed from the key, with all-or-nothing commits.

    A publish reads and rewrites only the partitions the stage touches, so
    its cost follows the stage, not the table: with keys that arrive roughly
    in order (surrogate keys, dates in the key), a range expression such as
    ``floor(key / width)`` keeps each load in a few partitions. The default is
    a hash of the key into ``buckets`` partitions. ``part_expr`` must depend on
    the key columns only: a key then always lives in one partition, which is
    what lets delete-by-key look at the touched partitions alone.

    Every write puts its partitions into a folder of its own, ``data/c<number>-<id>``: up to ``OWN_FOLDERS`` into a folder
    each, and more into files that they share, whose number follows the rows. Nothing that a reader may be
    reading is changed. A list of all partitions, their folders and the files' partitions follows (``manifests``), and then one small
    file, ``commits/c<number>``, which must not exist yet, names the list: that file is the switch. Before it the table is the old
    one, whatever has been written; after it, the new one. A writer whose number is taken raises ``ConcurrentPublish``.
    Readers look up the newest commit once and keep its folders until ``expire`` removes them.

    Readers open the files that hold partitions they want, and leave out the rows of others. A publish also rewrites what is
    left of a shared folder of whose partitions most have been replaced: so at most half of the partitions in such files
    are replaced ones, and no more are moved than have been replaced.

    The partition column is in the files, so values are read back as they were; names only tell them apart. Text values have
    a mark before them: ``01`` and ``1``, an empty text and null stay apart.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str],
                 part_expr: "F.Column | None" = None, buckets: int = 256, part_col: str = "_key_part"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.part_col = part_col
        self.part_expr = part_expr if part_expr is not None else F.pmod(
            F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(buckets))

    # Commits

    def commits(self) -> list[int]:
        """Numbers of the commits, oldest first; one that is being created (still empty) is none yet."""
        found = [(int(m.group(1)), p) for p, is_dir in storage.list_dir(self.spark, f"{self.root}/commits")
                 if not is_dir and (m := _COMMIT_RE.search(p))]
        found.sort()
        while found and not (storage.read_small_text(self.spark, found[-1][1]) or "").strip():
            found.pop()
        return [n for n, _ in found]

    def commit(self, number: int | None = None) -> Commit | None:
        """The newest commit, or that of a number."""
        if number is None:
            numbers = self.commits()
            if not numbers:
                return None
            number = numbers[-1]
        name = (storage.read_small_text(self.spark, f"{self.root}/commits/c{number:08d}") or "").strip()
        spec = json.loads(storage.read_small_text(self.spark, f"{self.root}/manifests/{name}"))
        return Commit(number, T.StructType.fromJson(spec["schema"]), spec["folders"], spec["done"], spec.get("files", {}))

    def exists(self) -> bool:
        return bool(self.commits())

    def _switch(self, base: Commit | None, schema: T.StructType, folders: dict[str, str], files: dict[str, dict[str, list[str]]],
                done: tuple[str, int] | None) -> Commit:
        """Make a list of folders the table, if ``base`` is still the newest commit. ``files``: those of the folder just written."""
        used = set(folders.values())
        files = {f: held for f, held in {**(base.files if base else {}), **files}.items() if f in used}
        loads = {**(base.done if base else {}), **dict([done] if done else [])}
        number = (base.number if base else 0) + 1
        name = f"c{number:08d}-{uuid.uuid4().hex[:12]}.json"
        storage.mkdirs(self.spark, f"{self.root}/manifests")
        storage.write_small_text(self.spark, f"{self.root}/manifests/{name}",
                                 json.dumps({"schema": json.loads(schema.json()), "folders": folders, "files": files, "done": loads}))
        storage.mkdirs(self.spark, f"{self.root}/commits")
        if not storage.create_new(self.spark, f"{self.root}/commits/c{number:08d}", name):
            raise ConcurrentPublish(f"{self.root}: commit {number} has been made by another publish")
        return Commit(number, schema, folders, loads, files)

    def _name(self) -> "F.Column":
        return F.coalesce(F.col(self.part_col).cast("string"), F.lit(NULL_FOLDER))

    def _write_folders(self, base: Commit | None, df: DataFrame,
                       parts: int | None = None) -> tuple[T.StructType, dict[str, str], dict[str, dict[str, list[str]]]]:
        """Write rows (with the partition column) into a folder of their own; returns the partitions written and the shared files'.

        ``parts``: how many partitions they are of, if that is known.
        """
        where = f"data/c{(base.number if base else 0) + 1:08d}-{uuid.uuid4().hex[:12]}"
        if parts is None:
            parts = df.select(self.part_col).distinct().limit(OWN_FOLDERS + 1).count()
        dealt, folders, files = _rebalanced(df, self.part_col), {}, {}
        if parts <= OWN_FOLDERS:
            dealt.withColumn(_FOLDER, F.col(self.part_col).cast("string")).write.partitionBy(_FOLDER).parquet(f"{self.root}/{where}")
            for path, is_dir in storage.list_dir(self.spark, f"{self.root}/{where}"):
                name = path.rstrip("/").rsplit("/", 1)[-1]
                if is_dir and name.startswith(f"{_FOLDER}="):
                    folders[unquote(name[len(_FOLDER) + 1:])] = f"{where}/{name}"
            return df.schema, folders, {}
        dealt.write.parquet(f"{self.root}/{where}")
        written = [p for p, is_dir in storage.list_dir(self.spark, f"{self.root}/{where}") if not is_dir and p.endswith(".parquet")]
        if written:
            # One column of what was written: a row for each file and partition.
            held = self.spark.read.schema(df.schema).parquet(*written).select(F.col("_metadata.file_name").alias("file"), self._name().alias("name"))
            for file, name in held.distinct().collect():
                folders[name] = where
                files.setdefault(file, []).append(name)
        return df.schema, folders, {where: files}

    # Reading

    def _folders(self, commit: Commit, values: Sequence[str] | None = None) -> DataFrame:
        """The rows of a commit, or of some of its partitions."""
        wanted: dict[str, set[str]] = {}
        for v in commit.folders if values is None else commit.folders.keys() & set(values):
            wanted.setdefault(commit.folders[v], set()).add(v)
        whole, partly, live = [], [], set()
        for folder, names in wanted.items():
            files = commit.files.get(folder)
            if files is None or all(names.issuperset(held) for held in files.values()):
                whole.append(f"{self.root}/{folder}")
                continue
            for file, held in files.items():
                taken = names.intersection(held)
                if len(taken) == len(held):
                    whole.append(f"{self.root}/{folder}/{file}")
                elif taken:
                    partly.append(f"{self.root}/{folder}/{file}")
                    live.update((folder, v) for v in taken)
        read = self.spark.read.schema(commit.schema)
        rows = read.parquet(*whole) if whole else None
        if partly:
            marked = (read.parquet(*partly).withColumn(_FOLDER, F.regexp_extract(F.col("_metadata.file_path"), _WRITE_OF_FILE, 1))
                      .withColumn(_NAME, self._name()))
            listed = self.spark.createDataFrame(sorted(live), f"{_FOLDER} string, {_NAME} string")
            kept = join_small(marked, listed, [_FOLDER, _NAME], "left_semi", len(live)).select(*[f"`{c}`" for c in commit.schema.names])
            rows = kept if rows is None else rows.unionByName(kept)
        return self.spark.createDataFrame([], commit.schema) if rows is None else rows

    def left_over(self, commit: Commit, values: Sequence[str]) -> set[str]:
        """The partitions that are left of shared folders of which fewer than half are, once ``values`` are replaced."""
        left: dict[str, set[str]] = {}
        for v, folder in commit.folders.items():
            if folder in commit.files:
                left.setdefault(folder, set()).add(v)
        out: set[str] = set()
        for folder, names in left.items():
            names = names.difference(values)
            if 2 * len(names) < len({v for held in commit.files[folder].values() for v in held}):
                out |= names
        return out

    def read_with_part(self, number: int | None = None) -> DataFrame | None:
        commit = self.commit(number)
        return None if commit is None else self._folders(commit)

    def read(self, number: int | None = None) -> DataFrame | None:
        """The table, or as it was at a commit that has not been expired."""
        df = self.read_with_part(number)
        return None if df is None else df.drop(self.part_col)

    def partitions(self) -> list[str]:
        """Partition names, e.g. ``_key_part=17``."""
        commit = self.commit()
        return sorted(f"{self.part_col}={v}" for v in commit.folders) if commit else []

    def catalog_view(self, name: str) -> str:
        """Let SQL read the newest commit as ``name``: a view over a catalog table of its folders, less the partitions replaced since.

        The table belongs to one commit; replacing the view switches all partitions at once.
        """
        commit = self.commit()
        if commit is None:
            raise ValueError(f"{self.root}: nothing has been published")
        own = f"{name}_c{commit.number:08d}"
        if not self.spark.catalog.tableExists(own):
            storage.mkdirs(self.spark, f"{self.root}/catalog")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in commit.schema.fields)
            self.spark.sql(f"CREATE TABLE {own} ({columns}, `{_FOLDER}` STRING) USING parquet PARTITIONED BY (`{_FOLDER}`) LOCATION '{self.root}/catalog'")
            listed = sorted(set(commit.folders.values()))
            for at in range(0, len(listed), PARTITIONS_AT_ONCE):
                parts = " ".join(f"PARTITION (`{_FOLDER}` = {_sql_text(f)}) LOCATION {_sql_text(f'{self.root}/{f}')}" for f in listed[at:at + PARTITIONS_AT_ONCE])
                self.spark.sql(f"ALTER TABLE {own} ADD IF NOT EXISTS {parts}")
        columns = ", ".join(f"`{f.name}`" for f in commit.schema.fields if f.name != self.part_col)
        kept = ""
        if any(commit.folders.get(v) != folder for folder, files in commit.files.items() for held in files.values() for v in held):
            if not self.spark.catalog.tableExists(f"{own}_live"):
                live = f"{self.root}/catalog_live/c{commit.number:08d}-{uuid.uuid4().hex[:12]}"
                self.spark.createDataFrame(sorted((f, v) for v, f in commit.folders.items()), f"{_FOLDER} string, {_NAME} string").write.parquet(live)
                self.spark.sql(f"CREATE TABLE {own}_live USING parquet LOCATION {_sql_text(live)}")
            kept = (f" LEFT SEMI JOIN {own}_live AS l ON l.`{_NAME}` = coalesce(CAST(o.`{self.part_col}` AS STRING), '{NULL_FOLDER}')"
                    f" AND (l.`{_FOLDER}` = o.`{_FOLDER}`)")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {own} AS o{kept}")
        return name

    # Writing

    def with_part(self, df: DataFrame) -> DataFrame:
        out = df.withColumn(self.part_col, self.part_expr)
        if isinstance(out.schema[self.part_col].dataType, T.StringType):
            out = out.withColumn(self.part_col, F.coalesce(F.concat(F.lit("p"), F.col(self.part_col)), F.lit("null")))
        return out

    def overwrite_partitions(self, df: DataFrame, base: Commit | None = None, done: tuple[str, int] | None = None, parts: int | None = None) -> Commit:
        """Replace the partitions that ``df`` (with the partition column) has rows of; ``df`` may read this table.

        ``base``: the commit that ``df`` was made from (the newest one if not given). ``parts``: how many partitions it has, if known.
        """
        base = base or self.commit()
        schema, folders, files = self._write_folders(base, df, parts)
        return self._switch(base, schema, {**(base.folders if base else {}), **folders}, files, done)

    def replace(self, df: DataFrame, done: tuple[str, int] | None = None) -> Commit:
        """Replace the whole table with ``df``, which may read this table."""
        base = self.commit()
        schema, folders, files = self._write_folders(base, self.with_part(df))
        return self._switch(base, schema, folders, files, done)

    def write(self, df: DataFrame) -> Commit:
        """Load the table with ``df`` in place of what it holds."""
        return self.replace(df)

    def expire(self, keep_last: int = 1) -> list[int]:
        """Drop all but the newest ``keep_last`` commits and the folders that only they, or failed writes, have; returns the numbers dropped."""
        numbers = self.commits()
        kept = numbers[-max(1, keep_last):]
        used = {f.split("/")[1] for n in kept for f in self.commit(n).folders.values()}
        old = [n for n in numbers if n not in kept]
        for n in old:
            storage.delete(self.spark, f"{self.root}/commits/c{n:08d}")
        for path, _ in storage.list_dir(self.spark, f"{self.root}/data") + storage.list_dir(self.spark, f"{self.root}/manifests"):
            m = _MADE_FOR_RE.search(path.rstrip("/"))
            name = path.rstrip("/").rsplit("/", 1)[-1]
            # Folders for a number yet to come belong to a publish that is running.
            if m and kept and int(m.group(1)) <= kept[-1] and name not in used and (not name.endswith(".json") or int(m.group(1)) < kept[0]):
                storage.delete(self.spark, path)
        return old


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_partitions(spark: SparkSession, stage: DataFrame, table: PartitionedTable,
                       stage_key_rows: int | None = None, done: tuple[str, int] | None = None) -> list:
    """Publish ``stage`` into ``table`` by key, rewriting only touched partitions.

    1. the stage's partition values (at most the table's partition count) are
       collected; only files that hold those partitions are read;
    2. the touched partitions are upserted (anti join on the key) and written
       once, aside, with what is left of shared folders that are mostly replaced; one commit
       makes them the table's, and all other partitions stay as they are.

    Returns the touched partition values. ``done`` (a source and the number of its load, such as a stream's
    batch) is kept in the commit; a load that is already in the table is not published again.
    """
    part = table.part_col
    keys = list(table.keys)
    base = table.commit()
    if done and base and base.done.get(done[0], -1) >= done[1]:
        return []
    assert_unique_keys(stage, keys)
    staged = table.with_part(stage.dropna(subset=keys))
    values = staged.select(part, F.col(part).cast("string").alias("name")).distinct().collect()
    touched = sorted((r[0] for r in values), key=lambda v: (v is not None, v))
    if base is None:
        schema, folders, files = table._write_folders(None, staged, len(touched))
        table._switch(None, schema, folders, files, done)
        return touched
    if not touched:
        return []
    names = {NULL_FOLDER if r["name"] is None else r["name"] for r in values}
    names |= table.left_over(base, names)
    hit = table._folders(base, names)
    merged = upsert(hit, staged.select(*hit.columns), keys, stage_key_rows)
    table.overwrite_partitions(merged, base, done, len(names))
    return touched
