"""Keyed tables: merges as plans, and versioned publication of their results.

Merges are pure DataFrame functions. Writing goes to a new version directory and a one-row pointer is moved afterwards, so
a reader sees the old table or the new one and no plan reads what it overwrites.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from math import prod
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.operators import digests
from lanewright.operators.quality import QualityError


def union_ragged(batches: list[DataFrame]) -> DataFrame:
    """Batches with unlike columns as one; what a batch lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def upsert(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows replace the batch's columns of rows with their key and are added otherwise; other columns keep old values."""
    fields = [c for c in state.columns if c not in keys] + [c for c in batch.columns if c not in state.columns]
    s = state.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in state.columns if c not in keys], F.lit(True).alias("_s"))
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in batch.columns if c not in keys], F.lit(True).alias("_b"))
    j = s.join(b, keys, "full_outer")

    def value(c: str):
        old = F.col(f"_s_{c}") if c in state.columns else F.lit(None)
        return F.when(F.col("_b"), F.col(f"_b_{c}")).otherwise(old).alias(c) if c in batch.columns else old.alias(c)

    return j.select(*keys, *[value(c) for c in fields])


def insert_absent(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    return state.unionByName(batch.join(state.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def keep_valid(state: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """Rows whose key is valid. An empty valid set is refused: it would empty the table."""
    if valid.isEmpty():
        raise QualityError("the set of valid keys is empty")
    return state.join(valid.select(key).distinct(), key, "left_semi")


def stale_report(state: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """One row: valid_count, stale_keys, deleted_rows."""
    v = valid.select(key).distinct()
    stale = state.join(v, key, "left_anti")
    return v.agg(F.count("*").alias("valid_count")).crossJoin(stale.agg(F.count_distinct(key).alias("stale_keys"), F.count("*").alias("deleted_rows")))


def replacement(batch: DataFrame) -> DataFrame:
    """A snapshot that replaces a table; an empty one is refused."""
    if batch.isEmpty():
        raise QualityError("an empty snapshot would empty the table")
    return batch


def lookup(left: DataFrame, table: DataFrame, keys: list[str], column: str, default) -> DataFrame:
    """A column of a keyed table, or the default where the key is absent or the value null."""
    t = table.select(*keys, F.col(column).alias("_v"))
    return left.join(t, keys, "left").withColumn(column, F.coalesce("_v", F.lit(default))).drop("_v")


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, by: str = "date", dynamic: bool = False) -> None:
    """Partitioned write; ``dynamic`` replaces only the partitions that ``df`` has."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(by).parquet(path)


class Cube(NamedTuple):
    """A column ``value`` with one value for each combination of the axes' labels: a list in row-major order."""

    value: str
    axes: dict[str, list]

    def cells(self) -> int:
        return prod(len(labels) for labels in self.axes.values())

    def strides(self) -> list[tuple[str, list, int]]:
        """(axis, labels, cells from a label to the next)."""
        sizes = [len(labels) for labels in self.axes.values()]
        return [(name, labels, prod(sizes[i + 1 :])) for i, (name, labels) in enumerate(self.axes.items())]


def packed(df: DataFrame, cube: Cube) -> DataFrame:
    """A row for each combination of the columns beside the cube's, with its values as a list.

    The list is null where it would not be right: where a cell is absent or comes twice, or a label is none of its axis.
    """
    keys = [c for c in df.columns if c != cube.value and c not in cube.axes]
    pos = reduce(lambda a, b: a + b, [F.nullif(F.array_position(F.lit(labels), F.col(c)), F.lit(0)) * n - n for c, labels, n in cube.strides()])
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos.cast("int").alias("pos"), F.col(cube.value).alias("v")))).alias("_l"))
    whole = F.col("_l.pos") == F.sequence(F.lit(0), F.lit(cube.cells() - 1))
    return g.select(*keys, F.when(whole, F.col("_l.v")).alias(cube.value))


def unpacked(df: DataFrame, cube: Cube) -> DataFrame:
    """The rows of packed ones; a null list has none."""
    keys = [c for c in df.columns if c != cube.value]
    of_cell = lambda labels, n: F.lit([labels[i // n % len(labels)] for i in range(cube.cells())])
    labels = [F.get(of_cell(labels, n), F.col("_pos")).alias(c) for c, labels, n in cube.strides()]
    return df.select(*keys, F.posexplode(cube.value).alias("_pos", cube.value)).select(*keys, *labels, cube.value)


#: A labelled column of more values is refused: its labels stand in the pointer.
MOST_LABELS = 10_000


class Lists(NamedTuple):
    """A key's rows as parallel lists, one a column. Columns with ``labels`` {column: (type, values)} hold places in these."""

    key: str
    labels: dict[str, tuple[str, list]]


def _labels(kind: str, values: list) -> Column:
    return F.array(*[F.lit(x).cast(kind) for x in values]).cast(f"array<{kind}>")


def in_lists(df: DataFrame, key: str, labels: dict[str, list]) -> tuple[DataFrame, Lists]:
    """Rows as lists. ``labels`` are values that come first among a column's labels; others that it has follow."""
    kinds, found = dict(df.dtypes), {}
    for c, known in labels.items():
        if c not in kinds:
            continue
        rest = df.select(F.col(c).cast("string").alias(c)).filter(F.col(c).isNotNull() & ~F.col(c).isin(known)).distinct().limit(MOST_LABELS + 1).collect()
        if len(rest) > MOST_LABELS:
            raise QualityError(f"{c} has too many values for labels")
        found[c] = (kinds[c], [*known, *sorted(r[0] for r in rest)])
    place = lambda c: (F.array_position(_labels(*found[c]), F.col(c)) - 1).cast("smallint").alias(c)
    columns = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.collect_list(F.struct(*[place(c) if c in found else F.col(c) for c in columns])).alias("_l"))
    return g.select(key, *[F.col(f"_l.{c}").alias(c) for c in columns]), Lists(key, found)


def of_lists(df: DataFrame, lists: Lists) -> DataFrame:
    """The rows of lists."""
    columns = [c for c in df.columns if c != lists.key]
    rows = df.select(lists.key, F.inline(F.arrays_zip(*columns)))
    return rows.select(lists.key, *[F.get(_labels(*lists.labels[c]), F.col(c)).alias(c) if c in lists.labels else c for c in columns])


def _pointer(path: str) -> str:
    return f"{path}/current"


def _published(spark: SparkSession, path: str) -> DataFrame | None:
    """(version, n, at, cube) of the publications, or None before the first."""
    try:
        return spark.read.schema("version string, n long, at timestamp, cube string").parquet(_pointer(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The published version of a table, or None before the first."""
    table, layout = _newest(spark, path)
    return table if layout is None else of_lists(table, layout) if isinstance(layout, Lists) else unpacked(table, layout)


def _newest(spark: SparkSession, path: str) -> tuple[DataFrame | None, Cube | Lists | None]:
    """The published version as it lies, and how it is packed."""
    pointers = _published(spark, path)
    row = None if pointers is None else pointers.orderBy(F.desc_nulls_last("n"), F.desc("at")).first()
    if row is None:
        return None, None
    layout = json.loads(row.cube) if row.cube else None
    layout = layout and (Lists(**layout) if isinstance(layout, dict) else Cube(*layout))
    return spark.read.parquet(f"{path}/versions/{row.version}"), layout


def current_lists(spark: SparkSession, path: str, key: str, labels: dict[str, list]) -> tuple[DataFrame | None, Lists | None]:
    """The published version as ``in_lists`` has it, read as it lies if it was published so; (None, None) before the first."""
    table, layout = _newest(spark, path)
    if table is None:
        return None, None
    if isinstance(layout, Lists) and layout.key == key and all(layout.labels.get(c, ("", []))[1][: len(known)] == known for c, known in labels.items() if c in table.columns):
        return table, layout
    return in_lists(current(spark, path), key, labels)


def _point_to(spark: SparkSession, path: str, version: str, layout: Cube | Lists | None = None) -> None:
    pointers = _published(spark, path)
    n = 0 if pointers is None else pointers.agg(F.coalesce(F.max("n"), F.lit(-1)) + 1).first()[0]
    said = json.dumps(layout._asdict() if isinstance(layout, Lists) else layout) if layout else None
    spark.range(1).select(F.lit(version).alias("version"), F.lit(n).cast("long").alias("n"), F.current_timestamp().alias("at"), F.lit(said).cast("string").alias("cube")).coalesce(1).write.mode("append").parquet(_pointer(path))


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None, partitions: int | None = None, cube: Cube | Lists | None = None) -> str:
    """Write a version, check what was written, then point to it; a version that fails the check is never pointed to.

    Packed rows are written and checked as such; with their ``cube`` or lists, ``current`` gives them back as single rows.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    at = f"{path}/versions/{version}"
    (df.repartition(partitions) if partitions else df).write.parquet(at)
    if check is not None:
        check(spark.read.parquet(at))
    _point_to(spark, path, version, cube)
    return version


def _manifest(df: DataFrame, part: Column, columns: list[str]) -> DataFrame:
    d = df.select(part.alias("part"), digests.row_digest(columns).alias("d"))
    return d.groupBy("part").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("d")).alias("mix"), F.sum(F.conv(F.substring("d", 1, 15), 16, 10).cast("decimal(20,0)")).alias("total"))


def stage_parts(df: DataFrame, path: str, parts: int, keys: list[str]) -> str:
    """Load a table as ``parts`` parts side by side, each into a folder of its own, with a manifest of their rows and digests.

    The manifest is made from ``df``, so pass a materialised or repeatable one. Nothing is seen before ``commit_parts``.
    """
    version = uuid.uuid4().hex
    part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")
    _manifest(df, part, sorted(df.columns)).coalesce(1).write.parquet(f"{path}/manifests/{version}")
    df.withColumn("part", part).repartition(parts, "part").write.partitionBy("part").parquet(f"{path}/versions/{version}")
    return version


def commit_parts(spark: SparkSession, path: str, version: str, keep: int = 2) -> None:
    """Point to a staged version if every part is there as its manifest has it; then remove all but the newest ``keep`` versions."""
    want = spark.read.parquet(f"{path}/manifests/{version}")
    staged = spark.read.parquet(f"{path}/versions/{version}")
    have = _manifest(staged, F.col("part"), sorted(c for c in staged.columns if c != "part"))
    off = want.unionByName(have).groupBy("part", "rows", "mix", "total").count().filter("count <> 2").select("part").distinct()
    if bad := sorted(r.part for r in off.limit(20).collect()):
        raise QualityError(f"parts {bad} are not as they were staged")
    _point_to(spark, path, version)
    drop_old(spark, path, keep)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of all versions, published or not."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove versions that are neither among the newest ``keep`` publications nor staged after the last; what went."""
    if keep < 1:
        raise ValueError("the published version must be kept")
    rows = _published(spark, path).orderBy(F.desc_nulls_last("n"), F.desc("at")).collect()  # one row a publication
    kept, last = {r.version for r in rows[:keep]}, rows[0].at.timestamp() * 1000
    gone = []
    for v in versions(spark, path):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{v}")
        if v not in kept and p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime() <= last:
            remove(spark, f"{path}/versions/{v}")
            remove(spark, f"{path}/manifests/{v}")
            gone.append(v)
    return gone


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """A batch as a folder of its own under its number. Written again it replaces itself, so a retry doubles nothing."""
    df.write.mode("overwrite").parquet(f"{path}/batch={int(batch)}")


def batches(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of a table of batches, with their ``batch`` number; None before the first. Only finished folders count."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS"))
    done = [] if found is None else [f.getPath().getParent().toString() for f in found]
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*done) if done else None


def batches_before(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    rows = batches(spark, path)
    return None if rows is None else rows.filter(F.col("batch") < batch)


def newest_of_batches(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Each key's row of its last batch."""
    rows = batches(spark, path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a staging folder through Hadoop's file system, wherever it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_state(spark: SparkSession, path: str, **fields: str) -> None:
    spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} string" for k in fields)).coalesce(1).write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str) -> dict:
    """The control row; empty where it is absent or its file can't be read, which makes the work be done again."""
    try:
        row = spark.read.parquet(path).first()
    except (AnalysisException, SparkRuntimeException, Py4JJavaError):
        return {}
    return row.asDict() if row else {}


def publish_needed(state: dict, **now: str) -> bool:
    return state.get("status") != "published" or any(state.get(k) != v for k, v in now.items())


def same_plan(planned: dict, found: dict) -> None:
    if off := {k for k in planned if planned[k] != found.get(k)}:
        raise QualityError(f"the inputs changed after planning: {sorted(off)}")


def staleness(computed: DataFrame, published: DataFrame, column: str, limit: int = 3) -> DataFrame:
    """One row: days from the newest published to the newest computed date, and whether that is too many."""
    c, p = computed.agg(F.max(column).alias("computed")), published.agg(F.max(column).alias("published"))
    return c.crossJoin(p).select("computed", "published", F.datediff("computed", "published").alias("lag_days"), F.coalesce(F.datediff("computed", "published") > limit, F.lit(True)).alias("stale"))


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is costly to build: read where it was published before, else built and published."""
    table = current(spark, path)
    if table is None:
        publish(build(), path)
        table = current(spark, path)
    return table


def export_json(df: DataFrame, path: str) -> None:
    """A snapshot for readers without Parquet; maps become objects."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)
