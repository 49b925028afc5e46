"""Replace-writes that survive a killed job.

A table is first written whole beside its target.  Only then the old table is moved aside, the new one moved
in, and the old one removed: a job that dies while writing leaves the target untouched, and one that dies between
the two moves leaves both tables complete on disk.  ``recover``, called by every read and write of the
table, then puts the old one back.  Partitions can be replaced one by one in the same way: those that the
new rows touch are switched, the others stay.

Since nothing is removed before the new table is complete, a table may be replaced by a query that reads it.

A move is one rename of the file system: atomic on HDFS and local disks; object stores copy, and there the gap between
the moves lasts as long as the copy.  One writer per table is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

NEW, OLD = ".new-", ".old-"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _fs(spark, source)
    t = _fs(spark, target)[1]
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _beside(spark: SparkSession, target: str, mark: str) -> list[str]:
    """Folders that a writer of ``target`` left beside it."""
    fs, p = _fs(spark, target.rstrip("/"))
    name, parent = p.getName(), p.getParent()
    if not fs.exists(parent):
        return []
    found = [s.getPath() for s in fs.listStatus(parent)]
    return sorted(x.toString() for x in found if x.getName().startswith(name + mark))


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, as relative paths."""
    fs, p = _fs(spark, path)
    here = [("", p)]
    for _ in range(depth):
        here = [(f"{rel}/{s.getPath().getName()}".lstrip("/"), s.getPath())
                for rel, folder in here for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
    return [rel for rel, _ in here]


def recover(spark: SparkSession, target: str) -> None:
    """Undo a switch that was cut short: what was moved aside and not replaced goes back."""
    target = target.rstrip("/")
    for aside in _beside(spark, target, OLD):
        depth = _fs(spark, aside)[1].getName().rsplit("-", 1)[1]
        for part in _partitions(spark, aside + "/table", int(depth)) if exists(spark, aside + "/table") else []:
            place = f"{target}/{part}" if part else target
            if not exists(spark, place):
                move(spark, f"{aside}/table/{part}".rstrip("/"), place)
        remove(spark, aside)


def switch(spark: SparkSession, staged: str, target: str, partitions: int = 0) -> None:
    """Put the complete table ``staged`` in the place of ``target``, or with ``partitions`` (their depth) those of
    its partitions that ``staged`` holds."""
    target = target.rstrip("/")
    recover(spark, target)
    aside = f"{target}{OLD}{uuid.uuid4().hex}-{partitions}"
    for part in _partitions(spark, staged, partitions):
        place = f"{target}/{part}" if part else target
        if exists(spark, place):
            move(spark, place, f"{aside}/table/{part}".rstrip("/"))
        move(spark, f"{staged}/{part}".rstrip("/"), place)
    remove(spark, aside)
    if partitions:
        remove(spark, staged)


def replace_path(df: DataFrame, target: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                 only_partitions: bool = False) -> None:
    """Replace the table at a path by ``df``; with ``only_partitions`` only the partitions that ``df`` holds."""
    spark, target = df.sparkSession, target.rstrip("/")
    if only_partitions and not partition_by:
        raise ValueError("only_partitions needs partition_by")
    recover(spark, target)
    for left in _beside(spark, target, NEW):  # of a writer that died
        remove(spark, left)
    staged = f"{target}{NEW}{uuid.uuid4().hex}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    switch(spark, staged, target, len(partition_by) if only_partitions else 0)


# Catalog tables: the same with renames of the catalog.


def _tables_like(spark: SparkSession, name: str) -> list[str]:
    db, _, table = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {f'IN {db} ' if db else ''}LIKE '{table}__old_*'").collect()
    return sorted(f"{db}.{r.tableName}" if db else r.tableName for r in rows if not r.isTemporary)


def recover_table(spark: SparkSession, name: str) -> None:
    for aside in _tables_like(spark, name):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE IF EXISTS {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace a catalog table by ``df``."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, name)
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{name}__new_{mark}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_{mark}")
    spark.sql(f"ALTER TABLE {name}__new_{mark} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__old_{mark}")
