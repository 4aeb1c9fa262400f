"""Tables of one folder that change together: written beside, put in place at the end.

Putting in place is renaming, which moves no data on a file system that has renames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_BESIDE = "_loading"
_SWITCH = "switch-"


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, at = _files(spark, old)
    to = _files(spark, new)[1]
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"cannot rename {old} to {new}")


def _remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def write_observed(
    df: DataFrame, path: str, metrics: Mapping[str, Column]
) -> dict[str, int]:
    """Write ``df`` as Parquet; what the writing tasks themselves measured (aggregates by name).

    The metrics belong to the last stage, whose tasks count once each, however often one is tried.
    """
    seen = Observation()
    df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()]).write.parquet(path)
    return seen.get


def switch_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    metrics: Mapping[str, Mapping[str, Column]] | None = None,
    check: Callable[[dict[str, dict[str, int]]], None] | None = None,
) -> dict[str, dict[str, int]]:
    """Write all ``tables`` beside ``folder``'s, then put them in the place of the old ones.

    ``metrics`` are measured while the tables are written, and ``check`` may refuse them by raising:
    nothing is put in place then. A switch that broke off while its tables were put in place is
    finished by ``resume_switch``.
    """
    spark = next(iter(tables.values())).sparkSession
    beside = f"{folder}/{_BESIDE}/{_SWITCH}{uuid4().hex}"
    found: dict[str, dict[str, int]] = {}
    for name, table in tables.items():
        measured = (metrics or {}).get(name)
        if measured:
            found[name] = write_observed(table, f"{beside}/new/{name}", measured)
        else:
            table.write.parquet(f"{beside}/new/{name}")
    if check:
        try:
            check(found)
        except Exception:
            _remove(spark, beside)
            raise
    _mark(spark, f"{beside}/whole")
    _put_in_place(spark, folder, beside, list(tables))
    return found


def _put_in_place(spark: SparkSession, folder: str, beside: str, names: Sequence[str]) -> None:
    """Put the new tables in place; done again it goes on where it stopped."""
    for name in names:
        if not _exists(spark, f"{beside}/new/{name}"):
            continue  # is in place already
        if _exists(spark, f"{folder}/{name}"):
            _rename(spark, f"{folder}/{name}", f"{beside}/old/{name}")
        _rename(spark, f"{beside}/new/{name}", f"{folder}/{name}")
    _remove(spark, beside)


def resume_switch(spark: SparkSession, folder: str, names: Sequence[str]) -> bool:
    """Finish a switch whose tables were all written but not all put in place; whether there was
    one. Readers call it first, so that they never see tables of two loads."""
    files, at = _files(spark, f"{folder}/{_BESIDE}")
    if not files.exists(at):
        return False
    resumed = False
    for status in files.listStatus(at):
        path = status.getPath()
        if path.getName().startswith(_SWITCH) and _exists(spark, f"{path}/whole"):
            _put_in_place(spark, folder, path.toString(), names)
            resumed = True
    return resumed


def _moved_in(spark: SparkSession, folder: str, names: Sequence[str], batch: str) -> None:
    """Move the files of a batch that is written whole; done again it goes on where it stopped."""
    beside = f"{folder}/{_BESIDE}/{batch}"
    for name in names:
        files, at = _files(spark, f"{beside}/{name}")
        if files.exists(at):
            parts = [s.getPath() for s in files.listStatus(at)]
            for part in sorted(parts, key=lambda p: p.getName()):
                if part.getName().startswith("part-"):
                    _rename(spark, part.toString(), f"{folder}/{name}/{part.getName()}")
    # The mark comes last: with it the batch is in, and its folder is of no more use.
    _mark(spark, f"{folder}/{_BESIDE}/done-{batch}")
    _remove(spark, beside)


def _mark(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.mkdirs(at.getParent())
    files.create(at, True).close()


def append_batch(tables: Mapping[str, DataFrame], folder: str, batch: str) -> None:
    """Write the rows to append beside ``folder``'s tables, then move their files in, in the order
    of ``tables``."""
    spark = next(iter(tables.values())).sparkSession
    beside = f"{folder}/{_BESIDE}/{batch}"
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{beside}/{name}")
    _mark(spark, f"{beside}/whole")
    _moved_in(spark, folder, list(tables), batch)


def resume_batch(spark: SparkSession, folder: str, names: Sequence[str], batch: str) -> bool:
    """Whether ``batch`` is in; one that was written whole but not moved in is finished."""
    if _exists(spark, f"{folder}/{_BESIDE}/done-{batch}"):
        return True
    if _exists(spark, f"{folder}/{_BESIDE}/{batch}/whole"):
        _moved_in(spark, folder, names, batch)
        return True
    return False
