"""Files and folders of any store that Spark reads, by listing alone.

The driver's client of the store sees folders; where many files lie, tasks list them (``listing.py``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    size: int
    modified: datetime


def _system(spark: SparkSession, path: str):
    """(file system, path) of the store's own client."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def name_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def qualified(spark: SparkSession, path: str) -> str:
    """A folder as Spark prints it, with its store."""
    system, place = _system(spark, path)
    return system.makeQualified(place).toString().rstrip("/")


def matching(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths under a folder by a pattern such as ``date=*``, in order; names with a leading dot or underscore
    too. They cross over from the JVM at once, so the pattern should be one that folders match."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return []
    jvm = spark.sparkContext._jvm
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(place, pattern))
    if found is None or not len(found):
        return []
    # "Array(a, b)"; every path begins with the folder's, which tells them apart whatever names hold.
    text = jvm.scala.runtime.ScalaRunTime.stringOf(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
    below = qualified(spark, path) + "/"
    first, *rest = text[len("Array(") : -1].split(f", {below}")
    return sorted([first, *[below + p for p in rest]])


def entries(spark: SparkSession, path: str) -> Iterator[Entry]:
    """What lies directly in a folder, one after the other; nothing where there is no such folder."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return
    found = system.listStatusIterator(place)
    while found.hasNext():
        status = found.next()
        at = status.getPath().toString()
        yield Entry(at, name_of(at), status.isDirectory(), status.getLen(),
                    datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc))


def walk(spark: SparkSession, path: str) -> Iterator[Entry]:
    """Every file below a folder, hidden and empty ones too."""
    for entry in entries(spark, path):
        if entry.is_folder:
            yield from walk(spark, entry.path)
        else:
            yield entry


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, place = _system(spark, path)
    system.create(place).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    system, place = _system(spark, path)
    _, part = _system(spark, f"{path}.part")
    out = system.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(part, place):
        raise OSError(f"cannot write {path}")


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder to a place where there is none yet."""
    system, place = _system(spark, source)
    _, to = _system(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(place, to):
        raise OSError(f"cannot move {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    system, place = _system(spark, source)
    other, to = _system(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(
        system, place, other, to, False, True, spark.sparkContext._jsc.hadoopConfiguration())


def _day(text: str, form: str) -> date | None:
    try:
        return datetime.strptime(text, form).date()
    except ValueError:
        return None


def _holds_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder has a Parquet file; looks no further than the first."""
    return any(not e.is_folder and e.name.endswith(".parquet") for e in entries(spark, folder))


#: Layouts of dates: pattern of the folders, how many parts of the path make up the date, and its form.
_FOLDERS = (
    ("date=*", 1, "date=%Y-%m-%d"),
    ("[0-9][0-9][0-9][0-9]/[0-9][0-9]/[0-9][0-9]", 3, "%Y/%m/%d"),
)


def days_with_files(spark: SparkSession, path: str, known: Iterable[date] = ()) -> list[date]:
    """The days that have a Parquet file, also one without rows: ``date=2024-01-31/…``, ``2024/01/31/…`` or
    ``2024-01-31.parquet``. Other names are ignored.

    Folders are listed, of which there is one a day; ``known`` days are believed to have files, and into
    the others one look each is taken. So the work goes by days, however many files they hold.
    """
    known = set(known)
    days = {_day(name_of(p), "%Y-%m-%d.parquet") for p in matching(
        spark, path, "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9].parquet")}
    for pattern, parts, form in _FOLDERS:
        for folder in matching(spark, path, pattern):
            day = _day("/".join(folder.split("/")[-parts:]), form)
            if day is not None and (day in known or day in days or _holds_data(spark, folder)):
                days.add(day)
    return sorted(days - {None})
