"""Tables kept as versions, so that readers never find nothing and an earlier version can be taken back.

Every write fills a new folder below the table's path. A version becomes current by one empty file in the table's log,
named by a rising number and the folder: creating it is one step on any storage, and nothing is renamed. Readers take
the folder that the last entry names. A folder goes once ``keep`` newer versions have been written and it has been out
of date for ``grace`` seconds, so a scan that has begun is not disturbed by later writes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.sources.replace import file_system, qualified, remove_directory

KEPT = 2
GRACE = 3600.0
_LOG = "_log"


def _entry(make, path: str, number: int, folder: str):
    return make(f"{path}/{_LOG}/{number:012d}.{folder}")


def _entries(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The log, oldest first: number and folder of each version that can still be read."""
    files, make = file_system(spark, path)
    log = make(f"{path}/{_LOG}")
    if not files.exists(log):
        return []
    names = sorted(status.getPath().getName() for status in files.listStatus(log))
    return [(int(number), folder) for number, _, folder in (name.partition(".") for name in names)]


def _commit(spark: SparkSession, path: str, folder: str, keep: int, grace: float) -> int:
    """Make the folder the current version, and remove those that ``keep`` newer ones replaced ``grace`` seconds ago."""
    files, make = file_system(spark, path)
    entries = _entries(spark, path)
    number = entries[-1][0] + 1 if entries else 1
    files.create(_entry(make, path, number, folder), False).close()
    entries.append((number, folder))

    def written_at(entry: tuple[int, str]) -> int:
        return files.getFileStatus(_entry(make, path, *entry)).getModificationTime()

    now, newer = written_at(entries[-1]), {folder}
    kept = [entries[-1]]
    for entry, after in zip(entries[-2::-1], entries[:0:-1]):
        if entry[1] in newer or len(newer) < keep or now - written_at(after) < 1000 * grace:
            newer.add(entry[1])
            kept.append(entry)
    for entry in entries:
        if entry not in kept:
            files.delete(_entry(make, path, *entry), False)
            if entry[1] not in newer:
                files.delete(make(f"{path}/{entry[1]}"), True)
    return number


class NewVersion:
    """A folder to be filled, which ``commit`` makes current and ``discard`` removes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path)
        self.folder = f"v-{uuid.uuid4().hex}"
        self.location = f"{self.path}/{self.folder}"

    def commit(self, keep: int = KEPT, grace: float = GRACE) -> int:
        return _commit(self.spark, self.path, self.folder, keep, grace)

    def discard(self) -> None:
        remove_directory(self.spark, self.location)


def write_version(df: DataFrame, path: str, *, keep: int = KEPT, grace: float = GRACE) -> int:
    """Write the rows as the table's next version and return their number. A failed write changes nothing.

    ``keep`` versions, the new one included, stay readable, and any that was current in the last ``grace`` seconds. Of two writers at the same time the one with the later log
    entry wins; neither disturbs the other's files.
    """
    if keep < 1:
        raise ValueError("the version that is written has to be kept")
    version = NewVersion(df.sparkSession, path)
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(version.location)
    except BaseException:
        version.discard()
        raise
    version.commit(keep, grace)
    return seen.get["rows"]


def has_versions(spark: SparkSession, path: str) -> bool:
    return bool(_entries(spark, qualified(spark, path)))


def current_location(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    path = qualified(spark, path)
    entries = _entries(spark, path)
    if not entries:
        raise FileNotFoundError(f"{path} has no version")
    return f"{path}/{entries[-1][1]}"


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of one that is still kept, by its number."""
    path = qualified(spark, path)
    if version is None:
        return spark.read.parquet(current_location(spark, path))
    folders = [folder for number, folder in _entries(spark, path) if number == version]
    if not folders:
        raise FileNotFoundError(f"{path} has no version {version}")
    return spark.read.parquet(f"{path}/{folders[-1]}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return [number for number, _ in _entries(spark, qualified(spark, path))]


def take_back(spark: SparkSession, path: str) -> int:
    """Make the version before the current one current again, under a new number, which is returned."""
    path = qualified(spark, path)
    entries = _entries(spark, path)
    earlier = [folder for _, folder in entries if folder != entries[-1][1]]
    if not earlier:
        raise ValueError(f"{path} has no earlier version")
    return _commit(spark, path, earlier[-1], len(entries), GRACE)
