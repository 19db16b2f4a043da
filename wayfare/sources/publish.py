"""Monthly tables that change as a whole.

A release writes its months aside, below a folder of its own. Readers find months through the newest
manifest, a small file that names the folder of every table's months. Only the last step, putting one
more manifest in its place, shows a release: a run that dies before it, between two feeds or while it
deletes, leaves what readers see untouched. Manifests are numbered and never overwritten, so of two
releases at once one comes second and is worked into what the first left.
"""

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from wayfare.sources.sinks import write_new_months

MANIFESTS, DATA = "manifests", "data"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, root: str) -> list[int]:
    files, folder = _files(spark, f"{root}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[:1].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict[str, dict[str, str]]:
    """Table -> month (`2021-02`) -> release that holds it; of the newest version unless one is named."""
    known = _versions(spark, root)
    if not known:
        return {}
    version = known[-1] if version is None else version
    rows = spark.read.text(f"{root}/{MANIFESTS}/{version:08d}.json", wholetext=True)
    return json.loads(rows.first()["value"])


class Release:
    """Months of some tables, written aside until :meth:`commit`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.name = spark, root, uuid4().hex
        self.changes: dict[str, dict[str, str | None]] = {}

    def write_months(self, trips: DataFrame, table: str, months: list[tuple[int, int]]) -> int:
        """Writes the months of a table; returns their rows. A month without rows will be gone."""
        rows = write_new_months(trips, f"{self.root}/{DATA}/{self.name}/{table}", months)
        own = self.changes.setdefault(table, {})
        for (year, month), n in rows.items():
            own[f"{year}-{month:02d}"] = self.name if n else None
        return sum(rows.values())

    def commit(self) -> int:
        """Shows all that was written at once; returns the new version."""
        while True:
            version = (_versions(self.spark, self.root) or [0])[-1] + 1
            tables = manifest(self.spark, self.root)
            for table, months in self.changes.items():
                merged = tables.get(table, {}) | months
                tables[table] = {month: name for month, name in merged.items() if name}
            if self._put(version, json.dumps(tables, sort_keys=True)):
                return version

    def _put(self, version: int, text: str) -> bool:
        """Writes the manifest under another name and renames it; false if its number was taken."""
        files, ready = _files(self.spark, f"{self.root}/{MANIFESTS}/_{self.name}")
        out = files.create(ready, True)
        out.write(bytearray(text.encode()))
        out.close()
        _, place = _files(self.spark, f"{self.root}/{MANIFESTS}/{version:08d}.json")
        if not files.exists(place) and files.rename(ready, place):
            return True
        files.delete(ready, False)
        return False


def read_months(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """All months of a table as the newest (or a named) version has them, with ``year`` and ``month``.

    Months of one release are one scan.
    """
    releases: dict[str, list[str]] = {}
    for month, name in sorted(manifest(spark, root, version).get(table, {}).items()):
        releases.setdefault(name, []).append(month)
    if not releases:
        raise ValueError(f"no published months of {table!r} below {root}")
    scans = []
    for name, months in releases.items():
        base = f"{root}/{DATA}/{name}/{table}"
        paths = [f"{base}/year={m[:4]}/month={int(m[5:])}" for m in months]
        scans.append(spark.read.option("basePath", base).parquet(*paths))
    found = scans[0]
    for scan in scans[1:]:
        found = found.unionByName(scan)
    return found


def delete_unused(spark: SparkSession, root: str) -> list[str]:
    """Deletes releases that the newest manifest does not name, and older manifests; returns the releases.

    For when no reader of an older version and no other release is under way.
    """
    used = {name for months in manifest(spark, root).values() for name in months.values()}
    files, folder = _files(spark, f"{root}/{DATA}")
    gone = []
    if files.exists(folder):
        for status in files.listStatus(folder):
            if status.getPath().getName() not in used:
                gone.append(status.getPath().getName())
                files.delete(status.getPath(), True)
    for version in _versions(spark, root)[:-1]:
        files.delete(_files(spark, f"{root}/{MANIFESTS}/{version:08d}.json")[1], False)
    return gone
