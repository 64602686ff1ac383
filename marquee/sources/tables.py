"""Stored tables: Parquet folders, one new version per overwrite, some of them in buckets of a key."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import TABLES


# Tables that are laid out and updated in buckets of a key.
KEYED = {"Rating": "uid", "RatingClicks": "uid"}


def bucket_of(key, buckets):
    """The number of a key's bucket, as a column."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class TableStore:
    """Named tables below ``root`` (any Hadoop file system).

    An overwrite writes a new version folder next to the old one. Readers take the newest
    version that carries Spark's ``_SUCCESS`` marker, so they never see a missing or a
    half-written table, and a job that dies leaves the previous version in place. With ``keep`` an
    overwrite leaves only that many versions; one more than readers may still be reading is safe.

    The tables of ``KEYED`` have a folder for each of ``buckets`` buckets of their key. ``update`` replaces the
    buckets it touches and nothing else; large tables with small updates want many buckets. Stores of
    one root need one number; a table laid out by another number is laid out anew by its next update.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int | None = None, buckets: int = 16):
        if keep is not None and keep < 1:
            raise ValueError("the newest version has to stay")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.buckets = buckets
        self.bucket = f"bucket_of_{buckets}"

    def _files(self, path):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, name):
        """Numbers of the complete versions of a table, ascending."""
        found = []
        for version in self.names(f"{self.root}/{name}"):
            marker, fs = self._files(f"{self.root}/{name}/{version}/_SUCCESS")
            if version.startswith("v") and fs.exists(marker):
                found.append(int(version[1:]))
        return sorted(found)

    def names(self, path):
        """Names in a folder; none if there is no such folder."""
        folder, fs = self._files(path)
        return [e.getPath().getName() for e in fs.listStatus(folder)] if fs.exists(folder) else []

    def path(self, name, version=None):
        known = self.versions(name)
        if not known:
            raise FileNotFoundError(f"no table {name} below {self.root}")
        return f"{self.root}/{name}/v{version or known[-1]:08d}"

    def exists(self, name) -> bool:
        return bool(self.versions(name))

    def read(self, name, schema=None, buckets=None) -> DataFrame:
        """A table; with ``buckets`` only the files of those, where it is laid out by them."""
        rows = self.spark.read.schema(schema or TABLES[name]).parquet(self.path(name))
        if buckets is not None and self.bucket in rows.columns:
            rows = rows.filter(F.col(self.bucket).isin(buckets))
        return rows.drop(*[c for c in rows.columns if c.startswith("bucket_of_")])

    def remove(self, path):
        folder, fs = self._files(path)
        fs.delete(folder, True)

    def overwrite(self, name, df: DataFrame, partition_by=(), version=None) -> DataFrame:
        """Replace a table and return it as read back; columns follow the fixed schema.

        ``version`` numbers the new version, else it is the next one.
        """
        known = self.versions(name)
        version = version or (known[-1] if known else 0) + 1
        target = f"{self.root}/{name}/v{version:08d}"
        schema = TABLES.get(name, df.schema)
        fixed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if name in KEYED:
            # A bucket of any size is split over tasks.
            fixed = fixed.withColumn(self.bucket, bucket_of(KEYED[name], self.buckets)).hint("rebalance", self.bucket)
            partition_by = (self.bucket,)
        # A folder without the marker is what a dead writer left; "overwrite" replaces it.
        fixed.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
        if self.keep is not None:
            for old in sorted({*known, version})[: -self.keep]:
                self.remove(f"{self.root}/{name}/v{old:08d}")
        stored = self.spark.read.schema(schema).parquet(target)
        return stored.drop(self.bucket) if name in KEYED else stored

    def update(self, name, keys: DataFrame, change) -> DataFrame:
        """Replaces the buckets of ``keys`` by ``change(their rows)`` and returns the whole table.

        ``change`` gets all rows of the touched buckets and may only alter rows of ``keys``; a bucket that
        it leaves without a row stays as it was. The files of all other buckets keep their place. The new
        buckets are staged as a complete table before Spark's dynamic partition overwrite takes them over,
        and an update that died in between is finished by the next call, or by ``finish``. A reader that had listed
        files of a replaced bucket has to read again. Updates of a table follow one another, like overwrites.
        """
        if not self.exists(name):
            self.overwrite(name, self.spark.createDataFrame([], TABLES[name]))
        self.finish(name)
        folders = [f for f in self.names(self.path(name)) if "=" in f]
        if any(not f.startswith(f"{self.bucket}=") for f in folders) or not folders and not self.read(name).isEmpty():
            self.overwrite(name, self.read(name))
        key = F.col(KEYED[name]).cast(TABLES[name][KEYED[name]].dataType)
        # At most ``buckets`` numbers.
        touched = [r.bucket for r in keys.select(bucket_of(key, self.buckets).alias("bucket")).distinct().collect()]
        if not touched:
            return self.read(name)
        rows = change(self.read(name, buckets=touched)).select(*TABLES[name].names)
        rows = rows.withColumn(self.bucket, bucket_of(key, self.buckets)).hint("rebalance", self.bucket)
        # The staged version carries the number of the version that it belongs to.
        self.overwrite(f"{name}Staged", rows, (self.bucket,), self.versions(name)[-1])
        self.finish(name)
        return self.read(name)

    def finish(self, name):
        """Takes over staged buckets, if there are any; doing it twice changes nothing."""
        staged, current = self.versions(f"{name}Staged"), self.versions(name)[-1]
        if current in staged:
            rows = self.spark.read.schema(TABLES[name]).parquet(self.path(f"{name}Staged", current))
            if self.bucket in rows.columns:  # without any row there are no buckets
                target = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                target.partitionBy(self.bucket).parquet(self.path(name, current))
        if staged:
            self.remove(f"{self.root}/{name}Staged")


def search_documents(movies: DataFrame) -> DataFrame:
    """One document per mid: of several rows for a mid the greatest is kept whole."""
    rest = [c for c in movies.columns if c != "mid"]
    return movies.groupBy("mid").agg(F.max(F.struct(*rest)).alias("d")).select("mid", "d.*")
