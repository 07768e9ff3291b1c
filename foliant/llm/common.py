"""What the operators of this subpackage share: tables, shared storage and words."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship

#: White space of the contracts, as a Java and Python regular expression class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of a data folder; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a session that runs in one process (master ``local``) gets a folder
    of its machine; any other session is refused, as its executors couldn't read each
    other's tables.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = getattr(shared_dir, "own", None)
        if not found:
            found = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="foliant-shared-")
            atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
    return found.rstrip("/")


def application_dir(spark: SparkSession) -> str:
    """Below the shared folder, the folder of this application's tables."""
    return f"{shared_dir(spark)}/foliant/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to a new folder of the application and reads it again.

    It cuts lineage: a lost executor costs its own running tasks, never what stands
    before this point. ``discard`` deletes one such table, ``clear`` all of them.
    """
    spark = df.sparkSession
    path = f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table of ``materialise`` that nothing reads any more, neither a pending result."""
    _delete(df.sparkSession, df.written_to)


def clear(spark: SparkSession) -> None:
    """Deletes all tables that operators of this application have written, once their results are used."""
    _delete(spark, application_dir(spark))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns, by position free names: ``only(df, doc_id='bigint', text='string')``.

    Further columns are left out, so names that clash with ours do no harm.
    """
    ship(df.sparkSession)
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the decimal text of ``doc_id``, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(folds), F.lit(0)).cast("int")


def slices(batches, rows: int = 512):
    """Batches in parts, so that few texts at a time are Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z in lower case.

    ``bytes.lower`` and ``bytes.split`` know exactly these letters and this white space.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Generations(dict):
    """A cache with a size bound: ``make`` fills it; the older half goes when it is full."""

    def __init__(self, make, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, key):
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


#: 64-bit hashes of words, kept by each Python worker.
WORD_HASHES = Generations(xxhash.xxh3_64_intdigest, 100_000)
