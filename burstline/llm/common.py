"""Shared helpers: tables written once to the cluster's shared folder, sized joins, row ids, words."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.session import shared_folder

# A side is broadcast only if its rows were measured to take no more than this.
BROADCAST_BYTES = 32 * 1024 * 1024
PIECE_BYTES = 1 << 20
ARROW_ROWS, ARROW_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"

# A-Z to a-z, every byte outside words to a space: digits, letters and all bytes from 0x80 on are words.
LETTERS_AND_DIGITS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
# A-Z to a-z; the bytes 0x09-0x0D and 0x20 separate words.
NOT_BLANK = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters; none for null."""
    return text.translate(LETTERS_AND_DIGITS).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between blanks (space, tab, line ends); none for null."""
    return text.translate(NOT_BLANK).split() if text else []


def pieces_of(batches: Iterator[pa.RecordBatch], column: str = "_text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut to about ``most`` bytes of a text column each: what a task holds at once stays small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]]) if len(part) else [0, 0]
        for low, high in zip(starts[:-1], starts[1:]):
            yield batch.slice(int(low), int(high - low))


def with_text(docs: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, str]:
    """The kept columns and the text, not twice if it is kept, and the name it goes by."""
    columns = [F.col(f"`{c}`") for c in kept]
    if text in kept and docs.schema[text].dataType.simpleString() == "string":
        return docs.select(*columns), text
    return docs.select(*columns, F.col(f"`{text}`").cast("string").alias("_text")), "_text"


SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session ready: executors get this package once, and long texts reach Python in small batches."""
    if int(spark.conf.get(ARROW_CONF)) > ARROW_ROWS:
        spark.conf.set(ARROW_CONF, ARROW_ROWS)
    context = spark.sparkContext
    if context.applicationId not in SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="burstline-package-")) / "burstline_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        SHIPPED.add(context.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: later steps never recompute them."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """The rows, kept on the executors' disks for several uses. Whatever is lost is made again from written tables.

    For rows that come out the same each time, and do not depend on how rows are numbered or dealt out.
    """
    return df.persist(StorageLevel.DISK_ONLY)


def fits(df: DataFrame, width: int, limit: int | None = None) -> bool:
    """Whether the rows, ``width`` bytes each at most, may be broadcast: counted, never guessed."""
    return df.count() * width <= (BROADCAST_BYTES if limit is None else limit)


def hinted(df: DataFrame, width: int, limit: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it is small enough; else as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, width, limit) else df


def bounded_sample(df: DataFrame, key: Column, size: int) -> DataFrame:
    """About ``size`` rows, or all if they are fewer, by the hash of ``key``: the same rows each time, and no sort."""
    count = df.count()
    if count <= size:
        return df
    scale = 1 << 40
    return df.where(F.pmod(F.xxhash64(key), F.lit(scale)) < int(scale * size / count))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
