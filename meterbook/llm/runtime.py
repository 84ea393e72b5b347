"""What the operators of this folder share: Arrow batch size, folds, tokenizer files."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Rows of one Arrow batch, and its bytes where Spark knows the setting: what a Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: Bytes of text for each shard of an operator that asks shards: what bounds a task, whatever the input.
SHARD_BYTES = 32 << 20
#: The class of white space of all operators here, as Java, Python and RE2 read it.
SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
TOKENIZER = "word_bpe_49k.json"


_CODE = "meterbook-code.zip"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package's source, once per application, through Spark's own file service."""
    context = spark.sparkContext
    if _CODE in context._python_includes:
        return
    root = Path(__file__).resolve().parents[1]
    # the driver serves the file as long as it runs; executors get copies of their own
    path = os.path.join(tempfile.mkdtemp(prefix="meterbook-"), _CODE)
    atexit.register(shutil.rmtree, os.path.dirname(path), ignore_errors=True)
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(path)


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python workers get, and see that they have the code."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The place of a public vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_shards(rows: DataFrame, text: str = "text") -> int:
    """Shards for all text of ``rows``, as many as there are shuffle partitions at least."""
    size = rows.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(parts(rows.sparkSession), -(-size // SHARD_BYTES))


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, longer where a column of the frame has one already."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_listed(docs: DataFrame, key: Column, marks: DataFrame) -> DataFrame:
    """One row of each key, and none of a key that ``marks`` (``key``, ``stays``) says does not stay; all columns of ``docs``.

    The documents are dealt once, by the key, whatever the number of marks; the first row of a key is then found in place.
    Keys are texts and never null.
    """
    own, other, stays, nth = unused(docs, "_key", "_marked_key", "_stays", "_nth")
    listed = marks.select(F.col("key").alias(other), F.col("stays").alias(stays)).hint("merge")
    joined = docs.withColumn(own, key).join(listed, F.col(own) == F.col(other), "left")
    first = F.row_number().over(Window.partitionBy(own).orderBy(own))
    kept = joined.where(F.coalesce(F.col(stays), F.lit(True))).withColumn(nth, first)
    return kept.where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
