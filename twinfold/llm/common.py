"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.session import stage_root

#: Pattern of a word: white space is the six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, also where another column differs from one only in case."""
    at = [df.columns.index(n) for n in names]
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, names)])


def with_kept(df: DataFrame, own: list[str], keep: tuple[str, ...]) -> DataFrame:
    """The columns ``own``, and those of ``keep`` as kept0, kept1, ...: no two names are alike."""
    at = df.columns.index
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    kept = [F.col(f"_{at(c)}").alias(f"kept{i}") for i, c in enumerate(keep)]
    return flat.select(*[F.col(f"_{at(c)}").alias(c) for c in own], *kept)


def kept_struct(keep: tuple[str, ...]) -> Column:
    """Struct of the kept columns."""
    return F.struct(*[F.col(f"kept{i}") for i in range(len(keep))] or [F.lit("").alias("none")])


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_by(df: DataFrame, key: str, name: str, n: int | None = None, dealt: bool = False) -> DataFrame:
    """Like ``stage``, dealt out by the hash of a key, so that later joins on it don't move these rows again.

    ``dealt`` rows lie in ``n`` such parts already. The catalog knows the table only until the frame is made.
    """
    spark = df.sparkSession
    n = n or parts(spark)
    made = f"{name}_{uuid.uuid4().hex}"
    (
        (df if dealt else df.repartition(n, key))
        .write.bucketBy(n, key)
        .option("path", new_path(spark, name))
        .option("compression", "zstd")
        .saveAsTable(made)
    )
    del df
    release(spark)
    made_of = spark.read.table(made)
    spark.sql(f"DROP TABLE {made}")
    return made_of


class Bytes:
    """The UTF-8 bytes of a string column as one array: text i is ``data[starts[i]:ends[i]]``; null is empty."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        if column.null_count:
            column = column.fill_null(b"")
        n = len(column)
        if n == 0:
            self.data, self.starts, self.ends = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
            return
        _, offsets, values = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
        whole = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.starts, self.ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes of byte windows modulo 2**64, each byte first replaced by a random number."""

    STEP = 1 << 19

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.of_byte = draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(draw.integers(1, 1 << 62)) * 2 + 1
        self.up = self.down = np.empty(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, self.STEP + 4096)

            def run(base: int) -> np.ndarray:
                x = np.full(n, np.uint64(base & (2**64 - 1)), np.uint64)
                x[0] = 1
                return np.cumprod(x, dtype=np.uint64)

            self.up, self.down = run(self.base), run(pow(self.base, -1, 2**64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the windows ``[start, end)`` of the array that ``sums`` came from."""
        return (sums[ends] - sums[starts]) * self.down[starts]

    def windows(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hashes of windows anywhere in a long array, worked off in steps of bounded size."""
        out = np.empty(len(starts), np.uint64)
        if not len(starts):
            return out
        order = np.argsort(starts, kind="stable")
        ordered = starts[order]
        longest = int(lengths.max())
        i = 0
        while i < len(order):
            first = int(ordered[i])
            j = int(np.searchsorted(ordered, first + self.STEP))
            which = order[i:j]
            sums = self.sums(data[first : first + self.STEP + longest])
            out[which] = self.between(sums, starts[which] - first, starts[which] - first + lengths[which])
            i = j
        return out

    def windows_between(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.windows(data, starts, ends - starts)


def batches(rows: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``size`` bytes each.

    What a batch took goes back to the system after it. Else each worker, idle ones too, holds the most it ever had.
    """
    for batch in rows:
        n = batch.num_rows
        step = n if batch.nbytes <= size else max(1, n * size // batch.nbytes)
        for i in range(0, n, max(1, step)):
            yield batch.slice(i, step)
        del batch
        pa.default_memory_pool().release_unused()


def numbered(df: DataFrame, *order) -> DataFrame:
    """Add ``number``: 0, 1, ... in an order over all rows, without moving them to one task."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    rows = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.expr("sum(_n) over (order by _part rows between unbounded preceding and 1 preceding)")
    starts = sizes.select(F.col("_part"), F.coalesce(before, F.lit(0)).alias("_before"))  # a row for each partition
    at = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    joined = rows.withColumn("_part", part).join(starts, "_part")
    return joined.withColumn("number", at).drop("_part", "_before", "_at")
