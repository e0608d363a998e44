"""Shards, partitioned example sets and shuffling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.names import cols, name_list
from gaugeline.operators.indexing import index_rows

#: Rows that a shuffle buffer holds.
SHUFFLE_BUFFER = 512


def row_shard(position: Column, shards: int) -> Column:
    """Row ``i`` belongs to worker ``i mod shards``."""
    return F.pmod(position, F.lit(shards)).cast("int")


def file_shards(files: DataFrame, shards: int, path: str = "path") -> DataFrame:
    """Add ``shard``: the ``i``-th file in name order belongs to worker ``i mod shards``."""
    return (
        index_rows(files, order=[path], name="__idx")
        .withColumn("shard", row_shard(F.col("__idx"), shards))
        .drop("__idx")
    )


def assign_file_shards(examples: DataFrame, files: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` to rows read with a ``file`` column.

    The file table has one row per file; Spark broadcasts it if its measured
    size allows and otherwise shuffles, splitting large files' rows if skewed.
    """
    numbered = file_shards(files.select(F.col("path").alias("file")), shards, "file")
    return examples.join(numbered, "file")


def gang_partitions(df: DataFrame, shards: int, shard: str = "shard") -> DataFrame:
    """Each of ``shards`` shards as one partition of its own, for tasks that run side by side."""
    return df.repartitionById(shards, F.col(shard))


def partitioned_dataset(df: DataFrame, partitions: int, cache: bool = True) -> DataFrame:
    """Rows spread evenly over ``partitions`` partitions and kept for reuse."""
    spread = df.repartition(partitions)
    return spread.persist(StorageLevel.MEMORY_AND_DISK) if cache else spread


def dataset_from_rows(
    spark: SparkSession, rows: Iterable, schema, partitions: int, cache: bool = True
) -> DataFrame:
    """A collection held by the driver as a partitioned, cached dataset."""
    return partitioned_dataset(spark.createDataFrame(rows, schema), partitions, cache)


def shuffle_rows(
    df: DataFrame, keys: str | Iterable[str], seed: int = 0
) -> DataFrame:
    """All rows in a random but repeatable order.

    The order is a hash of the row's key, not ``rand()``, so a task that is run
    again after a lost executor puts its rows in the same places.
    """
    keys = name_list(keys)
    return df.orderBy(F.xxhash64(F.lit(seed), *cols(keys)), *cols(keys))



def buffer_shuffle(df: DataFrame, buffer: int = SHUFFLE_BUFFER, seed: int = 0) -> DataFrame:
    """Rows shuffled on the way through, inside each partition: no sort, no exchange.

    A partition keeps ``buffer`` rows. Each further row takes the place of a row
    drawn from them, which goes out; what is left at the end goes out in random order.
    Draws depend on ``seed`` and the partition's number only, so a task that runs
    again gives the same order. Rows move by about ``buffer`` places, and never
    to another partition: for an order that is random throughout, see ``shuffle_rows``.
    """
    if buffer < 1:
        raise ValueError("a shuffle buffer holds at least one row")

    def mix(batches):
        import random

        import pyarrow as pa
        from pyspark import TaskContext

        draw = random.Random(f"{seed}-{TaskContext.get().partitionId()}")
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            both = new if held is None else pa.concat_tables([held, new])
            count = 0 if held is None else held.num_rows
            kept, out = list(range(count)), []
            for row in range(count, both.num_rows):
                if len(kept) < buffer:
                    kept.append(row)
                else:
                    place = draw.randrange(buffer)
                    out.append(kept[place])
                    kept[place] = row
            if out:
                yield from both.take(out).combine_chunks().to_batches()
            held = both.take(kept).combine_chunks()
        if held is not None:
            left = list(range(held.num_rows))
            draw.shuffle(left)
            yield from held.take(left).combine_chunks().to_batches()

    return df.mapInArrow(mix, df.schema)


def shuffled_places(df: DataFrame, key: str, seed: int = 0, name: str = "place") -> DataFrame:
    """Add each row's place in an order drawn from a hash of its key, without a global sort.

    The order is by MD5 of ``seed-key`` and then the key: the same in every run
    and in every engine that knows MD5.
    """
    drawn = df.withColumn("__draw", F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))))
    return index_rows(drawn, order=["__draw", key], name=name).drop("__draw")
