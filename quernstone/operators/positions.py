"""Row numbers over a whole table or over huge groups, without a one-task window.

Rows are cut into buckets of bounded size whose order agrees with the wanted order. Counting the
buckets is a small aggregate; a running sum over the counts gives each bucket its offset; the only
window over the rows themselves runs within one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.session import scratch_path

BUCKET_WIDTH = 65_536


def _number(
    df: DataFrame, bucket: Column, order: Sequence[Column | str], group: Sequence[str], name: str
) -> DataFrame:
    rows = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
        .select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return (
        rows.join(offsets, keys)
        .withColumn(name, (F.col("_offset") + inside).cast("bigint"))
        .drop("_bucket", "_offset")
    )


def id_bucket(id_col: str, width: int = BUCKET_WIDTH) -> Column:
    """Range of ``width`` ids that an integer id falls into."""
    return F.expr(f"`{id_col}` DIV {width}")


def positions_by_id(
    df: DataFrame,
    id_col: str,
    group: Sequence[str] = (),
    name: str = "pos",
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """1-based position in ascending order of a unique integer id, per group or overall.

    A bucket is a range of ``width`` ids, so it never holds more than ``width`` rows, however many
    rows one group has. For ids with wide gaps pass a larger ``width``.
    """
    return _number(df, id_bucket(id_col, width), [id_col], group, name)


def shuffle_key(id_col: str, seed: int) -> Column:
    """Reproducible random order: a seeded hash of the id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _unhashable(kind: str) -> bool:
    return "map<" in kind or "variant" in kind


def positions_in_order(df: DataFrame, order: Sequence[str], name: str = "pos") -> tuple[DataFrame, int]:
    """1-based position in the order of any sortable columns, and the number of rows.

    Rows are cut into ranges of ``order`` by sampled bounds, so gaps in the values do no harm. The cut
    is written once, with each row's place in its range; one count per range (as many as shuffle
    partitions) gives the offsets. Nulls come first. Rows that agree in all of ``order`` follow by a hash
    of their other columns, which also lets the bounds cut a value that many rows share; only rows that
    are equal throughout stay in one range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [f.name for f in df.schema.fields if f.name not in order and not _unhashable(f.dataType.simpleString())]
    keys = [*order, *([F.xxhash64(*[F.col(f"`{c}`") for c in others])] if others else [])]
    placed = (
        df.repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    path = scratch_path(spark, "ranges")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    offsets, total = [], 0
    for part, n in sorted(rows.groupBy("_range").count().collect()):
        offsets.append((part, total))
        total += n
    known = F.broadcast(spark.createDataFrame(offsets, "_range int, _offset long"))
    return rows.join(known, "_range").withColumn(name, F.col("_offset") + F.col("_at") + 1).drop("_range", "_at", "_offset"), total
