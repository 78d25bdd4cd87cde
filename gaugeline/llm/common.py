"""What several corpus operators need: written tables, row numbers, running totals, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.session import drop_folder, shared_folder

# The white space of the contracts, as characters of a pattern.
SPACE = r"\x20\x09-\x0D"
# Most rows of one integer that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
# Folders that ``written`` made, in order, until they are removed.
MADE: list[str] = []


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    MADE.append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing reads any more."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            drop_folder(table.sparkSession, folder)


def matching(table: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``table`` whose number is (``left_semi``) or is not (``left_anti``) in ``rows``, a written table of one column.

    ``table`` is not shuffled as long as the numbers, counted first, are few enough to be broadcast.
    """
    if rows.count() <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    return table.join(rows, rows.columns[0], how)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (columns differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a unique number per row in column ``name``.

    The numbers of an unwritten table may change when a lost task runs again, so the table is written once.
    """
    return written(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def parts_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one in its group, in ``order``.

    No group needs to fit a task. Rows are dealt by range of (group, order) and written with the
    number of their range; each range has one sum per group, and a window over these few sums (one row per
    range and group) says where each range starts. ``order`` should end with a column that is unique.
    The result reads a written table.
    """
    spark = df.sparkSession
    part, val = "_part_", "_value_"
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.withColumns({f"_o{i}_": k for i, k in enumerate(keys)} | {val: value.cast("bigint")})
    order_cols = [f"_o{i}_" for i in range(len(keys))]
    dealt = dealt.repartitionByRange(parts_for(spark), *by, *order_cols)
    dealt = written(dealt.withColumn(part, F.spark_partition_id()), "ranges")
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_b{i}_") for i, c in enumerate(by)]
    null = [F.col(c).isNull().alias(f"_n{i}_") for i, c in enumerate(by)]
    flat = [f"_b{i}_" for i in range(len(by))] + [f"_n{i}_" for i in range(len(by))]
    dealt = dealt.select("*", *group, *null)
    sums = dealt.groupBy(part, *flat).agg(F.sum(val).alias("_sum_"))
    before = Window.partitionBy(*flat).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(part, *flat, F.coalesce(F.sum("_sum_").over(before), F.lit(0)).alias("_start_"))
    inside = Window.partitionBy(part, *flat).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(starts, [part, *flat])
    total = F.col("_start_") + F.coalesce(F.sum(val).over(inside), F.lit(0))
    return out.withColumn(name, total).drop(part, val, "_start_", *flat, *order_cols)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, for links of two integer columns.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to its
    smallest one, then its smaller ones. Links shrink to stars in a logarithmic number of rounds. A
    hub's neighbours are never gathered: both steps are an aggregate and a join, which splits hot keys.
    """
    def stored(df: DataFrame) -> tuple[DataFrame, dict]:
        # Number of links and sums of two hashes of them, taken while they are written.
        seen = Observation()
        hashed = [F.sum(F.xxhash64(F.lit(salt), "u", "v").cast("decimal(38,0)")).alias(f"h{salt}") for salt in (1, 2)]
        return written(df.observe(seen, F.count(F.lit(1)).alias("n"), *hashed), "links"), seen.get

    edges, state = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct())
    while state["n"]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "links")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        small, after = stored(small.filter("u <> v").distinct())
        forget(edges, large)
        edges = small
        if after == state:
            break
        state = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select("root").distinct().select(F.col("root").alias("node"), "root")
    return stars.union(roots)
