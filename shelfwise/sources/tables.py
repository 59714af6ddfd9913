"""Source relations as lazily planned DataFrames.

``load_sources`` gives the normalised source schema for a folder of driver
test tables (through the shared adapter SQL); ``read_parquet_sources`` and
``read_jdbc_table`` are the production readers for a landing zone or a live
source database.  Nothing here iterates rows: every relation is a plan.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfwise.functions.plan import estimated_bytes
from shelfwise.plans import storage
from shelfwise.session import checkpoint_dir, save, scratch_path, written, written_in_turn
from shelfwise.sources import adapter


#: Relations of distinct codes, and the estimated bytes from which they are written.
LOOKUPS = ("language_property", "item_status_property", "itype_property", "physical_format_name", "bib_level_property",
           "material_property")
LOOKUP_BYTES = 1 << 20


def read_driver_tables(spark: SparkSession, sf_dir: str,
                       names=adapter.DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")) for n in names}


def adapt(spark: SparkSession, driver: dict[str, DataFrame], forms: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Build every adapter relation in order; each sees the earlier ones.

    ``forms`` maps parts of the adapter's text to what stands in their place.
    """
    frames: dict[str, DataFrame] = dict(driver)
    for name, text in adapter.RELATIONS:
        deps = {d: frames[d] for d in adapter.dependencies(text)}
        for part, form in (forms or {}).items():
            text = text.replace(part, form)
        frames[name] = spark.sql(text, **deps)
        # A few codes found in a large table: their own size is what tells the planner to broadcast them.
        if name in LOOKUPS and (estimated_bytes(frames[name]) or 0) > LOOKUP_BYTES:
            frames[name] = written(frames[name])
    return frames


def check_item_numbers(lineitem: DataFrame) -> None:
    """Raise unless the keys fit the bits that the adapter's item numbers give them."""
    top = lineitem.agg(*[F.max(c).alias(c) for c in adapter.ITEM_KEY_LIMITS]).first().asDict()
    over = {c: v for c, v in top.items() if v is not None and v >= adapter.ITEM_KEY_LIMITS[c]}
    if over:
        raise ValueError(f"test tables too large for the adapter's item numbers: {over}")


ITEM_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_TOP = (1 << 63) - 1


def _packs_apart(lineitem: DataFrame, tops: dict[str, int]) -> bool:
    """Whether no two items have one packed number, though keys, at most ``tops``, exceed their bits.

    A number and the item's line, part and supplier, here one mixed-radix integer, determine the order.
    """
    line, part, supplier = (tops[c] + 1 for c in ITEM_KEYS[1:])
    if line * part * supplier > _TOP:
        return False
    numbers = lineitem.dropna(subset=list(ITEM_KEYS)).select(
        F.expr(adapter.PACK).alias("n"), F.expr(f"(l_partkey * {supplier} + l_suppkey) * {line} + l_linenumber").alias("rest"))
    return numbers.groupBy("n").agg(F.min("rest").alias("low"), F.max("rest").alias("high")).filter("low < high").isEmpty()


#: Estimated bytes of lineitem, or of other item relations, to a slice, and the most slices.
SLICE_BYTES, SLICES = 16 << 20, 12


def slices_for(df: DataFrame) -> int:
    """In how many slices ``df`` is worked through, so that only one slice's shuffle files are on disk."""
    size = estimated_bytes(df)
    return SLICES if size is None else min(SLICES, max(1, -(-size // SLICE_BYTES)))


def _ranges_of(df: DataFrame, column: str, n: int) -> list[Column]:
    """Conditions that deal the rows of ``df`` into at most ``n`` ranges of ``column``, in ascending order."""
    if n == 1:
        return [F.lit(True)]
    ends = sorted({int(x) for x in df.approxQuantile(column, [k / n for k in range(1, n)], 0.25 / n)})
    c = F.col(column)
    if not ends:
        return [F.lit(True)]
    return [c < ends[0], *((c >= a) & (c < b) for a, b in zip(ends, ends[1:])), c >= ends[-1]]


def _ranked(rows: DataFrame, before: int) -> tuple[DataFrame, int, str]:
    """``rows`` with ``item_num``, the rank by their keys after ``before`` others, how many keys there are up
    to here, and the folder of the sorted rows."""
    spark = rows.sparkSession
    nth = F.row_number().over(Window.partitionBy(*ITEM_KEYS).orderBy(ITEM_KEYS[0]))
    # The window sorts each range of keys; the low 33 bits of the id are the place in the range, the others the range.
    folder = scratch_path(spark)
    placed = save(rows.repartitionByRange(*ITEM_KEYS).withColumn("_nth", nth)
                  .withColumn("_at", F.monotonically_increasing_id()), folder)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count_if(F.col("_nth") == 1).alias("size"), F.count_if(F.col("_nth") > 1).alias("more"))
    ends = sizes.orderBy("_part").collect()  # a row for each shuffle partition
    firsts, repeats = [], 0
    for r in ends:
        firsts.append((r["_part"], before))
        before, repeats = before + r["size"], repeats + r["more"]
    place = F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    if repeats:  # equal keys have one rank
        place = F.count_if(F.col("_nth") == 1).over(Window.partitionBy("_part").orderBy("_at"))
    starts = spark.createDataFrame(firsts, "_part long, _before long")
    numbered = placed.join(F.broadcast(starts), "_part").select(*rows.columns, (F.col("_before") + place).alias("item_num"))
    return numbered, before, folder


def ranked_items(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` with ``item_num``: the rank of an item by its keys, from 1; null where a key is null.

    Ranks come from the place in a range of the sorted keys and the sizes of the ranges before it, so they
    depend on the items alone.  The rows are sorted and written once, one range of orders after the other.
    """
    spark = lineitem.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        checkpoint_dir(spark)
    keyed = lineitem.dropna(subset=list(ITEM_KEYS))

    def parts() -> Iterator[DataFrame]:
        before = 0
        for here in _ranges_of(keyed, ITEM_KEYS[0], -(-slices_for(lineitem) // 4)):  # rows are sent once: larger ranges do
            part, before, folder = _ranked(keyed.filter(here), before)
            yield part
            storage.delete(spark, folder)
        lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ITEM_KEYS])
        yield lineitem.filter(lacking).withColumn("item_num", F.lit(None).cast("long"))

    return written_in_turn(parts())


def item_forms(lineitem: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``lineitem`` and the forms of ``adapt`` with which its items get numbers and ids of their own.

    Where keys fit their bits, and also where they do not but no numbers meet or overflow, the numbers are the
    adapter's; only message ids, which have more bits, then need another form.  Else items are ranked.
    """
    try:
        check_item_numbers(lineitem)
        return lineitem, {}
    except ValueError:
        pass
    ends = lineitem.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ITEM_KEYS for f in (F.min, F.max)]).first()
    tops = {c: int(ends[f"max_{c}"] or 0) for c in ITEM_KEYS}
    order, line, part, supplier = tops.values()
    top = ((order * 8 + line) * 262144 + part) * 16384 + supplier
    if min(int(ends[f"min_{c}"] or 0) for c in ITEM_KEYS) < 0 or top * 8 + 7 > _TOP or not _packs_apart(lineitem, tops):
        return ranked_items(lineitem), {adapter.PACK: "item_num"}
    return lineitem, {} if (top * 8 + 7) * 16 + 15 <= _TOP else {adapter.MESSAGE_ID: adapter.LOW_MESSAGE_ID}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source schema (record_metadata, item_record, hold, circ_trans, ...) for ``sf_dir``."""
    driver = read_driver_tables(spark, sf_dir)
    driver["lineitem"], forms = item_forms(driver["lineitem"])
    frames = adapt(spark, driver, forms)
    return {n: frames[n] for n in adapter.SOURCE_NAMES}


def read_parquet_sources(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    """Production landing zone: one parquet folder per source relation."""
    return {n: spark.read.parquet(os.path.join(root, n)) for n in names}


def read_jdbc_table(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int = 64,
                    fetch_size: int = 15000) -> DataFrame:
    """Whole-table source scan.

    Instead of keyset paging in one client loop, the id range is split into
    ``num_partitions`` parallel range scans; ``fetchsize`` is the server-side
    cursor chunk.  Filters applied to the result are pushed into each range
    query by Spark's JDBC source.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def pg_url(host: str, port: int, db: str, sslmode: str = "require") -> str:
    return f"jdbc:postgresql://{host}:{port}/{db}?sslmode={sslmode}"


BRANCH_LOCATIONS_SCHEMA = T.StructType([
    T.StructField("branch_location_name", T.StringType()),
    T.StructField("code_num", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("global_plus_code", T.StringType()),
])


def read_branch_locations_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV with a header row (branch coordinates)."""
    return (spark.read.schema(BRANCH_LOCATIONS_SCHEMA).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first ``n`` rows of a relation by key (sample builds).

    A top-k (TakeOrderedAndProject): every partition keeps its own n smallest,
    only those reach the final merge.
    """
    others = [F.col(f"`{f.name}`") for f in df.schema.fields
              if f.name != key and not isinstance(f.dataType, T.MapType)]
    return df.orderBy(F.col(key), *others).limit(n)
