"""Tables in folders: JSON lines, Parquet, and Delta where the session has it."""

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.operators.ranking import keep_first
from postmill.schema import bronze_columns, bronze_schema
from postmill.session import scratch_path

# Fixed format for writing: ISO-8601 with microseconds; the default keeps milliseconds only.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# The folder column that names a batch of bronze.
BATCH = "batch"

# Stored Parquet tables are mostly text, which this makes smaller than Spark's default does; scratch keeps the default.
STORED = {"compression": "zstd"}

# Rows of a file that share a bitmap, as a power of two, fixed by the size of Spark's bitmaps; and how many of these are broadcast.
BLOCK_BITS = 15
MOST_BITMAPS = 1 << 14


def records_to_bronze(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    """Records held by the caller as a bronze DataFrame; meant for small inputs."""
    return spark.createDataFrame(list(records), bronze_schema())


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**JSON_TIMES).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines under a stated schema (bronze unless given), so no pass to infer types.

    Times may be any ISO-8601 form, with or without a fraction and an offset.
    """
    return spark.read.schema(schema or bronze_schema()).json(path)


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table by path. With ``schema`` no file footer is read to find columns; without it
    the columns of all files are merged."""
    reader = spark.read.format(fmt)
    if schema is not None:
        return reader.schema(schema).load(path)
    return reader.option("mergeSchema", "true").load(path)


def read_bronze(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """All rows of bronze, whoever appended them, without the name of the batch."""
    return read_table(spark, path, schema, fmt).drop(BATCH)


def append_bronze(df: DataFrame, path: str, fmt: str = "parquet", batch: str | None = None) -> int:
    """Append a batch and return its row count. Extra columns are kept and merged on read.

    Parquet takes whatever it is given, so the bronze columns are checked first. Each batch is a folder of
    its own; a batch that is written again under its name replaces itself.
    """
    found = {f.name: f.dataType for f in df.schema}
    wrong = [f.name for f in bronze_schema() if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"bronze columns missing or of another type: {wrong}")
    extra = [c for c in df.columns if c not in bronze_columns()]
    rows = df.select(*bronze_columns(), *extra)
    return append_batch(rows, path, fmt, batch)


def append_batch(rows: DataFrame, path: str, fmt: str = "parquet", batch: str | None = None) -> int:
    """Append rows as a folder of their own, or in place of the batch of that name; returns how many."""
    if fmt == "delta":
        return _write(rows, path, "append", fmt, {"mergeSchema": "true"})
    return _write(rows, f"{path.rstrip('/')}/{BATCH}={batch or uuid.uuid4().hex}", "overwrite", fmt, {})


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    rebalance: bool = True,
    fmt: str = "parquet",
    sort_by: Sequence[Column] = (),
) -> int:
    """Replace a table and its schema; returns the rows written.

    A partitioned table is rebalanced by its key first: each task then writes few folders,
    and AQE cuts a hot key into several tasks and joins small ones. That is one more shuffle
    of whole rows. With few keys and large tasks, where each task's share of a key makes a
    good file, or where AQE is off and nothing would cut a hot key, ``rebalance=False`` saves it. Rows of a
    file are in the order of ``sort_by``, by which readers skip row groups and pages.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", F.col(partition_by))
    if sort_by:
        # A partitioned write sorts by its key in any case.
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    return _write(df, path, "overwrite", fmt, {"overwriteSchema": "true"}, partition_by)


def _write(
    df: DataFrame, path: str, mode: str, fmt: str, delta_options: dict[str, str], partition_by: str | None = None
) -> int:
    # The count rides along in the writing tasks instead of running the plan again.
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.options(**delta_options)
    if fmt == "parquet":
        writer = writer.options(**STORED)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)
    return rows.get["rows"]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: what is used more than once
    is computed once, and its file size tells the optimizer what can be broadcast."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_places(table: DataFrame) -> DataFrame:
    """A table of Parquet files as it is read, with the file and the number of each row there."""
    return table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def rows_at(table: DataFrame, places: DataFrame, there: bool = True) -> DataFrame:
    """The rows of ``table`` (see ``with_places``) at ``places``, or all others; only places are shuffled, never a row.

    Places become bitmaps, each of a block of 32,768 rows of a file: one bit per row of the blocks that have any. They are broadcast up to
    64 MB, rows of half a billion; beyond, Spark chooses the join.
    """
    block, bit = (F.expr(f"shiftright(_row, {BLOCK_BITS})"), F.expr(f"_row & {(1 << BLOCK_BITS) - 1}"))
    blocks = places.select(F.col("_file").alias("_of_file"), block.alias("_block"), bit.alias("_bit")).repartition("_of_file", "_block")
    bitmaps = staged(blocks.groupBy("_of_file", "_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmaps")
    if bitmaps.count() <= MOST_BITMAPS:
        bitmaps = F.broadcast(bitmaps)
    met = table.join(bitmaps, (F.col("_file") == F.col("_of_file")) & (block == F.col("_block")), "inner" if there else "left")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")), F.lit(0)) == 1
    return met.filter(found if there else ~found).select(*table.columns)


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` replace or join those of ``target``; nothing else is removed.

    Null keys are one key. Of rows of the batch with the same key the first by its other columns is taken.
    """
    batch = keep_first(batch, [key], [F.asc(c) for c in batch.columns if c != key])
    keys = batch.select(F.col(key).alias("_key"))
    return target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(batch, allowMissingColumns=True)


def _any_of(conditions: list[Column]) -> Column:
    """Their disjunction, as a tree no deeper than it must be."""
    half = len(conditions) // 2
    return _any_of(conditions[:half]) | _any_of(conditions[half:]) if half else conditions[0]


def bloom_filter(column: str) -> dict[str, str]:
    """Writer options: a Parquet Bloom filter of a column in each row group, as large as its values need."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


class KeyedTable:
    """A table with a key that is written over in the places that a batch touches only.

    Rows are stored by a hash of their key, in ``parts`` folders. An upsert reads the folders of the batch's keys, merges, and
    writes these folders anew (dynamic partition overwrite); the other ones keep their files. How many parts there are is part of the
    layout, so it stays as it was when the table was made. Within a file rows are sorted by key, and files carry Bloom filters
    of it. A further ``partition_by`` column lies below; a folder whose last row moved elsewhere keeps a row that says so.

    There may be one writer at a time. Folders change one after the other: a reader that must not see half of a batch
    waits for the writer, and a batch that broke off is mended by running it again.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.parts = parts

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no rows are stored below {self.root}")
        return stored.filter("_live").drop("_live", "_of", "_part")

    def rows_of(self, keys: DataFrame, key: str) -> DataFrame:
        """The rows with the keys of a written table; only the folders these keys belong to are read."""
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no rows are stored below {self.root}")
        part = F.pmod(F.xxhash64(key), F.lit(stored.select("_of").first()[0])).cast("int")
        # At most as many as there are parts.
        touched = [r[0] for r in keys.select(part).distinct().collect()]
        near = stored.filter(F.col("_part").isin(touched) & F.col("_live")).drop("_live", "_of", "_part")
        wanted = keys.select(F.col(key).alias("_key")).distinct()
        return near.join(wanted, F.col(key).eqNullSafe(F.col("_key")), "left_semi")

    def lookup(self, keys: Sequence, key: str) -> DataFrame:
        """The rows of some keys held by the caller, without a join.

        The folders of the keys follow from their hashes; each key is then an equality that reaches the Parquet reader, which
        skips row groups by their range and Bloom filter, and pages by their range. A list of values would reach it as one range.
        """
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no rows are stored below {self.root}")
        if not keys:
            return stored.limit(0).drop("_live", "_of", "_part")
        kind, parts = stored.schema[key].dataType, stored.select("_of").first()[0]
        values = [F.lit(k).cast(kind) for k in dict.fromkeys(keys)]
        near = F.col("_part").isin(*(F.pmod(F.xxhash64(v), F.lit(parts)).cast("int") for v in values))
        return stored.filter(near & F.col("_live") & _any_of([F.col(key).eqNullSafe(v) for v in values])).drop("_live", "_of", "_part")

    def count(self) -> int:
        return self.read().count() if self.exists() else 0

    def _write(self, rows: DataFrame, key: str, partition_by: str | None, dynamic: bool) -> None:
        places = ["_of", "_part", *([partition_by] if partition_by else [])]
        sorted_ = rows.hint("rebalance", F.col("_part")).sortWithinPartitions(*places, key)
        writer = sorted_.write.mode("overwrite").partitionBy(*places).options(**bloom_filter(key))
        writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(self.root)

    def _placed(self, rows: DataFrame, key: str, parts: int) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        return rows.withColumns({"_live": F.lit(True), "_of": F.lit(parts), "_part": part})

    def replace(self, df: DataFrame, key: str, partition_by: str | None = None) -> int:
        """Forget all rows and store those of ``df``, which are written out first, for they may come from the table."""
        rows = staged(df, "incoming")
        self._write(self._placed(rows, key, self.parts), key, partition_by, dynamic=False)
        return rows.count()

    def upsert(self, batch: DataFrame, key: str, partition_by: str | None = None) -> int:
        """Replace and add rows by ``key`` (see ``upsert``); returns the table's rows."""
        stored = self._stored()
        if stored is None:
            return self.replace(upsert(batch.limit(0), batch, key), key, partition_by)
        parts = stored.select("_of").first()[0]
        rows = staged(self._placed(batch, key, parts), "incoming")
        # At most as many as there are parts.
        touched = [r[0] for r in rows.select("_part").distinct().collect()]
        if touched:
            old = stored.filter(F.col("_part").isin(touched))
            merged = staged(upsert(old.filter("_live"), rows, key), "merged")
            if partition_by:
                place = ["_of", "_part", partition_by]
                left = old.select(*place).distinct().join(merged.select(*place).distinct(), place, "left_anti")
                merged = merged.unionByName(left.withColumn("_live", F.lit(False)), allowMissingColumns=True)
            self._write(merged, key, partition_by, dynamic=True)
        return self.count()
