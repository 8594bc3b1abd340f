"""What the operators of this subpackage share: shared-folder checkpoints, row keys and Arrow text access."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
#: Bits of a row key for the place in a file; the others are for the file.
FILE_ROW_BITS = 27
#: Rows that a task reads of a small table.
PART_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and there is one process only (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: it names the folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="anchorwise-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cuts the lineage by a table written to the shared folder, whose size the optimizer then knows. A checkpoint keeps the estimate that its plan led to: over joins of
    checkpoints with each other, its number of digits doubles each time. With `rows`, it has a file for every PART_ROWS of them, not one for each shuffle partition."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(max(2, -(-rows // PART_ROWS)))).write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._folder = folder
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df._folder)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until df has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def _source(plan):  # noqa: ANN001, ANN202  a logical plan of the JVM
    """The leaf that rows come straight from, or None where they come out of anything but projections and filters."""
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().apply(0)
    return plan if plan.children().isEmpty() else None


def _file_salt(df: DataFrame, place: Column) -> int | None:
    """A salt under which the hashes of the paths of df's files differ."""
    if len(df.inputFiles()) == 1:
        return 0
    files = df.select(place["file_path"].alias("path")).distinct()
    n, *found = files.agg(F.count("*"), *(F.count_distinct(_file_number(F.col("path"), k)) for k in range(8))).first()
    return found.index(n) if n in found else None


def _file_number(path: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(path, F.lit(salt)), F.lit(1 << 63 - FILE_ROW_BITS))


def _kind(df: DataFrame) -> str | None:
    """Where the rows come straight from: "parquet" files, an "rdd" such as a checkpoint, or None for anything else."""
    source = _source(df._jdf.queryExecution().optimizedPlan())
    if source is None:
        return None
    if source.nodeName().startswith(("LogicalRelation", "Relation")) and source.relation().getClass().getSimpleName() == "HadoopFsRelation" and source.relation().fileFormat().toString() == "Parquet":
        return "parquet"
    return "rdd" if source.nodeName() in ("LogicalRDD", "Scan ExistingRDD") else None


def settled(df: DataFrame) -> DataFrame:
    """df, or a checkpoint of it: a table whose rows have the same keys in each call of with_uid(). For operators that number their rows more than once."""
    return df if _kind(df) else cut(df)


def with_uid(df: DataFrame, name: str = "uid") -> DataFrame:
    """Adds uid (or `name`), a number for each row, the same in every scan of the same input. In Parquet files it follows from the file and the row's place in it,
    so it doesn't change with splits, which depend on settings and on the cores registered at the moment. Files go by hashes of their paths; where hashes clash under all salts, as with
    very many files, by their place among the sorted paths, which are joined to the rows. A checkpoint has partitions of its own, that don't change. Other rows
    are written to the shared folder first (in each call: see settled())."""
    kind = _kind(df)
    if kind != "parquet":
        return (df if kind else cut(df)).withColumn(name, F.monotonically_increasing_id())
    place = df.metadataColumn("_metadata")
    row = F.when(place["row_index"] < 1 << FILE_ROW_BITS, place["row_index"]).otherwise(F.raise_error(F.lit("a file has too many rows for row keys")))
    salt = _file_salt(df, place)
    if salt is not None:
        return df.withColumn(name, F.shiftleft(_file_number(place["file_path"], salt), FILE_ROW_BITS) + row)
    path, at, number = free(df, "path"), free(df, "row_at"), free(df, "file_number")
    files = df.select(place["file_path"].alias(path)).distinct()
    numbers = table(files.withColumn(number, F.row_number().over(Window.orderBy(path)).cast("long")))  # a row for each file
    rows = df.withColumns({path: place["file_path"], at: row}).join(numbers, path)
    return rows.withColumn(name, F.shiftleft(F.col(number), FILE_ROW_BITS) + F.col(at)).drop(path, at, number)


#: What words don't hold, as characters and as a pattern of one or more.
BLANK_CHARS, BLANKS = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]+"


def split_words(text: Column) -> Column:
    """The words of a text, runs of other characters than blanks, tabs, line ends and the like."""
    outside = [*BLANK_CHARS, ""]
    blank_end = F.substring(text, 1, 1).isin(outside) | F.substring(text, -1, 1).isin(outside)
    found = F.split(text, BLANKS)
    return F.when(blank_end, F.array_remove(found, "")).otherwise(found)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value made once."""
    return F.transform(F.array(value), body)[0]


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _tidy() -> None:
    """Gives freed memory back to the system, as workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over batches cut to about BATCH_BYTES, however long the rows are."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
            for a in range(0, batch.num_rows, rows):
                yield batch.slice(a, rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(cut_up(batches))
        finally:
            _tidy()

    return df.mapInArrow(task, schema)


class Numbers(dict):
    """Numbers of words in the order in which they are first asked for; `new` holds those asked for since it was last emptied."""

    def __init__(self, *known: object) -> None:
        super().__init__({w: i for i, w in enumerate(known)})
        self.new: list = []

    def __missing__(self, word: object) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, one behind the other, and the n + 1 offsets. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cuts rows into runs [a, b) of about `most` bytes, of one row at least."""
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit words, the same in every process."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) in 64 bits."""
    out = np.full(n, base % (1 << 64), np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def range_hash(x: np.ndarray, begins: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each x[begin:end] (bytes) that doesn't depend on its place: sums of random words times powers of an odd base."""
    base = int(random_words(1, seed + 1000)[0]) | 1
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(random_words(256, seed)[x] * powers(base, len(x)), out=total[1:])
    back = powers(pow(base, -1, 1 << 64), len(x) + 1)
    return mixed((total[ends] - total[begins]) * back[begins] + (ends - begins).astype(np.uint64))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
