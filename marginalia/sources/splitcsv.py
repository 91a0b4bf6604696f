"""CSV files with quoted line breaks, read in many tasks per file.

A line break ends a record only outside quotes, and whether a file split starts inside a quoted field
depends on everything before it. But a line does no more than turn one of two states, outside or
inside quotes, into one of two: a function of four kinds, told by regular expressions.
Composed over a split, one such function per split remains; composed over the splits of a file, they
give the state each split starts in. The splits are then read again, each by itself: lines are put
together to records, and only pieces of records that cross a border are sent to meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from marginalia.sources.layout import split_bound

# Functions of a line or split: bit 0 is the state after it from outside, bit 1 from inside.
_KEEPS, _SWAPS = 2, 1
# Only for splits: starting inside, the state was outside at some point.
_CLOSED = 4

# Splits of some 100 bytes each whose start states are broadcast.
MAX_BROADCAST_SPLITS = 200_000

_SPLIT = ["__file", "__block"]


def _turns(line: Column, sep: str) -> Column:
    """The function of a line. All loops are possessive: Java runs them without recursion."""
    d = "\\t" if sep == "\t" else f"\\x{{{ord(sep):x}}}"
    body = '(?:[^"]++|"")*+'  # of a quoted field, up to a lone quote
    field = f'(?:"{body}"[^{d}]*+|[^"{d}][^{d}]*+|){d}'
    opens = f'(?:{field})*+"{body}\\z'
    from_outside = line.rlike(f"\\A{opens}")
    from_inside = line.rlike(f'\\A{body}(?:\\z|"[^{d}]*+{d}{opens})')
    turned = from_outside.cast("int") + 2 * from_inside.cast("int")
    return F.when(line.contains('"'), turned).otherwise(_KEEPS)


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.input_file_name().alias("__file"),
        F.input_file_block_start().cast("long").alias("__block"),
        F.monotonically_increasing_id().alias("__pos"),
        _turns(F.col("value"), sep).alias("turns"),
        "value",
    )


def _split_starts(lines: DataFrame) -> DataFrame:
    """__file, __block, owner: splits that start inside a record, and the split it began in."""
    step = F.when(F.col("turns") != _KEEPS, F.struct("__pos", "turns"))
    # All lines of a split are in one task; one that changes something costs some 16 bytes.
    steps = lines.groupBy(*_SPLIT).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    after = "(shiftright(x.turns, a & 1) & 1) | ((shiftright(x.turns, shiftright(a, 1) & 1) & 1) * 2)"
    whole = F.expr(f"aggregate(steps, {_KEEPS}, (a, x) -> ({after}) | (a & {_CLOSED}) | IF((({after}) & 2) = 0, {_CLOSED}, 0))")
    splits = steps.select(*_SPLIT, whole.alias("all"))
    # Windows hold one short row per split of a file.
    so_far = Window.partitionBy("__file").orderBy("__block")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    both = F.col("all").bitwiseAND(3)
    swaps = splits.withColumns({"both": both, "swaps": F.sum((both == _SWAPS).cast("int")).over(so_far)})
    fixed = F.when((F.col("both") == 0) | (F.col("both") == 3), F.struct((F.col("both") == 3).cast("int").alias("to"), "swaps"))
    known = swaps.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(before), "turned": F.coalesce(F.lag("swaps").over(so_far), F.lit(0))})
    start = F.pmod(F.coalesce(F.col("fixed.to"), F.lit(0)) + F.col("turned") - F.coalesce(F.col("fixed.swaps"), F.lit(0)), F.lit(2))
    started = known.withColumn("start", start)
    # The record still open at the end began here, unless it was open all through.
    ends_open = F.expr("shiftright(both, int(start)) & 1") == 1
    begins = ends_open & ((F.col("start") == 0) | (F.col("all").bitwiseAND(_CLOSED) != 0))
    owner = F.last(F.when(begins, F.col("__block")), ignorenulls=True).over(before)
    return started.withColumn("owner", owner).filter("start = 1").select(*_SPLIT, "owner")


_PIECE = 1 << 20
_RECORD = "__file string, __block long, __pos long, owner long, first boolean, record string"


def _assembler(piece: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_assemble``, made here so that it is sent to Python workers whole: they may have no copy of this
    package, and a function of a module is sent as its name only."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of about ``piece`` bytes, so that few lines at a time are Python's."""
        for batch in batches:
            step = max(1, batch.num_rows * piece // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step)
            del batch

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of each split, numbered in ``__pos``. ``owner`` is set on pieces: the split their
        record began in, whose number for it counts."""
        schema = pa.schema(
            [("__file", pa.string()), ("__block", pa.int64()), ("__pos", pa.int64()), ("owner", pa.int64()),
             ("first", pa.bool_()), ("record", pa.string())]
        )
        split, inside, owner, lines, pos, first, held = None, 0, None, [], 0, False, 0
        rows: list[tuple] = []

        def end(piece_of: int | None) -> None:
            nonlocal first, held, lines, owner, pos
            record = "\n".join(lines)
            if piece_of is not None or record.strip("\r"):
                rows.append((*split, pos, piece_of, first, record))
                held += len(record)
                first = False
                if owner is None:
                    pos += 1
            lines, owner = [], None

        def flush() -> pa.RecordBatch:
            nonlocal held
            held = 0
            batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return batch

        names = ("__file", "__block", "turns", "value", "owner")
        for part in pieces(batches):
            for file, block, turns, value, began in zip(*[part.column(c).to_pylist() for c in names]):
                if (file, block) != split:
                    if lines:
                        end(split[1] if owner is None else owner)
                    split, inside, owner, pos, first = (file, block), int(began is not None), began, 0, block == 0
                lines.append(value)
                inside = turns >> inside & 1
                if not inside:
                    end(owner)
                if len(rows) > 5000 or held > piece:
                    yield flush()
        if lines:
            end(split[1] if owner is None else owner)
        if rows:
            yield flush()

    return assemble


_assemble = _assembler(_PIECE)


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """__file, __block, __pos, first, record: the raw records of CSV files, in file order by the first three.

    ``first`` marks the first record of a file. Empty lines between records are left out.
    """
    lines = _lines(spark, path, sep)
    starts = _split_starts(lines)
    bound = split_bound(lines)
    if bound is not None and bound <= MAX_BROADCAST_SPLITS:
        ready = lines.join(F.broadcast(starts), _SPLIT, "left")
    else:
        # Too many splits to tell every task: lines go to their split's start, and are put in order again.
        ready = lines.join(starts, _SPLIT, "left").repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "__pos")
    found = ready.select(*_SPLIT, "turns", "value", "owner").mapInArrow(_assemble, _RECORD)
    pieces = F.array_sort(F.collect_list(F.struct("__block", "__pos", "first", "record")))
    joined = (
        found.filter("owner IS NOT NULL")
        .groupBy("__file", "owner")
        .agg(pieces.alias("pieces"))
        .select(
            "__file",
            F.col("pieces")[0]["__block"].alias("__block"),
            F.col("pieces")[0]["__pos"].alias("__pos"),
            F.col("pieces")[0]["first"].alias("first"),
            F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"),
        )
    )
    alone = found.filter("owner IS NULL").select(*joined.columns)
    every = alone.unionByName(joined)
    return every.withColumn("record", F.regexp_replace("record", "\r\\z", ""))


def read_split_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """``columns`` as strings, besides __file, __block and __pos, which tell the order of rows.

    A file whose header has other names is an error.
    """
    schema = StructType()
    for i in range(len(columns)):
        schema = schema.add(f"c{i}", StringType())
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    parsed = records(spark, path, sep).withColumn("row", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options))
    # Repeated names got a number behind, missing ones a name of their own.
    odd = [F.coalesce(F.col(f"row.c{i}"), F.lit("")).isin("", name) | F.lit(name).startswith(F.col(f"row.c{i}")) for i, name in enumerate(columns)]
    same = F.lit(True)
    for ok in odd:
        same = same & ok
    keep = F.when(~F.col("first"), True).when(same, False).otherwise(
        F.raise_error(F.concat(F.lit("header differs from that of other files: "), "__file")).cast("boolean")
    )
    values = [F.col(f"row.c{i}").alias(name) for i, name in enumerate(columns)]
    return parsed.filter(keep).select("__file", "__block", "__pos", *values)
