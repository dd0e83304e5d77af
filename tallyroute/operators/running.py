"""Row numbers, previous values and running sums per key, safe for a hot key.

A plain window puts each key into one task.  Here a sample of the data tells which keys hold many
rows and where, along the order, such a key can be cut into pieces of like size.  Each piece is one
window group, and a small summary per piece carries the count, the sums and the last row over to the
next one.  There is one way for every size: a key with few rows is one piece.

The sample is drawn in one pass over the key and order columns: of all rows one in ``RATE`` by a hash
of the order columns, and of these the one with the smallest hash in each of some slots.  There are
as many pieces as shuffle partitions, or more, so pieces stay of bounded size where partitions do,
and what is broadcast follows that setting and not the data.  The bounds are values of the data, so a
retried task sees the same pieces.  Nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: one in so many rows takes part in the sample
RATE = 64
#: least slots of the sample, and slots for each piece
SAMPLE, SLOTS = 1 << 14, 16
#: sampled rows from which on a key is cut, as many in each piece at least
HEAVY = 16
#: least number of pieces that a key may be cut into
PIECES = 1024


def _non_null(df: DataFrame, name: str) -> list[tuple[str, Column]]:
    """Stand-in columns for a key so that equality also matches NULL with NULL."""
    kind = df.schema[name].dataType
    if not df.schema[name].nullable:
        return [(f"__k_{name}", F.col(name))]
    if isinstance(kind, T.StringType):
        zero = F.lit("")
    elif isinstance(kind, T.NumericType):
        zero = F.lit(0).cast(kind)
    elif isinstance(kind, T.BooleanType):
        zero = F.lit(False)
    else:
        zero = F.lit("1970-01-01").cast(kind)
    return [
        (f"__k_{name}", F.coalesce(F.col(name), zero)),
        (f"__n_{name}", F.col(name).isNull()),
    ]


def _sort_rank(df: DataFrame, order: Sequence[str]) -> Column:
    """Struct that compares like ``ORDER BY order ASC NULLS LAST``."""
    parts = []
    for index, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{index}"), F.col(name).alias(f"v{index}")]
    return F.struct(*parts)


def _stand_ins(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Key columns without NULLs; a constant if there is no key."""
    return dict(pair for key in keys for pair in _non_null(df, key)) or {"__k": F.lit(0)}


def _pieces(df: DataFrame) -> int:
    """Pieces a key may be cut into."""
    return max(PIECES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _heavy_keys(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys with many sampled rows and the sorted bounds of their pieces.

    At most as many bounds as slots, so the result may be broadcast.
    """
    held = _stand_ins(source, keys)
    pieces = _pieces(source)
    slots = max(SAMPLE, SLOTS * pieces)
    draw = F.xxhash64(*order)
    drawn = (
        source.where(F.pmod(draw, F.lit(RATE)) == 0)
        .select(F.pmod(F.xxhash64(draw), F.lit(slots)).alias("__slot"), F.struct(
            F.xxhash64(F.lit(1), draw).alias("__hash"),
            *[column.alias(name) for name, column in held.items()],
            _sort_rank(source, order).alias("__rank")).alias("__row"))
        .groupBy("__slot").agg(F.min("__row").alias("__row")).select("__row.*")
    )
    ranks = F.sort_array("__ranks")
    step = F.greatest(F.ceil(F.size("__ranks") / pieces), F.lit(HEAVY))
    return (
        drawn.groupBy(*held).agg(F.collect_list("__rank").alias("__ranks"))
        .where(F.size("__ranks") >= HEAVY)
        .select(*held, F.filter(ranks, lambda _, i: i % step == 0).alias("__bounds"))
    )


def _with_piece(df: DataFrame, rank: Column, pieces: int) -> DataFrame:
    """Add ``__cut``, the number of bounds up to the row, by halving; 0 for a key that is not cut.

    Each step is a column of its own, so that it is generated code and evaluated once.
    """
    df = df.withColumns({"__rank": rank, "__cut": F.lit(0)})
    step = 1 << (pieces.bit_length() - 1)
    while step:
        passed = F.get("__bounds", F.col("__cut") + (step - 1)) <= F.col("__rank")
        df = df.withColumn("__cut", F.col("__cut") + F.when(passed, step).otherwise(0))
        step //= 2
    return df.drop("__rank")


def running_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    previous: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    sample_of: DataFrame | None = None,
) -> DataFrame:
    """Add per-key running columns in ascending order, NULLs last.

    ``order``     columns whose values together differ between the rows of a key
    ``number``    name of the 1-based row number
    ``previous``  new name -> column of the row before
    ``sums``      new name -> column summed over all rows before this one (0 for the first)
    ``sample_of`` cheaper frame with the same keys and order columns to find the pieces from
    """
    previous, sums = dict(previous or {}), dict(sums or {})
    keys, order = list(keys), list(order)
    held = _stand_ins(df, keys)
    names = list(held)
    heavy = _heavy_keys(df if sample_of is None else sample_of, keys, order)
    if keys:
        marked = df.withColumns(held).join(F.broadcast(heavy), names, "left")
    else:  # all rows have the same bounds
        marked = df.withColumns(held | {"__bounds": heavy.select("__bounds").scalar()})
    rows = (
        _with_piece(marked, _sort_rank(df, order), _pieces(df))
        .withColumn("__hot", F.col("__bounds").isNotNull()).drop("__bounds")
    )
    window = Window.partitionBy(*names, "__cut").orderBy(
        *[F.col(name).asc_nulls_last() for name in order])
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    added = {"__number": F.row_number().over(window).cast("bigint")}
    added |= {f"__p_{new}": F.lag(old).over(window) for new, old in previous.items()}
    added |= {f"__s_{new}": F.coalesce(F.sum(old).over(before), F.lit(0))
              for new, old in sums.items()}
    numbered = rows.withColumns(added)

    totals = [F.count(F.lit(1)).alias("__rows")]
    totals += [F.sum(old).alias(f"__t_{new}") for new, old in sums.items()]
    if previous:
        tail = F.struct(*[F.col(old).alias(new) for new, old in previous.items()])
        totals.append(F.max_by(tail, _sort_rank(df, order)).alias("__tail"))
    along = Window.partitionBy(*names).orderBy("__cut")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before")]
    carried += [F.coalesce(F.sum(f"__t_{new}").over(earlier), F.lit(0)).alias(f"__t_{new}")
                for new in sums]
    if previous:
        carried.append(F.lag("__tail").over(along).alias("__tail"))
    # a row per piece of the heavy keys: no more than there are bounds and heavy keys
    summary = (
        rows.where("__hot").groupBy(*names, "__cut").agg(*totals)
        .select(*names, "__cut", *carried)
    )

    joined = numbered.join(F.broadcast(summary), [*names, "__cut"], "left")
    final: dict[str, Column] = {}
    if number:
        final[number] = F.col("__number") + F.coalesce(F.col("__rows_before"), F.lit(0))
    for new in previous:
        final[new] = F.when(
            (F.col("__number") == 1) & F.col("__tail").isNotNull(), F.col(f"__tail.{new}")
        ).otherwise(F.col(f"__p_{new}"))
    for new in sums:
        final[new] = F.col(f"__s_{new}") + F.coalesce(F.col(f"__t_{new}"), F.lit(0))
    return joined.select(*df.columns, *[column.alias(name) for name, column in final.items()])


def dense_index(
    df: DataFrame, unique_id: str, name: str = "idx", tie: Sequence[str] = ()
) -> DataFrame:
    """0-based position along an id, unique alone or together with the ``tie`` columns, without a
    one-task global window; ids may be as sparse as they like."""
    numbered = running_by(df, [], [unique_id, *tie], number="__position")
    return numbered.select(*df.columns, (F.col("__position") - 1).alias(name))
