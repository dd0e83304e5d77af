"""Joins of requests and facts to their dimensions.

Dimensions are broadcast by Spark when their measured size allows it and otherwise sorted and merged,
a hot key being split at run time.  Forced is only the broadcast of hot keys, whose number is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.functions import cleaning, idlists
from tallyroute.session import stored


def keyed_fetch(dim: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Only the dimension rows whose key occurs in the requests."""
    return dim.join(requests.select(key).distinct(), key, "left_semi")


def canonical_key(df: DataFrame, source: str, key: str) -> DataFrame:
    return df.withColumn(key, cleaning.canonical(source))


def last_entry(dim: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """Dictionary view of a master table: the last row of a repeated key counts."""
    picked = F.max_by(F.struct(*[F.col(name) for name in values]), F.col(order))
    return dim.groupBy(key).agg(picked.alias("__row")).select(key, "__row.*")


def dictionary_join(
    df: DataFrame, dim: DataFrame, key: str, order: str, values: Sequence[str]
) -> DataFrame:
    return df.join(last_entry(dim, key, order, values), key, "left")


def star(fact: DataFrame, *arms: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """Left equality joins of one fact to several dimensions."""
    for dim, on in arms:
        fact = fact.join(dim, on, "left")
    return fact


def member_rows(fact: DataFrame, ids: str, member: str) -> DataFrame:
    """One row per distinct array member; a NULL or empty array gives no row."""
    return fact.withColumn(member, F.explode(F.array_distinct(F.col(ids))))


def array_member_join(
    fact: DataFrame, ids: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Inner join on ``dim_key = ANY(ids)`` as explode plus equality join."""
    return member_rows(fact, ids, dim_key).join(dim, dim_key)


def array_member_left_join(
    fact: DataFrame, row_id: str | Sequence[str], ids: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Left join on ``dim_key = ANY(ids)``: a fact row without any partner stays once.

    Members are unfolded and matched; unmatched members go, except one for a row that has no
    match at all.  The clean-up groups by the unique fact id, so no group outgrows its array.
    """
    row_ids = [row_id] if isinstance(row_id, str) else list(row_id)
    unfolded = fact.withColumn(dim_key, F.explode_outer(F.array_distinct(F.col(ids))))
    matched = unfolded.join(dim.withColumn("__hit", F.lit(True)), dim_key, "left")
    window = Window.partitionBy(*row_ids).orderBy(
        F.col("__hit").desc_nulls_last(), F.col(dim_key).asc_nulls_last()
    )
    return (
        matched.withColumn("__place", F.row_number().over(window))
        .where(F.col("__hit") | (F.col("__place") == 1))
        .withColumn(dim_key, F.when(F.col("__hit"), F.col(dim_key)))
        .drop("__hit", "__place")
    )


def last_member_join(
    fact: DataFrame, ids: str, dim: DataFrame, dim_key: str, how: str = "left"
) -> DataFrame:
    """Join on the last array member."""
    return fact.withColumn(dim_key, idlists.last_item(ids)).join(dim, dim_key, how)


#: most keys of the right side that are dealt into pieces, and items the sketch of them tracks
HOT_KEYS, TRACKED = 1024, 16384
#: pieces the whole right side would be dealt into, per shuffle partition
SPREAD = 2


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that hold more rows than a piece should, with the number of ``__pieces`` each needs.

    A frequency sketch names the candidates in one pass over the keys; they alone are counted.  There
    are ``HOT_KEYS`` of them at most, so the result may be broadcast.
    """
    wanted = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.where(_known(keys)).select(*keys, F.xxhash64(*keys).alias("__h"))
    seen = rows.agg(F.expr(f"approx_top_k(__h, {HOT_KEYS}, {TRACKED})").alias("__top"),
                    F.count(F.lit(1)).alias("__total"))
    often = seen.select("__total", F.explode("__top").alias("__top")).where(
        F.col("__top.count") * wanted > F.col("__total")).select(
            F.col("__top.item").alias("__h"), "__total")
    counted = rows.join(F.broadcast(often), "__h").groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) * wanted / F.max("__total")).cast("int").alias("__pieces"))
    return counted.where("__pieces > 1")


def many_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    store: bool = True,
    widen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Left join to a side with many rows per key, one of which may be hot.

    The right side is stored once, unless ``store`` says that it is a plain reading of stored rows.
    Its hot keys are dealt into as many pieces as their rows ask for, row by row, so that equal rows
    are spread too; left rows of such a key are repeated once per piece and meet each piece alone.
    All other keys are joined as they are.  ``widen`` joins more columns to the right rows, after
    they are dealt into pieces, so that what is stored and counted is narrow.
    """
    keys = list(keys)
    right = stored(right, "many-side") if store else right
    hot = F.broadcast(hot_keys(right, keys))
    dealt = right.withColumn("__row", F.monotonically_increasing_id()).join(
        hot, keys, "left").select(
            *right.columns, F.lit(True).alias("__met"),
            F.coalesce(F.pmod("__row", F.col("__pieces")), F.lit(0)).cast("int").alias("__salt"))
    dealt = dealt if widen is None else widen(dealt)
    asked = left.join(hot, keys, "left").withColumn("__salt", F.explode(
        F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)))
    joined = asked.join(dealt, [*keys, "__salt"], "left")
    # a hot key has rows: a piece of it without any adds nothing
    return joined.where("__pieces IS NULL OR __met").drop("__pieces", "__salt", "__met")


def same_day_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    how: str = "left",
    *,
    store: bool = True,
) -> DataFrame:
    """Equality join on the keys and on the calendar day instead of a range condition; ``store`` as
    in :func:`many_left_join`."""
    on = [*keys, "__day"]
    left = left.withColumn("__day", F.to_date(left_ts))
    right = right.withColumn("__day", F.to_date(right_ts))
    joined = (many_left_join(left, right, on, store=store) if how == "left"
              else left.join(right, on, how))
    return joined.drop("__day")


def unpivot_join(
    wide: DataFrame,
    keep: Sequence[str],
    date_columns: Sequence[str],
    dim: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Turn alternative date columns into rows, then join once.

    ``on`` maps names of ``wide`` (``due_date`` for the unfolded date) to names of ``dim``.
    """
    long = wide.unpivot(
        [F.col(name) for name in keep],
        [F.col(name) for name in date_columns],
        "due_column",
        "due_date",
    )
    renamed = dim.withColumnsRenamed({theirs: ours for ours, theirs in on.items()})
    return long.join(renamed, list(on), how)


def fallback_lookup(
    requests: DataFrame,
    people: DataFrame,
    person: str,
    first: Mapping[str, str],
    second: Mapping[str, str],
) -> DataFrame:
    """Resolve by the first key, else by the second; the smallest id wins among duplicates.

    ``first`` and ``second`` each map one request column to one column of ``people``.
    """
    found = []
    for step, pair in enumerate((first, second)):
        ((ours, theirs),) = pair.items()
        known = (
            people.where(F.col(theirs).isNotNull() & (F.col(theirs) != ""))
            .groupBy(F.col(theirs).alias(ours))
            .agg(F.min(person).alias(f"__hit{step}"))
        )
        requests = requests.join(known, ours, "left")
        found.append(F.col(f"__hit{step}"))
    return requests.withColumn(person, F.coalesce(*found)).drop("__hit0", "__hit1")


def without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur on the other side; a NULL key never matches."""
    return df.join(other.select(*keys).where(_known(keys)).distinct(), list(keys), "left_anti")


def within(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def _known(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition
