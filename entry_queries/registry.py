"""Name -> query, name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entry_queries.bridge import CrmTables, oracle_tables
from tallyroute import prepare

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Source:
    """Base tables as attributes and the CRM tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.crm = CrmTables(spark, folder)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.crm.base(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Moments and days as text, so that both engines print the same values."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, crm: tuple[str, ...] = ()):
    """Register a query; ``crm`` names the derived tables its oracle reads as ``crm_<name>``."""

    def keep(plan: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(plan(Source(prepare(spark), folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if crm:
                words = text.split(None, 2)
                recursive = words[1].upper() == "RECURSIVE"
                starts = words[0].upper() == "WITH"
                rest = (words[2] if recursive else text[5:]) if starts else None
                head = ("WITH RECURSIVE " if recursive else "WITH ") + oracle_tables(crm)
                text = f"{head},\n{rest}" if rest is not None else f"{head}\n{text}"
            ORACLES[name] = text
        return plan

    return keep


# --- small pieces of oracle SQL -----------------------------------------------------------


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def ids(column: str) -> str:
    """List of ids as text; an empty or NULL list as in Spark."""
    return f"array_to_string({column}, ',')"


def clock(seconds: str) -> str:
    hours = f"CAST(({seconds}) // 3600 AS VARCHAR)"
    return (
        f"(lpad({hours}, CAST(greatest(2, length({hours})) AS INT), '0') || ':' ||"
        f" lpad(CAST((({seconds}) % 3600) // 60 AS VARCHAR), 2, '0') || ':' ||"
        f" lpad(CAST(({seconds}) % 60 AS VARCHAR), 2, '0'))"
    )
