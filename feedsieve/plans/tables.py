"""The dirty trade feed derived from the star-schema test tables.

The given tables have no nulls and no orphans, so faults are placed by integer
arithmetic on the keys of ``lineitem``. The rule is given in ``FIXTURES.md``.
All timestamps are zone-free, so results do not depend on the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedsieve.operators.load import RESEND_ORDER, latest_per_key
from feedsieve.schemas import PRICE_TYPE, QUANTITY_TYPE

NTZ = T.TimestampNTZType()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_TRADE_ID = "concat('T', CAST(l_orderkey * 10 + l_linenumber AS STRING)) AS trade_id"
_ORIGIN = (
    "concat('feed_', l_linestatus) AS source_file",
    "CAST(l_shipdate AS TIMESTAMP_NTZ) + INTERVAL 1 DAY AS ingested_at",
)


def _side(missing: str) -> str:
    return (
        f"CASE WHEN h % 211 = 0 THEN {missing} WHEN h % 223 = 0 THEN 'X' "
        "WHEN h % 227 = 0 THEN 'buy' WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side"
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "*", "l_orderkey * 7 + l_partkey * 13 + l_suppkey * 31 + l_linenumber AS h"
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-text feed, with the file each row came from and its load time."""
    return _lines(spark, sf_dir).selectExpr(
        _TRADE_ID,
        "IF(h % 997 = 0, '', CAST(l_partkey AS STRING)) AS instrument_id",
        _side("''"),
        "CASE WHEN h % 101 = 0 THEN '' WHEN h % 103 = 0 THEN CAST(-l_quantity AS STRING) "
        "ELSE CAST(l_quantity AS STRING) END AS quantity",
        "CASE WHEN h % 109 = 0 THEN '' WHEN h % 113 = 0 THEN '-1' "
        "ELSE CAST(l_extendedprice AS STRING) END AS price",
        "IF(h % 127 = 0, '', CAST(l_shipdate AS STRING)) AS executed_at",
        *_ORIGIN,
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as typed by the load, before re-sent trades are merged.

    Holds the same rows as ``typed_feed(feed(...))`` without going through text:
    the checks read a typed table, and the load has queries of its own.
    """
    quantity, price = QUANTITY_TYPE.simpleString(), PRICE_TYPE.simpleString()
    return _lines(spark, sf_dir).selectExpr(
        _TRADE_ID,
        "CASE WHEN h % 997 <> 0 THEN try_cast(l_partkey AS INT) END AS instrument_id",
        _side("NULL"),
        "CASE WHEN h % 101 <> 0 THEN "
        f"try_cast(IF(h % 103 = 0, -l_quantity, l_quantity) AS {quantity}) END AS quantity",
        "CASE WHEN h % 109 <> 0 THEN "
        f"try_cast(IF(h % 113 = 0, -1.0D, l_extendedprice) AS {price}) END AS price",
        "CASE WHEN h % 127 <> 0 THEN CAST(l_shipdate AS TIMESTAMP_NTZ) END AS executed_at",
        *_ORIGIN,
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade table: one row per trade_id."""
    return latest_per_key(landed(spark, sf_dir), "trade_id", RESEND_ORDER)


def _instruments(spark: SparkSession, sf_dir: str, wanted: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where(wanted)
        .selectExpr(
            "try_cast(p_partkey AS INT) AS instrument_id",
            "p_name AS symbol",
            "p_type AS asset_class",
            "'USD' AS currency",
        )
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instrument table, lacking some of the traded parts."""
    return _instruments(spark, sf_dir, "p_partkey % 97 <> 5")


def late_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some of the lacking instruments, arrived since."""
    return _instruments(spark, sf_dir, "p_partkey % 97 = 5 AND p_partkey % 2 = 1")
