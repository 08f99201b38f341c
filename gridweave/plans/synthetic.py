"""A deterministic grid over the driver tables, in Spark and in SQL: the same integers give the same network in both.

Customers and suppliers are buses, line items are lines from a customer to a supplier, parts carry tags, and the events of a
user in time order are a chain of points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KVS = [66.0, 110.0, 132.0, 150.0, 220.0, 300.0, 330.0, 400.0]
GAP_HOURS = 6

#: Raw voltage, circuits, cables, frequency and other tags of a part, by remainders of its key.
VOLTAGES = ["400000;132000", "110 kV", "", " 220000 ; ; 66000", "380_000 V", "132kv;132000;20000"]
CIRCUITS = ["2;1", "", "x", "3"]
CABLES = ["6;3", "2", "", "9"]
FREQUENCIES = ["", "50", "16.7", "50;16.7", "0", "60", "16.67"]
LOCATIONS = ["", "underground", "submarine", "overhead", "indoor"]
POWERS = ["line", "cable", "minor_line", "construction", "tower"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(key: Column, values: list) -> Column:
    """The value at the key's remainder."""
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def pick_sql(key: str, values: list) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" for v in values)
    return f"list_extract([{listed}], CAST({key} % {len(values)} + 1 AS BIGINT))"


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey, tags``; an empty value is an absent tag."""
    key = F.col("p_partkey")
    named = [("voltage", VOLTAGES), ("circuits", CIRCUITS), ("cables", CABLES), ("frequency", FREQUENCIES), ("location", LOCATIONS), ("power", POWERS)]
    pairs = [(n, pick(key if i == 0 else F.floor(key / (i + 1)).cast("long"), v)) for i, (n, v) in enumerate(named)]
    full = F.create_map(*[x for n, v in pairs for x in (F.lit(n), v)])
    return table(spark, sf_dir, "part").select("p_partkey", F.map_filter(full, lambda k, v: v != "").alias("tags"))


TAG_SQL = "tag AS (SELECT p_partkey, " + ", ".join(
    f"NULLIF({pick_sql('p_partkey' if i == 0 else f'(p_partkey // {i + 1})', v)}, '') AS {n}"
    for i, (n, v) in enumerate([("voltage", VOLTAGES), ("circuits", CIRCUITS), ("cables", CABLES), ("frequency", FREQUENCIES), ("location", LOCATIONS), ("power", POWERS)])
) + " FROM part)"

#: Volts of a tag part, or null.
NUMBER_SQL = (
    "CASE WHEN lower(replace(replace({0}, ' ', ''), '_', '')) LIKE '%kv' THEN 1000.0 WHEN lower(replace(replace({0}, ' ', ''), '_', '')) LIKE '%mv' THEN 1000000.0 ELSE 1.0 END "
    "* TRY_CAST(regexp_replace(lower(replace(replace({0}, ' ', ''), '_', '')), '(kv|mv|v)$', '') AS DOUBLE)"
)
#: Trimmed, non-empty parts of a column, with their places from 0 among them.
PARTS_SQL = "list_filter(list_transform(string_split({0}, ';'), lambda p: trim(p)), lambda p: p <> '')"


def buses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bus_id, lon, lat, kv``."""

    def made(name: str, key: str, letter: str) -> DataFrame:
        k = F.col(key)
        lon = F.lit(-10.0) + (k * 7919 % 5500).cast("double") / 100
        lat = F.lit(35.0) + (k * 104729 % 3500).cast("double") / 100
        return table(spark, sf_dir, name).select(F.concat(F.lit(letter), k.cast("string")).alias("bus_id"), lon.alias("lon"), lat.alias("lat"), pick(k, KVS).alias("kv"))

    return made("customer", "c_custkey", "c").unionByName(made("supplier", "s_suppkey", "s"))


def _bus_sql(name: str, key: str, letter: str) -> str:
    return (
        f"SELECT '{letter}' || CAST({key} AS VARCHAR) AS bus_id, CAST(-10 AS DOUBLE) + CAST({key} * 7919 % 5500 AS DOUBLE) / 100 AS lon, "
        f"CAST(35 AS DOUBLE) + CAST({key} * 104729 % 3500 AS DOUBLE) / 100 AS lat, {pick_sql(key, KVS)} AS kv FROM {name}"
    )


BUS_SQL = f"bus AS ({_bus_sql('customer', 'c_custkey', 'c')} UNION ALL {_bus_sql('supplier', 's_suppkey', 's')})"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_id, elem, pos, bus0, bus1, kv, n_circuits, metres``."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    part = F.col("l_partkey")
    return rows.select(
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line_id"),
        F.col("l_orderkey").alias("elem"),
        F.col("l_linenumber").alias("pos"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("bus0"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("bus1"),
        pick(part, KVS).alias("kv"),
        (part % 3 + 1).cast("int").alias("n_circuits"),
        F.col("l_extendedprice").alias("metres"),
    )


LINE_SQL = (
    "line AS (SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS line_id, l_orderkey AS elem, l_linenumber AS pos, "
    "'c' || CAST(o_custkey AS VARCHAR) AS bus0, 's' || CAST(l_suppkey AS VARCHAR) AS bus1, "
    f"{pick_sql('l_partkey', KVS)} AS kv, CAST(l_partkey % 3 + 1 AS INTEGER) AS n_circuits, l_extendedprice AS metres "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


def event_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``before``, the user's previous event if at most GAP_HOURS earlier."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumn("prior", F.lag("event_id").over(order))
    close = F.expr(f"ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '{GAP_HOURS}' HOUR")
    return rows.withColumn("before", F.when(close, F.col("prior"))).drop("prior")


ISLAND_SQL = (
    f"step AS (SELECT *, CASE WHEN ts - lag(ts) OVER o <= INTERVAL '{GAP_HOURS}' HOUR THEN lag(event_id) OVER o END AS before FROM events "
    "WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)), "
    "numbered AS (SELECT *, sum(CASE WHEN before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM step), "
    "island AS (SELECT *, min(event_id) OVER (PARTITION BY user_id, n) AS component FROM numbered)"
)
