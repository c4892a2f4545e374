"""Scalar functions, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.catalog.registry import register
from acadmetric.catalog.views_sql import rounded
from acadmetric.functions.exact import half_up
from acadmetric.functions.keys import elapsed_ms, padded_code, pick, record_image, skewed_draw, uniform
from acadmetric.operators.audit import Actor, audit_from_changes
from acadmetric.sources.driver import StarTables


def _over(name: str, table: str, key: str, value: Callable[[], Column], sql: str) -> None:
    """Register a query that returns a table's key and one computed ``valor``."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return StarTables(spark, folder).read(table).select(key, value().alias("valor"))

    register(name, f"SELECT {key}, {sql} AS valor FROM {table}", query=run)


def _qualis() -> Column:
    return F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))


_QUALIS_SQL = "nullif(o_orderpriority, '4-NOT SPECIFIED')"
_CODES = ("alfa", "beta", "gama")

_over("fn_concat", "orders", "o_orderkey", lambda: F.concat(_qualis(), F.lit("/"), "o_orderstatus"),
      f"{_QUALIS_SQL} || '/' || o_orderstatus")
_over("fn_lpad", "orders", "o_orderkey", lambda: padded_code("P-", F.col("o_orderkey"), 12),
      "'P-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')")
_over("fn_cast", "orders", "o_orderkey", lambda: F.col("o_totalprice").cast("decimal(15,2)").cast("string"),
      "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)")
_over("fn_coalesce", "orders", "o_orderkey", lambda: F.coalesce(_qualis(), F.lit("-")), f"coalesce({_QUALIS_SQL}, '-')")
_over("fn_nullif", "orders", "o_orderkey", lambda: half_up(F.col("o_custkey"), F.col("o_orderkey") % 5, 2),
      rounded("o_custkey", "nullif(o_orderkey % 5, 0)", 2))
_over("fn_round", "orders", "o_orderkey",
      lambda: F.round(F.col("o_totalprice").cast("decimal(15,2)"), 1).cast("double"),
      "CAST(round(CAST(o_totalprice AS DECIMAL(15,2)), 1) AS DOUBLE)")
_over("fn_arith", "orders", "o_orderkey",
      lambda: F.call_function("div", F.col("o_orderkey") * 3 + 7, F.lit(2)) - F.col("o_custkey"),
      "(o_orderkey * 3 + 7) // 2 - o_custkey")
_over("fn_mod", "orders", "o_orderkey", lambda: F.col("o_orderkey") % 8, "o_orderkey % 8")
_over("fn_floor_power", "part", "p_partkey", lambda: F.floor(F.pow(F.lit(0.5), F.col("p_size") % 5) * 240),
      "CAST(floor(power(0.5, p_size % 5) * 240) AS BIGINT)")
_over("fn_random_seeded", "orders", "o_orderkey", lambda: uniform(42, F.col("o_orderkey")),
      "CAST(('0x' || substr(md5('42:' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0")
_over("fn_array_index", "orders", "o_orderkey", lambda: pick(_CODES, F.col("o_orderkey") % 4 + 1),
      f"(['{_CODES[0]}', '{_CODES[1]}', '{_CODES[2]}'])[o_orderkey % 4 + 1]")
_over("fn_date_literal_add", "orders", "o_orderkey",
      lambda: F.date_add(F.lit("2016-02-27").cast("date"), (F.col("o_orderkey") % 1461).cast("int")).cast("string"),
      "CAST(DATE '2016-02-27' + CAST(o_orderkey % 1461 AS INT) AS VARCHAR)")
_over("fn_make_date", "orders", "o_orderkey",  # month ends and the leap day, by the year of the order
      lambda: F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.day(F.last_day("o_orderdate"))).cast("string"),
      "CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR)")
_over("fn_date_trunc_day", "events", "event_id", lambda: F.to_date("ts").cast("string"),
      "CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR)")
_over("fn_elapsed_ms", "events", "event_id",
      lambda: elapsed_ms(F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts")),
      "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1000.0::DOUBLE")
_over("fn_json_get", "events", "event_id", lambda: F.get_json_object("props", "$.k").cast("bigint"),
      "CAST(json_extract_string(props, '$.k') AS BIGINT)")


def _image_fields() -> Column:
    """Fields read back from a row image, and whether the image names a missing field."""
    row = F.struct("event_id", "ts", "event_type", F.nullif(F.col("value") > 500, F.lit(True)).alias("baixo"))
    image = record_image(row)
    missing = F.when(image.contains('"baixo":null'), "sem valor").otherwise("com valor")
    return F.concat_ws("|", *[F.get_json_object(image, f"$.{name}") for name in ("event_type", "ts", "event_id")], missing)


_over("fn_row_to_json", "events", "event_id", _image_fields,
      "concat_ws('|', event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), event_id, "
      "CASE WHEN value > 500 OR value IS NULL THEN 'sem valor' ELSE 'com valor' END)")


def _context(spark: SparkSession, folder: str) -> DataFrame:
    """What the log says of who changed a row, with and without an application user."""
    feed = StarTables(spark, folder).events.select(
        F.lit("INSERT").alias("op"), F.lit(None).cast("struct<event_id:bigint>").alias("before"),
        F.struct("event_id").alias("after"), F.col("ts").alias("changed_at"), F.col("event_id").alias("change_id"))
    odd = F.col("change_id") % 2 == 1
    log = audit_from_changes(feed.filter(odd), "events", ["event_id"], Actor("maria", "10.0.0.7")).unionByName(
        audit_from_changes(feed.filter(~odd), "events", ["event_id"], Actor("joana", application_user="portal")))
    who = F.concat_ws("@", "au_ds_usuario_sessao", "au_nu_ip_sessao", "au_ds_usuario_aplicacao")
    return log.select(F.col("co_seq_auditoria").alias("event_id"), who.alias("valor"))


register("fn_session_context", """
    SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 'maria@10.0.0.7' ELSE 'joana@local@portal' END AS valor FROM events""", query=_context)


def _draw() -> Column:
    u = ((F.col("o_orderkey") * 7919) % 10007) / F.lit(10007.0)
    return skewed_draw(u, F.lit(80)).cast("bigint")


_over("skewed_fk_draw", "orders", "o_orderkey", _draw,
      "CAST(1 + floor(power(((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE, 2.5) * 80) AS BIGINT)")


def _now(spark: SparkSession, folder: str) -> DataFrame:
    """A job passes its time as a column; every log row of the run carries it, whatever the clock says later."""
    at = F.timestamp_add("MINUTE", F.lit(90), F.lit("2024-02-28 23:00:00").cast("timestamp_ntz"))
    feed = StarTables(spark, folder).events.select(
        F.lit("INSERT").alias("op"), F.lit(None).cast("struct<event_id:bigint>").alias("before"),
        F.struct("event_id").alias("after"), at.alias("changed_at"), F.col("event_id").alias("change_id"))
    log = audit_from_changes(feed, "events", ["event_id"], Actor("maria"))
    return log.select(F.col("co_seq_auditoria").alias("event_id"), F.col("au_dt_operacao").cast("string").alias("valor"))


register("fn_now", "SELECT event_id, '2024-02-29 00:30:00' AS valor FROM events", query=_now)
