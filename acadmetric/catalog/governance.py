"""Data rules, completeness, volumes and the audit log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadmetric.catalog.registry import query
from acadmetric.catalog.views_sql import rounded
from acadmetric.functions.exact import half_up_percent
from acadmetric.functions.keys import key_text
from acadmetric.operators import quality
from acadmetric.operators.audit import Actor, audit_from_changes, checked_batch, snapshot_changes, snapshot_changes_by_digest
from acadmetric.schema import Column, Table
from acadmetric.session import new_path
from acadmetric.sources.driver import SCHEMAS, StarTables
from acadmetric.sources.footers import column_profile, read_for_footers, star_paths
from acadmetric.streaming.audit_stream import audit_all, change_stream
from acadmetric.streaming.checked_stream import CheckedStore

ACTOR = Actor("analista", application_user="painel")


# --- data rules --------------------------------------------------------------


@query("dq_primary_key", """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def dq_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    return quality.key_violations(StarTables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_unique", "SELECT p_name, count(*) AS row_count FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique_violations(StarTables(spark, folder).part, ["p_name"])


@query("dq_foreign_key", """
    SELECT l_orderkey, count(*) AS row_count FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def dq_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    return quality.reference_violations(
        s.lineitem, "l_orderkey", s.orders.filter(F.col("o_orderstatus") != "P"), "o_orderkey")


_NULLABLE = {"o_custkey": "o_custkey", "qualis": "nullif(o_orderpriority, '4-NOT SPECIFIED')",
             "status": "nullif(o_orderstatus, 'P')"}


def _with_gaps(s: StarTables) -> DataFrame:
    return s.orders.select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("qualis"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"))


@query("dq_not_null", " UNION ALL ".join(
    f"SELECT '{name}' AS coluna, count(*) - count({sql}) AS violacoes FROM orders" for name, sql in _NULLABLE.items()))
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    filled = quality.filled_counts(_with_gaps(StarTables(spark, folder)), list(_NULLABLE))
    return filled.select("coluna", (F.col("total") - F.col("preenchidas")).alias("violacoes"))


@query("dq_domain", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def dq_domain(spark: SparkSession, folder: str) -> DataFrame:
    broken = quality.outside_domain("o_orderstatus", ("F", "O"))
    return StarTables(spark, folder).orders.filter(broken).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("dq_range", "SELECT l_discount, count(*) AS n FROM lineitem WHERE NOT (l_discount BETWEEN 0.02 AND 0.08) GROUP BY 1")
def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    broken = quality.outside_range("l_discount", 0.02, 0.08)
    return StarTables(spark, folder).lineitem.filter(broken).groupBy("l_discount").agg(F.count("*").alias("n"))


@query("dq_period", """
    SELECT l_orderkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_shipdate < o_orderdate GROUP BY 1""")
def dq_period(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    dated = s.lineitem.select("l_orderkey", "l_shipdate").join(
        s.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return dated.filter(quality.ends_before_start("o_orderdate", "l_shipdate")).groupBy("l_orderkey").agg(
        F.count("*").alias("n"))


@query("dq_max_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def dq_max_length(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).part.filter(quality.longer_than("p_name", 10)).select("p_partkey", "p_name")


# Rules on views of the given tables that break each of them somewhere: a key that repeats, a parent with gaps, a code and a
# value out of bounds, a missing and an overlong text.
_TEXT, _NUMBER = T.StringType(), T.LongType()
_RULES = (
    Table("pedidos", (Column("o_orderkey", _NUMBER), Column("o_custkey", _NUMBER, False), Column("prioridade", _TEXT, True, 6),
                      Column("o_orderstatus", _TEXT)),
          ("o_orderkey",), references={"o_custkey": ("clientes", "c_custkey")}, domains={"o_orderstatus": ("F", "O")}),
    Table("itens", (Column("l_orderkey", _NUMBER), Column("l_partkey", _NUMBER), Column("devolucao", _TEXT), Column("l_discount", T.DoubleType())),
          ("l_orderkey",), references={"l_partkey": ("pecas", "p_partkey")}, ranges={"l_discount": (0.02, None)}),
    Table("pecas", (Column("p_partkey", _NUMBER), Column("p_name", _TEXT, True, 9)), ("p_partkey",), unique=("p_name",)),
    Table("clientes", (Column("c_custkey", _NUMBER), Column("c_name", _TEXT)), ("c_custkey",), unique=("c_name",)),
)


def _ruled(s: StarTables) -> dict[str, DataFrame]:
    return {
        "pedidos": s.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("prioridade"), "o_orderstatus"),
        "itens": s.lineitem.select("l_orderkey", "l_partkey", F.nullif("l_returnflag", F.lit("N")).alias("devolucao"), "l_discount"),
        "pecas": s.part.filter(F.col("p_partkey") % 10 != 3).select("p_partkey", F.nullif("p_name", F.lit("part 7")).alias("p_name")),
        "clientes": s.customer.filter(F.col("c_custkey") % 10 != 0).select("c_custkey", "c_name"),
    }


_RULED_SQL = """
    WITH pedidos AS (SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS prioridade, o_orderstatus FROM orders),
    itens AS (SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'N') AS devolucao, l_discount FROM lineitem),
    pecas AS (SELECT p_partkey, nullif(p_name, 'part 7') AS p_name FROM part WHERE p_partkey % 10 <> 3),
    clientes AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 10 <> 0)"""


@query("dq_rule_counts", _RULED_SQL + """
    SELECT 'pedidos' AS tabela, 0::BIGINT AS pk, (SELECT count(*) FROM pedidos WHERE o_custkey % 10 = 0) AS fk, 0::BIGINT AS "unique",
           (SELECT count(*) FROM pedidos WHERE o_orderstatus = 'P') AS "check",
           (SELECT count(*) FROM pedidos WHERE prioridade IS NULL) AS required,
           (SELECT count(*) FROM pedidos WHERE length(prioridade) > 6) AS length
    UNION ALL SELECT 'itens', (SELECT count(*) FROM itens WHERE l_orderkey IN (SELECT l_orderkey FROM itens GROUP BY 1 HAVING count(*) > 1)),
           (SELECT count(*) FROM itens WHERE l_partkey % 10 = 3), 0, (SELECT count(*) FROM itens WHERE l_discount < 0.02),
           (SELECT count(*) FROM itens WHERE devolucao IS NULL), 0
    UNION ALL SELECT 'pecas', 0, 0, (SELECT count(*) FROM pecas JOIN (SELECT p_name FROM pecas GROUP BY 1 HAVING count(*) > 1) USING (p_name)), 0,
           (SELECT count(*) FROM pecas WHERE p_name IS NULL), (SELECT count(*) FROM pecas WHERE length(p_name) > 9)
    UNION ALL SELECT 'clientes', 0, 0, (SELECT count(*) - count(DISTINCT c_name) FROM clientes), 0, 0, 0""")
def dq_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = _ruled(StarTables(spark, folder))
    found = [quality.rule_violations(tables, rules) for rules in _RULES]
    return quality.rule_counts(reduce(DataFrame.unionByName, found))


@query("dq_rule_violations", _RULED_SQL + """
    SELECT 'itens' AS tabela, 'required' AS tipo, 'devolucao' AS regra, count(*) AS violacoes FROM itens WHERE devolucao IS NULL
    UNION ALL SELECT 'itens', 'check', 'l_discount range', count(*) FROM itens WHERE l_discount < 0.02
    UNION ALL SELECT 'itens', 'fk', 'l_partkey', count(*) FROM itens WHERE l_partkey NOT IN (SELECT p_partkey FROM pecas)
    UNION ALL SELECT 'itens', 'pk', 'l_orderkey', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM itens GROUP BY l_orderkey HAVING count(*) > 1)""")
def dq_rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rule_violations(_ruled(StarTables(spark, folder)), _RULES[1]).filter("violacoes > 0")


def _share(filled: str, total: str) -> Expression:
    return F.concat(half_up_percent(F.col(filled), F.col(total), 0).cast("bigint").cast("string"), F.lit("%"))


_FILLED = {
    "pedidos": ("o_orderkey", "o_custkey", "prioridade", "o_orderstatus"), "itens": ("l_orderkey", "l_partkey", "devolucao", "l_discount"),
    "pecas": ("p_partkey", "p_name"), "clientes": ("c_custkey", "c_name"),
}
_FILLED_SQL = _RULED_SQL + ", f AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, count(*) AS total, count({c}) AS preenchidas FROM {t}" for t, cs in _FILLED.items() for c in cs) + ") "


@query("completeness_profile", _FILLED_SQL + f"""
    SELECT *, CAST(CAST({rounded('preenchidas * 100', 'total', 0)} AS BIGINT) AS VARCHAR) || '%' AS cobertura FROM f""")
def completeness_profile(spark: SparkSession, folder: str) -> DataFrame:
    filled = quality.completeness(_ruled(StarTables(spark, folder)))
    return filled.withColumn("cobertura", _share("preenchidas", "total")).orderBy(
        F.col("preenchidas") / F.col("total"), "tabela", "coluna")


@query("completeness_by_table", _FILLED_SQL + f"""
    SELECT tabela, CAST(sum(total) AS BIGINT) AS total, CAST(sum(preenchidas) AS BIGINT) AS preenchidas,
           CAST(CAST({rounded('sum(preenchidas) * 100', 'sum(total)', 0)} AS BIGINT) AS VARCHAR) || '%' AS cobertura FROM f GROUP BY 1""")
def completeness_by_table(spark: SparkSession, folder: str) -> DataFrame:
    """Filled cells of each table, the least complete table first."""
    cells = quality.completeness(_ruled(StarTables(spark, folder))).groupBy("tabela").agg(
        F.sum("total").alias("total"), F.sum("preenchidas").alias("preenchidas"))
    return cells.withColumn("cobertura", _share("preenchidas", "total")).orderBy(F.col("preenchidas") / F.col("total"), "tabela")


@query("volume_check", " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS total FROM {name}" for name in sorted(SCHEMAS)))
def volume_check(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    return quality.volumes({name: s.read(name) for name in SCHEMAS})


@query("volume_from_footers", " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS total FROM {name}" for name in sorted(SCHEMAS)))
def volume_from_footers(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts without reading a data page."""
    return quality.volumes(read_for_footers(spark, star_paths(folder, SCHEMAS)))


_PROFILED = ("customer", "lineitem", "orders", "part")
_NUMERIC = ("int", "bigint", "double")


def _profile_sql(name: str) -> str:
    fields = (f.split(" ") for f in SCHEMAS[name].split(", "))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{c}' AS coluna, count(*) AS total, count({c}) AS preenchidas, "
        + (f"min({c})::DOUBLE AS menor, max({c})::DOUBLE AS maior" if kind in _NUMERIC else "NULL::DOUBLE AS menor, NULL::DOUBLE AS maior")
        + f" FROM {name}" for c, kind in fields)


@query("profile_from_footers", " UNION ALL ".join(map(_profile_sql, _PROFILED)))
def profile_from_footers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, filled rows and bounds of every column, from the footers of the files."""
    return column_profile(read_for_footers(spark, star_paths(folder, _PROFILED)))


# --- audit log ---------------------------------------------------------------


def event_changes(events: DataFrame) -> DataFrame:
    """Events as a change feed: each event inserts, updates or deletes its own row."""
    op = F.when(F.col("event_id") % 3 == 0, "INSERT").when(F.col("event_id") % 3 == 1, "UPDATE").otherwise("DELETE")
    row = F.struct("event_id", "user_id", "event_type", F.nullif(F.col("value"), F.lit(0.0)).alias("value"), "ts")
    return events.select(
        F.col("event_id").alias("change_id"), op.alias("op"), F.when(op != "INSERT", row).alias("before"), F.when(op != "DELETE", row).alias("after"),
        F.col("ts").alias("changed_at"))


def _comparable(log: DataFrame) -> DataFrame:
    """The log with its row images read back as fields: image texts differ between engines."""
    old, new = F.col("au_ds_dados_anteriores"), F.col("au_ds_dados_novos")
    return log.select(
        F.col("au_dt_operacao").cast("string").alias("quando"), "au_tp_operacao", "au_nm_tabela",
        "au_ds_chave_registro", "au_ds_usuario_sessao", "au_nu_ip_sessao", "au_ds_usuario_aplicacao",
        F.get_json_object(old, "$.event_type").alias("tipo_antes"),
        F.get_json_object(new, "$.event_type").alias("tipo_depois"),
        F.get_json_object(new, "$.user_id").cast("bigint").alias("usuario_depois"))


_EVENT_LOG = """
    SELECT rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS quando,
           CASE event_id % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'A' ELSE 'E' END AS au_tp_operacao, 'events' AS au_nm_tabela,
           'event_id=' || event_id || ';' AS au_ds_chave_registro, 'analista' AS au_ds_usuario_sessao,
           'local' AS au_nu_ip_sessao, 'painel' AS au_ds_usuario_aplicacao,
           CASE WHEN event_id % 3 <> 0 THEN event_type END AS tipo_antes,
           CASE WHEN event_id % 3 <> 2 THEN event_type END AS tipo_depois,
           CASE WHEN event_id % 3 <> 2 THEN user_id END AS usuario_depois
    FROM events"""


@query("audit_from_changes", _EVENT_LOG)
def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    feed = event_changes(StarTables(spark, folder).events)
    return _comparable(audit_from_changes(feed, "events", ["event_id"], ACTOR))


@query("audit_append_sink", _EVENT_LOG)
def audit_append_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "audit")
    return _comparable(audit_all(
        spark, folder, SCHEMAS["events"], "events.parquet", event_changes, "events", ["event_id"], ACTOR,
        f"{path}/log", f"{path}/checkpoint"))


@query("audit_key_text", """
    SELECT 'l_orderkey=' || l_orderkey || ';papel=' || coalesce(nullif(l_returnflag, 'N'), 'NULL') || ';' AS chave,
           count(*) AS n FROM lineitem GROUP BY 1""")
def audit_key_text(spark: SparkSession, folder: str) -> DataFrame:
    lines = StarTables(spark, folder).lineitem.select(
        "l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("papel"))
    return lines.groupBy(key_text(["l_orderkey", "papel"]).alias("chave")).agg(F.count("*").alias("n"))


_SNAPSHOT_DIFF = """
    WITH antes AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer WHERE c_custkey % 7 <> 0),
    depois AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 <> 0 THEN nullif(c_mktsegment, 'BUILDING') END AS seg
               FROM customer WHERE c_custkey % 11 <> 0)
    SELECT CASE WHEN a.c_custkey IS NULL THEN 'I' WHEN d.c_custkey IS NULL THEN 'E' ELSE 'A' END AS au_tp_operacao,
           'c_custkey=' || coalesce(d.c_custkey, a.c_custkey) || ';' AS au_ds_chave_registro,
           a.seg AS antes, d.seg AS depois
    FROM antes AS a FULL JOIN depois AS d ON a.c_custkey = d.c_custkey
    WHERE a.c_custkey IS NULL OR d.c_custkey IS NULL OR a.seg IS DISTINCT FROM d.seg"""


def _snapshot_log(spark: SparkSession, folder: str, changes) -> DataFrame:
    rows = StarTables(spark, folder).customer.select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    old = rows.filter(F.col("c_custkey") % 7 != 0)
    new = rows.filter(F.col("c_custkey") % 11 != 0).withColumn("seg", F.when(F.col("c_custkey") % 5 != 0, F.col("seg")))
    feed = changes(old, new, ["c_custkey"], F.current_timestamp())
    log = audit_from_changes(feed, "customer", ["c_custkey"], ACTOR)
    return log.select(
        "au_tp_operacao", "au_ds_chave_registro",
        F.get_json_object("au_ds_dados_anteriores", "$.seg").alias("antes"),
        F.get_json_object("au_ds_dados_novos", "$.seg").alias("depois"))


@query("audit_snapshot_diff", _SNAPSHOT_DIFF)
def audit_snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot_log(spark, folder, snapshot_changes)


@query("audit_digest_diff", _SNAPSHOT_DIFF)
def audit_digest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The same log; buckets of keys whose digests agree are not shuffled."""
    return _snapshot_log(spark, folder, snapshot_changes_by_digest)


_CLIENTS = Table(
    "clientes", (Column("c_custkey", _NUMBER), Column("c_name", _TEXT), Column("c_nationkey", T.IntegerType()), Column("c_mktsegment", _TEXT)),
    ("c_custkey",), unique=("c_name",), references={"c_nationkey": ("paises", "n_nationkey")},
    domains={"c_mktsegment": ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")})


@query("audit_checked_changes", """
    WITH feed AS (
        SELECT c_custkey AS change_id, c_custkey - CASE WHEN c_custkey % 20 = 7 THEN 4 ELSE 0 END AS k, c_name, c_nationkey, c_mktsegment,
               CASE c_custkey % 4 WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'INSERT' END AS op FROM customer)
    SELECT change_id, op, concat_ws('; ',
        CASE WHEN op <> 'DELETE' AND c_mktsegment = 'BUILDING' THEN 'check: c_mktsegment domain' END,
        CASE WHEN op = 'INSERT' AND (k % 5 = 0 OR change_id <> min(change_id) FILTER (op = 'INSERT') OVER (PARTITION BY k)) THEN 'pk: c_custkey' END,
        CASE WHEN op = 'INSERT' AND change_id % 5 = 0 THEN 'unique: c_name' END,
        CASE WHEN op <> 'DELETE' AND c_nationkey % 5 = 0 THEN 'fk: c_nationkey' END) AS regras
    FROM feed""")
def audit_checked_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Every change with the rules it breaks: accepted changes and rejected ones together are the feed."""
    s = StarTables(spark, folder)
    op = F.when(F.col("c_custkey") % 4 == 1, "UPDATE").when(F.col("c_custkey") % 4 == 2, "DELETE").otherwise("INSERT")
    again = F.col("c_custkey") - F.when(F.col("c_custkey") % 20 == 7, 4).otherwise(0)  # a key that another change brings
    old = F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    new = F.struct(again.alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    feed = s.customer.select(F.col("c_custkey").alias("change_id"), op.alias("op"), F.when(op != "INSERT", old).alias("before"),
                             F.when(op != "DELETE", new).alias("after"), F.lit("2024-01-01").cast("timestamp_ntz").alias("changed_at"))
    held = s.customer.filter(F.col("c_custkey") % 5 == 0)
    checked = checked_batch(feed, _CLIENTS, held, {"paises": s.nation.filter(F.col("n_nationkey") % 5 != 0)})
    return checked.select("change_id", "op", F.concat_ws("; ", "broken_rules").alias("regras"))


@query("audit_checked_stream", """
    WITH feed AS (
        SELECT c_custkey AS change_id, c_nationkey % 5 <> 0 AS known, c_mktsegment <> 'BUILDING' AS coded, FALSE AS again FROM customer
        UNION ALL SELECT 1000000000 + c_custkey, c_nationkey % 5 <> 0, c_mktsegment <> 'BUILDING', TRUE FROM customer WHERE c_custkey % 3 = 0)
    SELECT change_id, concat_ws('; ', CASE WHEN NOT coded THEN 'check: c_mktsegment domain' END,
        CASE WHEN again AND known AND coded THEN 'pk: c_custkey' END, CASE WHEN NOT known THEN 'fk: c_nationkey' END) AS regras
    FROM feed""")
def audit_checked_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads through a stream that judges them against the stored table: a third of the rows come again under a new name."""
    s, path = StarTables(spark, folder), new_path(spark, "checked")
    store = CheckedStore(f"{path}/store", _CLIENTS, {"paises": s.nation.filter(F.col("n_nationkey") % 5 != 0)}, ACTOR)

    def load(rows: DataFrame, offset: int, suffix: str) -> None:
        row = F.struct("c_custkey", F.concat("c_name", F.lit(suffix)).alias("c_name"), "c_nationkey", "c_mktsegment")
        feed = rows.select((F.col("c_custkey") + offset).alias("change_id"), F.lit("INSERT").alias("op"), F.lit(None).cast(_CLIENTS.struct).alias("before"),
                           row.alias("after"), F.lit("2024-01-01").cast("timestamp_ntz").alias("changed_at"))
        feed.write.mode("append").parquet(f"{path}/feed")
        store.start(change_stream(spark, f"{path}/feed", feed.schema)).awaitTermination()

    load(s.customer, 0, "")
    load(s.customer.filter(F.col("c_custkey") % 3 == 0), 10**9, " bis")
    return store.changes(spark).select("change_id", F.concat_ws("; ", "broken_rules").alias("regras"))
