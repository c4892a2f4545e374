"""Sources, sinks, projections, predicates, joins, subqueries, aggregates, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadmetric.catalog.registry import query
from acadmetric.catalog.views_sql import rounded, with_views
from acadmetric.functions.exact import half_up, half_up_mean, half_up_percent
from acadmetric.operators.ordered import exact_percentile, row_numbers
from acadmetric.schema import INDICATOR_TYPES
from acadmetric.session import new_path, written
from acadmetric.sources import layout, serials
from acadmetric.sources import tables as store
from acadmetric.sources.driver import StarTables
from acadmetric.sources.views import evaluation_views


def _number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def _day(column: str) -> Column:
    return F.to_date(column).cast("string")


def _count(name: str = "n") -> Column:
    return F.count("*").alias(name)


# --- sources and sinks -------------------------------------------------------


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).customer


@query("series_source", """
    SELECT g, o_orderstatus FROM (SELECT unnest(range(0, max(o_orderkey) + 1)) AS g FROM orders)
    LEFT JOIN orders ON o_orderkey = g""")
def series_source(spark: SparkSession, folder: str) -> DataFrame:
    orders = StarTables(spark, folder).orders.select("o_orderkey", "o_orderstatus")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    series = spark.range(0, 0 if last is None else last + 1).withColumnRenamed("id", "g")
    return series.join(orders, F.col("g") == F.col("o_orderkey"), "left").select("g", "o_orderstatus")


@query("literal_rows", """
    SELECT ano, codigo, count(o_orderkey) AS n
    FROM (VALUES (1995), (1996), (1997), (2030)) AS y(ano) CROSS JOIN (VALUES ('F'), ('O')) AS t(codigo)
    LEFT JOIN orders ON year(o_orderdate) = ano AND o_orderstatus = codigo GROUP BY 1, 2""")
def literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    grid = spark.sql("""
        SELECT * FROM VALUES (1995, 'F'), (1995, 'O'), (1996, 'F'), (1996, 'O'),
                             (1997, 'F'), (1997, 'O'), (2030, 'F'), (2030, 'O') AS y(ano, codigo)""")
    counts = StarTables(spark, folder).orders.groupBy(
        F.year("o_orderdate").alias("ano"), F.col("o_orderstatus").alias("codigo")).agg(_count())
    return grid.join(counts, ["ano", "codigo"], "left").select("ano", "codigo", F.coalesce("n", F.lit(0)).alias("n"))


@query("insert_select", """
    SELECT s_suppkey AS id, s_name AS nome FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""")
def insert_select(spark: SparkSession, folder: str) -> DataFrame:
    s, path = StarTables(spark, folder), new_path(spark, "insert")
    store.append(s.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome")), path)
    return store.append(s.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")), path)


@query("truncate_load", "SELECT o_orderkey, o_orderstatus FROM orders")
def truncate_load(spark: SparkSession, folder: str) -> DataFrame:
    rows, path = StarTables(spark, folder).orders.select("o_orderkey", "o_orderstatus"), new_path(spark, "load")
    store.replace(rows, path)
    return store.replace(rows, path)


_INSERT_IGNORE = """
    WITH held AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A'),
    fresh AS (SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 1 THEN 'AP' ELSE 'CA' END AS papel,
                     row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber) AS pos FROM lineitem)
    SELECT l_orderkey, l_partkey, 'AP' AS papel FROM held
    UNION ALL
    SELECT l_orderkey, l_partkey, papel FROM fresh ANTI JOIN held USING (l_orderkey, l_partkey) WHERE pos = 1"""


@query("insert_ignore_duplicates", _INSERT_IGNORE)
def insert_ignore_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    lines, path, key = StarTables(spark, folder).lineitem, new_path(spark, "authors"), ["l_orderkey", "l_partkey"]
    held = lines.filter(F.col("l_returnflag") == "A").select(*key).distinct().withColumn("papel", F.lit("AP"))
    stored = store.append(held, path)
    incoming = lines.select(
        *key, F.when(F.col("l_linenumber") == 1, "AP").otherwise("CA").alias("papel"), "l_linenumber")
    return store.append(store.insert_ignore(stored, incoming, key, ["l_linenumber"]).select(*key, "papel"), path)


@query("insert_ignore_by_ranges", _INSERT_IGNORE)
def insert_ignore_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The same insert into a table stored in key order: files whose range no incoming key falls into are not read."""
    lines, path, key = StarTables(spark, folder).lineitem, new_path(spark, "authors"), ["l_orderkey", "l_partkey"]
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = lines.filter(F.col("l_returnflag") == "A").select(*key).distinct().withColumn("papel", F.lit("AP"))
    layout.store_ordered(held, path, key, files)
    incoming = lines.select(*key, F.when(F.col("l_linenumber") == 1, "AP").otherwise("CA").alias("papel"), "l_linenumber")
    return layout.insert_ignore_ordered(spark, path, incoming, key, ["l_linenumber"], files)


@query("serial_key", "SELECT s_name, row_number() OVER (ORDER BY s_name, s_suppkey) AS id FROM supplier")
def serial_key(spark: SparkSession, folder: str) -> DataFrame:
    named = StarTables(spark, folder).supplier.select("s_name", "s_suppkey")
    return row_numbers(named, [("s_name", False), ("s_suppkey", False)], "id").select("s_name", "id")


@query("serial_key_continued", """
    SELECT row_number() OVER (ORDER BY carga, nome, chave) AS id, nome, chave
    FROM (SELECT 1 AS carga, s_name AS nome, s_suppkey AS chave FROM supplier UNION ALL SELECT 2, c_name, c_custkey FROM customer)""")
def serial_key_continued(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads into one table; the second goes on where the first ended."""
    s, path = StarTables(spark, folder), new_path(spark, "serial")
    order = [("nome", False), ("chave", False)]
    loads = (s.supplier.select(F.col("s_name").alias("nome"), F.col("s_suppkey").alias("chave")),
             s.customer.select(F.col("c_name").alias("nome"), F.col("c_custkey").alias("chave")))
    tables = [serials.append_numbered(load, f"{path}/table", f"{path}/sequence", "id", order) for load in loads]
    return tables[-1]


_NEAR = {"l_suppkey": "l_suppkey BETWEEN 3 AND 9", "l_partkey": "l_partkey BETWEEN 20 AND 60"}


@query("layout_by_several_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, {c} AS chave, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(10,2))) AS DOUBLE) AS q "
    f"FROM lineitem WHERE {condition} GROUP BY 2" for c, condition in _NEAR.items()))
def layout_by_several_columns(spark: SparkSession, folder: str) -> DataFrame:
    """All lines stored once, read by a range of either column from a part of the files."""
    path = new_path(spark, "interleaved")
    lines = StarTables(spark, folder).lineitem.select("l_suppkey", "l_partkey", "l_quantity")
    layout.store_interleaved(lines, path, ["l_suppkey", "l_partkey"], 4 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                             bloom=["l_suppkey", "l_partkey"])
    parts = [layout.read_between(spark, path, c, low, high).groupBy(F.lit(c).alias("coluna"), F.col(c).alias("chave")).agg(
        _count(), _number(F.sum(F.col("l_quantity").cast("decimal(10,2)"))).alias("q"))
        for c, low, high in (("l_suppkey", 3, 9), ("l_partkey", 20, 60))]
    return reduce(DataFrame.unionByName, parts)


@query("layout_by_key", """
    SELECT s_name, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(10,2))) AS DOUBLE) AS q
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1""")
def layout_by_key(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "layout")
    name = f"t_{path[-32:]}"
    lines = store.lay_out_by_key(
        s.lineitem.select("l_suppkey", "l_quantity"), f"{name}_lines", f"{path}/lines", ["l_suppkey"], buckets)
    suppliers = store.lay_out_by_key(
        s.supplier.select("s_suppkey", "s_name"), f"{name}_suppliers", f"{path}/suppliers", ["s_suppkey"], buckets)
    per_key = lines.groupBy("l_suppkey").agg(_count(), F.sum(F.col("l_quantity").cast("decimal(10,2)")).alias("q"))
    return suppliers.join(per_key, F.col("s_suppkey") == F.col("l_suppkey")).select("s_name", "n", _number("q").alias("q"))


@query("layout_by_two_keys", """
    SELECT l_suppkey, l_partkey, count(*) AS n, count(DISTINCT l_orderkey) AS pedidos FROM lineitem GROUP BY 1, 2""")
def layout_by_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "layout")
    lines = store.lay_out_by_key(
        StarTables(spark, folder).lineitem.select("l_suppkey", "l_partkey", "l_orderkey"), f"t_{path[-32:]}", path,
        ["l_suppkey", "l_partkey"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    per_order = lines.groupBy("l_suppkey", "l_partkey", "l_orderkey").agg(_count())
    return per_order.groupBy("l_suppkey", "l_partkey").agg(F.sum("n").alias("n"), _count("pedidos"))


@query("partial_subset", """
    SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'A' GROUP BY 1""")
def partial_subset(spark: SparkSession, folder: str) -> DataFrame:
    lines = StarTables(spark, folder).lineitem.select("l_suppkey", "l_linestatus", "l_returnflag")
    subset = store.store_subset(lines, F.col("l_linestatus") == "F", "l_returnflag", new_path(spark, "subset"))
    return subset.filter(F.col("l_returnflag") == "A").groupBy("l_suppkey").agg(_count())


# --- projections and predicates ----------------------------------------------


@query("project_columns", "SELECT o_orderkey AS pedido, o_orderstatus AS estado FROM orders")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.select(
        F.col("o_orderkey").alias("pedido"), F.col("o_orderstatus").alias("estado"))


@query("project_expr", """
    SELECT o_orderkey, year(o_orderdate) AS ano, o_custkey * 2 + 1 AS codigo FROM orders""")
def project_expr(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("ano"), (F.col("o_custkey") * 2 + 1).alias("codigo"))


@query("filter_eq", "SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1")
def filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).lineitem.filter(F.col("l_linestatus") == "O").groupBy("l_suppkey").agg(_count())


@query("filter_not_null", """
    SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS qualis FROM orders
    WHERE nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL""")
def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    qualis = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("qualis")
    return StarTables(spark, folder).orders.select("o_orderkey", qualis).filter(F.col("qualis").isNotNull())


@query("filter_compound", """
    SELECT o_orderkey FROM orders
    WHERE (nullif(o_orderpriority, '4-NOT SPECIFIED') IS NULL OR nullif(o_orderpriority, '4-NOT SPECIFIED') = '5-LOW')
      AND NOT (o_orderstatus = 'P') AND o_totalprice >= 1000""")
def filter_compound(spark: SparkSession, folder: str) -> DataFrame:
    qualis = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    keep = (qualis.isNull() | (qualis == "5-LOW")) & ~(F.col("o_orderstatus") == "P") & (F.col("o_totalprice") >= 1000)
    return StarTables(spark, folder).orders.filter(keep).select("o_orderkey")


@query("filter_in_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def filter_in_list(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.filter(F.col("o_orderstatus").isin("F", "P")).select(
        "o_orderkey", "o_orderstatus")


@query("filter_between", """
    SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber BETWEEN 2 AND 5 GROUP BY 1""")
def filter_between(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).lineitem.filter(F.col("l_linenumber").between(2, 5)).groupBy(
        "l_linenumber").agg(_count())


@query("filter_like_escaped", r"SELECT n_nationkey, n_name FROM nation WHERE n_name LIKE 'NATION\_1%' ESCAPE '\'")
def filter_like_escaped(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).nation.filter(F.col("n_name").like(r"NATION\_1%")).select("n_nationkey", "n_name")


@query("filter_ratio", """
    WITH q AS (SELECT l_suppkey, count(*) AS linhas, count(DISTINCT l_partkey) AS pecas FROM lineitem GROUP BY 1)
    SELECT * FROM q WHERE linhas * (SELECT sum(pecas) FROM q) > pecas * (SELECT sum(linhas) FROM q)""")
def filter_ratio(spark: SparkSession, folder: str) -> DataFrame:
    # Parts are counted through (supplier, part) groups, which also carry the line counts.
    pairs = StarTables(spark, folder).lineitem.groupBy("l_suppkey", "l_partkey").agg(_count())
    counts = written(pairs.groupBy("l_suppkey").agg(F.sum("n").alias("linhas"), F.count("*").alias("pecas")), "ratio")
    whole = "decimal(38,0)"
    sums = counts.agg(F.sum("linhas").cast(whole).alias("linhas"), F.sum("pecas").cast(whole).alias("pecas"))
    return counts.filter(
        F.col("linhas") * sums.select("pecas").scalar() > F.col("pecas") * sums.select("linhas").scalar())


@query("soft_delete_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def soft_delete_filter(spark: SparkSession, folder: str) -> DataFrame:
    flagged = StarTables(spark, folder).orders.withColumn(
        "st_registro_ativo", F.when(F.col("o_orderstatus") == "P", "N").otherwise("S"))
    return store.active(flagged).select("o_orderkey", "o_orderstatus")


@query("case_when", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'concluido' WHEN o_totalprice > 250000 THEN 'grande'
                            ELSE 'comum' END AS classe FROM orders""")
def case_when(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "concluido").when(F.col("o_totalprice") > 250000, "grande")
    return StarTables(spark, folder).orders.select("o_orderkey", kind.otherwise("comum").alias("classe"))


# --- joins -------------------------------------------------------------------


@query("join_inner_equi", """
    SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def join_inner_equi(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    return s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")


@query("join_multiway", """
    SELECT r_name, o_orderstatus, count(*) AS n
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey
    JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def join_multiway(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    places = (
        s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(s.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name"))
    return (
        s.lineitem.select("l_orderkey", "l_suppkey")
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "r_name").agg(_count("lines"))
        .join(s.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("r_name", "o_orderstatus").agg(F.sum("lines").alias("n")))


@query("join_bridge_nn", with_views("link author", """
    SELECT prog_id, count(*) AS caminhos FROM link JOIN author USING (fac_id) GROUP BY 1"""))
def join_bridge_nn(spark: SparkSession, folder: str) -> DataFrame:
    t = evaluation_views(spark, folder)
    per_author = t["rt_producao_docente"].groupBy("co_seq_docente").agg(_count())
    return (
        t["rt_programa_docente"].join(per_author, "co_seq_docente")
        .groupBy(F.col("co_seq_programa").alias("prog_id")).agg(F.sum("n").alias("caminhos")))


@query("join_on_filter", with_views("report program", """
    SELECT prog_name, grade FROM program JOIN report ON report.prog_id = program.prog_id AND report.kind = 'QU'
    WHERE grade IS NOT NULL"""))
def join_on_filter(spark: SparkSession, folder: str) -> DataFrame:
    t = evaluation_views(spark, folder)
    final = t["tb_relatorio"].filter((F.col("tp_relatorio") == "QU") & F.col("nu_conceito_final").isNotNull())
    return t["tb_programa"].join(final, "co_seq_programa").select(
        F.col("nm_programa").alias("prog_name"), F.col("nu_conceito_final").alias("grade"))


@query("join_left_outer", """
    SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier
    ON s_nationkey = n_nationkey AND s_acctbal > 9000 GROUP BY 1""")
def join_left_outer(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    rich = s.supplier.filter(F.col("s_acctbal") > 9000).groupBy("s_nationkey").agg(_count())
    return s.nation.join(rich, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        "n_name", F.coalesce("n", F.lit(0)).alias("n"))


@query("join_cross_grid", f"""
    SELECT s_suppkey, ano, tipo FROM supplier CROSS JOIN (SELECT unnest(range(2022, 2026)) AS ano)
    CROSS JOIN (SELECT unnest({list(INDICATOR_TYPES)}) AS tipo)""")
def join_cross_grid(spark: SparkSession, folder: str) -> DataFrame:
    # Both literal sides are fixed lists, so the grid is a generator on each parent row: no join, no shuffle.
    years = F.explode(F.sequence(F.lit(2022).cast("bigint"), F.lit(2025).cast("bigint"))).alias("ano")
    kinds = F.explode(F.array(*[F.lit(k) for k in INDICATOR_TYPES])).alias("tipo")
    return StarTables(spark, folder).supplier.select("s_suppkey", years).select("s_suppkey", "ano", kinds)


@query("join_cross_lateral", """
    SELECT o_orderkey, CAST(ini AS VARCHAR) AS ini, CAST(ini + CAST(o_orderkey % 30 AS INT) AS VARCHAR) AS fim
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_custkey % 7 AS INT) AS ini FROM orders)""")
def join_cross_lateral(spark: SparkSession, folder: str) -> DataFrame:
    start = F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 7).cast("int"))
    end = F.date_add("ini", (F.col("o_orderkey") % 30).cast("int"))
    return StarTables(spark, folder).orders.withColumn("ini", start).withColumn("fim", end).select(
        "o_orderkey", F.col("ini").cast("string").alias("ini"), F.col("fim").cast("string").alias("fim"))


@query("join_lateral_unnest", """
    SELECT ord, origem, destino, count(*) AS n, CAST(sum(valor) AS BIGINT) AS soma
    FROM (SELECT 1 AS ord, 'l_partkey' AS origem, 'p_partkey' AS destino, l_partkey AS valor FROM lineitem
          UNION ALL SELECT 2, 'l_suppkey', 's_suppkey', l_suppkey FROM lineitem) GROUP BY 1, 2, 3""")
def join_lateral_unnest(spark: SparkSession, folder: str) -> DataFrame:
    lines = StarTables(spark, folder).lineitem.select(
        F.array(F.lit("l_partkey"), F.lit("l_suppkey")).alias("origem"),
        F.array(F.lit("p_partkey"), F.lit("s_suppkey")).alias("destino"),
        F.array("l_partkey", "l_suppkey").alias("valor"))
    zipped = lines.select(F.posexplode(F.arrays_zip("origem", "destino", "valor")).alias("pos", "par"))
    return (
        zipped.groupBy((F.col("pos") + 1).alias("ord"), "par.origem", "par.destino")
        .agg(_count(), F.sum("par.valor").alias("soma")))


@query("join_self_pivot", """
    SELECT a.o_orderpriority AS prioridade, a.n AS antes, b.n AS depois
    FROM (SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1) AS a
    JOIN (SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1) AS b
    USING (o_orderpriority)""")
def join_self_pivot(spark: SparkSession, folder: str) -> DataFrame:
    def of(year: int, name: str) -> Column:
        return F.count(F.when(F.year("o_orderdate") == year, 1)).alias(name)

    orders = StarTables(spark, folder).orders.filter(
        (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")))
    phases = orders.groupBy(F.col("o_orderpriority").alias("prioridade")).agg(
        of(1995, "antes"), of(1996, "depois"))
    return phases.filter((F.col("antes") > 0) & (F.col("depois") > 0))


# --- subqueries --------------------------------------------------------------


@query("subq_scalar_where", """
    SELECT o_orderstatus, count(*) AS n FROM orders
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1""")
def subq_scalar_where(spark: SparkSession, folder: str) -> DataFrame:
    orders = StarTables(spark, folder).orders
    # A range on the column itself can be pushed to the scan; no order is later than the last year's end.
    begin = orders.agg(F.date_trunc("year", F.max("o_orderdate")).cast("timestamp_ntz")).scalar()
    return orders.filter(F.col("o_orderdate") >= begin).groupBy("o_orderstatus").agg(_count())


@query("subq_scalar_having", """
    SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1
    HAVING count(*) > (SELECT avg(c) FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey))""")
def subq_scalar_having(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).orders.groupBy("o_custkey").agg(_count())
    return counts.filter(F.col("n") > counts.agg(F.avg("n")).scalar())


@query("subq_scalar_select", f"""
    SELECT event_type, count(*) AS n, {rounded('count(*) * 100', '(SELECT count(*) FROM events)', 2)} AS perc
    FROM events GROUP BY 1""")
def subq_scalar_select(spark: SparkSession, folder: str) -> DataFrame:
    events = StarTables(spark, folder).events
    total = events.agg(F.count("*")).scalar()
    counts = events.groupBy("event_type").agg(_count()).withColumn("total", total)
    return counts.select("event_type", "n", half_up_percent(F.col("n"), F.col("total"), 2).alias("perc"))


@query("subq_corr_scalar_count", """
    SELECT n_name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) AS fornecedores,
           (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS clientes FROM nation""")
def subq_corr_scalar_count(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    sellers = s.supplier.filter(F.col("s_acctbal") > 5000).groupBy("s_nationkey").agg(_count("a"))
    buyers = s.customer.groupBy("c_nationkey").agg(_count("b"))
    return (
        s.nation.join(sellers, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .join(buyers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select("n_name", F.coalesce("a", F.lit(0)).alias("fornecedores"), F.coalesce("b", F.lit(0)).alias("clientes")))


@query("subq_corr_count_distinct", """
    SELECT s_suppkey, (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_suppkey = s_suppkey) AS pecas
    FROM supplier""")
def subq_corr_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    parts = s.lineitem.select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(_count())
    return s.supplier.join(parts, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "s_suppkey", F.coalesce("n", F.lit(0)).alias("pecas"))


@query("subq_corr_where", """
    SELECT p_partkey FROM part
    WHERE (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) > 0""")
def subq_corr_where(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    sold = s.lineitem.filter(F.col("l_quantity") > 49).select("l_partkey")
    return s.part.select("p_partkey").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left_semi")


@query("subq_corr_having_nested", with_views("student program", """
    SELECT prog_name, area_id, n FROM per WHERE n > (SELECT avg(o.n) FROM per AS o WHERE o.area_id = per.area_id)""",
    "per AS (SELECT prog_name, area_id, count(*) AS n FROM student JOIN program USING (prog_id) GROUP BY prog_id, 1, 2)"))
def subq_corr_having_nested(spark: SparkSession, folder: str) -> DataFrame:
    t = evaluation_views(spark, folder)
    counts = t["tb_discente"].groupBy("co_seq_programa").agg(_count()).join(t["tb_programa"], "co_seq_programa")
    means = counts.groupBy("co_seq_area").agg(F.sum("n").alias("s"), F.count("*").alias("k"))
    return counts.join(means, "co_seq_area").filter(F.col("n") * F.col("k") > F.col("s")).select(
        F.col("nm_programa").alias("prog_name"), F.col("co_seq_area").alias("area_id"), "n")


@query("subq_in_semi", """
    SELECT o_custkey, count(*) AS n FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) >= 6)
    GROUP BY 1""")
def subq_in_semi(spark: SparkSession, folder: str) -> DataFrame:
    # The condition and the count share the grouping key: one pass instead of a semi-join with itself.
    yearly = StarTables(spark, folder).orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(_count("k"))
    return yearly.groupBy("o_custkey").agg(F.count("*").alias("years"), F.sum("k").alias("n")).filter(
        F.col("years") >= 6).select("o_custkey", "n")


@query("subq_not_exists_anti", with_views("student link", """
    SELECT prog_id, count(*) AS n FROM student WHERE NOT EXISTS (
        SELECT 1 FROM link WHERE link.prog_id = student.prog_id AND link.fac_id = student.fac_id AND kind = 'PE')
    GROUP BY 1"""))
def subq_not_exists_anti(spark: SparkSession, folder: str) -> DataFrame:
    t = evaluation_views(spark, folder)
    advised = t["tb_discente"].groupBy(
        "co_seq_programa", F.col("co_seq_docente_orientador").alias("co_seq_docente")).agg(_count("k"))
    permanent = t["rt_programa_docente"].filter(F.col("tp_vinculo") == "PE")
    return advised.join(permanent, ["co_seq_programa", "co_seq_docente"], "left_anti").groupBy(
        F.col("co_seq_programa").alias("prog_id")).agg(F.sum("k").alias("n"))


@query("subq_from_derived", """
    SELECT max(n) AS maior, min(n) AS menor FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)""")
def subq_from_derived(spark: SparkSession, folder: str) -> DataFrame:
    yearly = StarTables(spark, folder).orders.groupBy(F.year("o_orderdate")).agg(_count())
    return yearly.agg(F.max("n").alias("maior"), F.min("n").alias("menor"))


@query("cte_single", """
    WITH totais AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS t FROM orders GROUP BY 1)
    SELECT o_custkey, CAST(t AS DOUBLE) AS total FROM totais WHERE t > 2000000""")
def cte_single(spark: SparkSession, folder: str) -> DataFrame:
    totals = StarTables(spark, folder).orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("t"))
    return totals.filter(F.col("t") > 2000000).select("o_custkey", _number("t").alias("total"))


@query("cte_reused", """
    WITH anos AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_custkey, y, n FROM anos
    WHERE o_custkey IN (SELECT o_custkey FROM anos GROUP BY 1 HAVING max(n) >= 4)""")
def cte_reused(spark: SparkSession, folder: str) -> DataFrame:
    years = StarTables(spark, folder).orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("y")).agg(_count())
    busy = years.groupBy("o_custkey").agg(F.max("n").alias("m")).filter(F.col("m") >= 4).select("o_custkey")
    return years.join(busy, "o_custkey", "left_semi")


# --- aggregates --------------------------------------------------------------


@query("agg_count_star", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def agg_count_star(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.groupBy("o_orderstatus").agg(_count())


@query("agg_count_col", """
    SELECT o_orderstatus, count(nullif(o_orderpriority, '4-NOT SPECIFIED')) AS n FROM orders GROUP BY 1""")
def agg_count_col(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.groupBy("o_orderstatus").agg(
        F.count(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))).alias("n"))


@query("agg_count_distinct", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1")
def agg_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n"))


@query("agg_multi_distinct", """
    SELECT l_suppkey, count(DISTINCT l_orderkey) AS pedidos, count(DISTINCT l_partkey) AS pecas
    FROM lineitem GROUP BY 1""")
def agg_multi_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).lineitem.groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("pedidos"), F.countDistinct("l_partkey").alias("pecas"))


@query("agg_sum_decimal", """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def agg_sum_decimal(spark: SparkSession, folder: str) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(15,2)"))
    return StarTables(spark, folder).orders.groupBy("o_custkey").agg(_number(total).alias("total"))


@query("agg_avg", with_views("opinion", f"""
    SELECT prog_id, {rounded('sum(cents)', 'count(*) * 100', 2)} AS media FROM opinion GROUP BY 1"""))
def agg_avg(spark: SparkSession, folder: str) -> DataFrame:
    scores = evaluation_views(spark, folder)["tb_parecer"]
    sums = scores.groupBy(F.col("co_seq_programa").alias("prog_id")).agg(F.sum("vl_nota").alias("s"), _count())
    return sums.select("prog_id", half_up_mean(F.col("s"), F.col("n"), 2, 2).alias("media"))


@query("agg_min_max", """
    SELECT o_custkey, min(year(o_orderdate)) AS primeiro, max(year(o_orderdate)) AS ultimo FROM orders GROUP BY 1""")
def agg_min_max(spark: SparkSession, folder: str) -> DataFrame:
    year = F.year("o_orderdate").cast("bigint")
    return StarTables(spark, folder).orders.groupBy("o_custkey").agg(
        F.min(year).alias("primeiro"), F.max(year).alias("ultimo"))


@query("agg_stddev", "SELECT event_type, round(stddev_samp(value), 6) AS desvio FROM events GROUP BY 1")
def agg_stddev(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).events.groupBy("event_type").agg(
        F.round(F.stddev_samp("value"), 6).alias("desvio"))


@query("agg_percentile_cont", """
    SELECT percentile_cont(0.9) WITHIN GROUP (ORDER BY n) AS corte
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)""")
def agg_percentile_cont(spark: SparkSession, folder: str) -> DataFrame:
    # Parts are counted by their number of lines first: the exact percentile holds one entry per number.
    per_part = StarTables(spark, folder).lineitem.groupBy("l_partkey").agg(_count("c"))
    return per_part.groupBy("c").agg(_count()).agg(F.percentile("c", F.lit(0.9), F.col("n")).alias("corte"))


@query("agg_percentile_exact", "SELECT percentile_cont(0.9) WITHIN GROUP (ORDER BY l_extendedprice) AS corte FROM lineitem")
def agg_percentile_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Of amounts, which are nearly all different: sought by refinement rather than gathered."""
    return exact_percentile(StarTables(spark, folder).lineitem, "l_extendedprice", 0.9, name="corte")


@query("agg_filtered_count", """
    SELECT event_type, count(*) FILTER (event_id % 3 = 0) AS insercoes, count(*) FILTER (event_id % 3 = 1) AS alteracoes
    FROM events GROUP BY 1""")
def agg_filtered_count(spark: SparkSession, folder: str) -> DataFrame:
    def of(rest: int, name: str) -> Column:
        return F.count(F.when(F.col("event_id") % 3 == rest, 1)).alias(name)

    return StarTables(spark, folder).events.groupBy("event_type").agg(of(0, "insercoes"), of(1, "alteracoes"))


@query("agg_string_ordered", """
    SELECT r_name, string_agg(n_name, '/' ORDER BY n_name) AS nomes
    FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""")
def agg_string_ordered(spark: SparkSession, folder: str) -> DataFrame:
    # The result itself is one text per group, so a group has to fit in one row in any engine.
    s = StarTables(spark, folder)
    names = F.array_join(F.array_sort(F.collect_list("n_name")), "/")
    return s.nation.join(s.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(
        names.alias("nomes"))


@query("agg_global", """
    SELECT count(*) AS n, max(o_custkey) AS maior, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total
    FROM orders""")
def agg_global(spark: SparkSession, folder: str) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(15,2)"))
    return StarTables(spark, folder).orders.agg(_count(), F.max("o_custkey").alias("maior"), _number(total).alias("total"))


@query("agg_of_agg", f"""
    SELECT c_nationkey, {rounded('sum(n)', 'count(*)', 2)} AS media
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def agg_of_agg(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    counts = s.orders.groupBy("o_custkey").agg(_count())
    return (
        counts.join(s.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum("n").alias("s"), F.count("*").alias("k"))
        .select("c_nationkey", half_up(F.col("s"), F.col("k"), 2).alias("media")))


@query("agg_having", """
    SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 25 AND max(l_quantity) = 50""")
def agg_having(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).lineitem.groupBy("l_partkey").agg(_count(), F.max("l_quantity").alias("m"))
    return counts.filter((F.col("n") > 25) & (F.col("m") == 50)).select("l_partkey", "n")


@query("agg_hidden_key", "SELECT p_name, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_name")
def agg_hidden_key(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    counts = s.lineitem.groupBy("l_partkey").agg(_count())
    return counts.join(s.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select("p_name", "n")


@query("agg_group_positional", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_group_positional(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lines} GROUP BY 1, 2",
        lines=StarTables(spark, folder).lineitem)


@query("agg_ratio_pct", f"""
    SELECT l_returnflag, {rounded("count(*) FILTER (l_linestatus = 'F') * 100", 'count(*)', 1)} AS perc
    FROM lineitem GROUP BY 1""")
def agg_ratio_pct(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).lineitem.groupBy("l_returnflag").agg(
        F.count(F.when(F.col("l_linestatus") == "F", 1)).alias("f"), _count())
    return counts.select("l_returnflag", half_up_percent(F.col("f"), F.col("n"), 1).alias("perc"))


# --- sorts and set operations ------------------------------------------------


@query("sort_multi_mixed", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, n DESC, 2""")
def sort_multi_mixed(spark: SparkSession, folder: str) -> DataFrame:
    counts = StarTables(spark, folder).orders.groupBy("o_orderstatus", "o_orderpriority").agg(_count())
    return counts.orderBy(F.asc_nulls_last("o_orderstatus"), F.desc_nulls_first("n"), "o_orderpriority")


@query("sort_nulls_last", f"""
    SELECT s_suppkey, {rounded('a', 'nullif(s_suppkey % 4, 0)', 2)} AS razao
    FROM (SELECT s_suppkey, count(*) AS a FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1)
    ORDER BY 2 DESC NULLS LAST, 1""")
def sort_nulls_last(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    counts = s.lineitem.groupBy("l_suppkey").agg(_count("a"))
    ratio = half_up(F.col("a"), F.col("s_suppkey") % 4, 2)
    return (
        s.supplier.join(counts, F.col("s_suppkey") == F.col("l_suppkey")).select("s_suppkey", ratio.alias("razao"))
        .orderBy(F.desc_nulls_last("razao"), "s_suppkey"))


@query("sort_by_expression", """
    SELECT c_custkey, c_name FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey""")
def sort_by_expression(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).customer.orderBy(F.abs("c_acctbal").desc(), "c_custkey").select(
        "c_custkey", "c_name")


@query("topk_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_global(spark: SparkSession, folder: str) -> DataFrame:
    return StarTables(spark, folder).orders.select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(20)


_NAMED = {  # one text and one number of each given table
    "region": ("r_name", "r_regionkey"), "nation": ("n_name", "n_nationkey"), "customer": ("c_name", "c_custkey"),
    "supplier": ("s_name", "s_suppkey"), "part": ("p_name", "p_partkey"), "orders": ("o_orderstatus", "o_orderkey"),
    "lineitem": ("l_returnflag", "l_orderkey"), "events": ("event_type", "event_id"), "documents": ("lang", "doc_id"),
    "embeddings": (None, "vec_id"), "pages": ("url", "page_id"), "benchmark": (None, "item_id"),
    "labels": (None, "doc_id"), "conversations": ("role", "conv_id"),
}


@query("union_all", " UNION ALL ".join(
    f"SELECT '{table}' AS origem, CAST({text or 'NULL'} AS VARCHAR) AS nome, CAST({number} AS BIGINT) AS numero FROM {table}"
    for table, (text, number) in _NAMED.items()))
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    s = StarTables(spark, folder)
    parts = [
        s.read(table).select(F.lit(table).alias("origem"), (F.col(text) if text else F.lit(None)).cast("string").alias("nome"),
                             F.col(number).cast("bigint").alias("numero"))
        for table, (text, number) in _NAMED.items()]
    return reduce(DataFrame.unionAll, parts)
