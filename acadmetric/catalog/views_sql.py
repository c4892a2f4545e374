"""The logical views as SQL, for checks that start from the evaluation schema."""

from __future__ import annotations

VIEWS = {
    "area": "SELECT r_regionkey AS area_id, r_name AS area_name FROM region",
    "nation_area": "SELECT n_nationkey AS area_id, n_name AS area_name FROM nation",
    "institution": "SELECT n_nationkey AS inst_id, n_name AS inst_name FROM nation",
    "program": """
        SELECT s_suppkey AS prog_id, s_name AS prog_name, s_nationkey AS inst_id, n_regionkey AS area_id,
               CASE WHEN s_suppkey % 6 = 0 THEN 'DO' WHEN s_suppkey % 6 IN (1, 2) THEN 'MP' ELSE 'ME' END AS lvl
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "funded_program": """
        SELECT c_custkey AS prog_id, c_name AS prog_name, n_regionkey AS area_id
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "faculty": "SELECT p_partkey AS fac_id, p_name || ' ' || p_partkey AS fac_name FROM part",
    "output": """
        SELECT o_orderkey AS out_id, year(o_orderdate) AS yr,
               CASE o_orderstatus WHEN 'F' THEN 'AR' WHEN 'O' THEN 'LI' WHEN 'P' THEN 'CA' END AS kind,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'A1' WHEN '2-HIGH' THEN 'A2'
                                    WHEN '3-MEDIUM' THEN 'B1' WHEN '5-LOW' THEN 'B2' END AS qualis
        FROM orders""",
    "link": """
        SELECT l_suppkey AS prog_id, l_partkey AS fac_id,
               CASE min(l_returnflag) WHEN 'A' THEN 'PE' WHEN 'N' THEN 'CO' ELSE 'VI' END AS kind
        FROM lineitem WHERE l_linenumber = 1 AND l_linestatus = 'F' GROUP BY l_suppkey, l_partkey""",
    "author": "SELECT DISTINCT l_orderkey AS out_id, l_partkey AS fac_id FROM lineitem",
    "student": """
        SELECT l_suppkey AS prog_id, l_partkey AS fac_id, CASE l_returnflag WHEN 'A' THEN 'ME' ELSE 'DO' END AS lvl,
               CASE l_linestatus WHEN 'O' THEN 'AT' ELSE 'TI' END AS status
        FROM lineitem""",
    "graduate": "SELECT l_suppkey AS prog_id FROM lineitem WHERE l_linestatus = 'F'",
    "project": """
        SELECT o_orderkey AS proj_id, o_custkey AS prog_id, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
               c_mktsegment AS funder
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "project_collab": "SELECT DISTINCT l_orderkey AS proj_id, l_suppkey AS collab_id FROM lineitem",
    "indicator": """
        SELECT l_suppkey AS prog_id, year(l_shipdate) AS yr,
               CASE l_returnflag WHEN 'A' THEN 'PD' WHEN 'N' THEN 'FE' WHEN 'R' THEN 'II' END AS kind,
               CAST(sum(CAST(l_quantity AS DECIMAL(10,4))) * 10000 AS BIGINT) AS units
        FROM lineitem GROUP BY 1, 2, 3""",
    "report": """
        SELECT l_suppkey AS prog_id, year(l_shipdate) AS yr,
               CASE WHEN year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) THEN 'QU' ELSE 'AN' END AS kind,
               nullif(count(*) % 8, 0) AS grade
        FROM lineitem GROUP BY 1, 2""",
    "opinion": """
        SELECT o_custkey AS eval_id, l_suppkey AS prog_id, year(l_shipdate) AS yr,
               CAST(CAST(l_discount * 100 AS DECIMAL(4,2)) * 100 AS BIGINT) AS cents
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "evaluator": "SELECT c_custkey AS eval_id, c_name AS eval_name, c_nationkey AS area_id FROM customer",
    "criterion": """
        SELECT c_nationkey AS area_id, CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 100 AS BIGINT) AS cents FROM customer""",
    "audit": """
        SELECT event_id AS id, ts, event_type AS tab,
               CASE event_id % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'A' ELSE 'E' END AS op
        FROM events""",
    "timing": """
        SELECT CASE WHEN day(ts) <= 15 THEN 'BASELINE' ELSE 'INDEXADO' END AS phase, event_type AS code,
               CAST(CAST(value AS DECIMAL(12,3)) * 1000 AS BIGINT) AS micros, value
        FROM events""",
}


def with_views(names: str, body: str, more: str = "") -> str:
    """``body`` below the named views (blank-separated) and, in ``more``, further named queries."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in names.split()]
    if more:
        parts.append(more)
    return f"WITH {', '.join(parts)} {body}"


def rounded(numerator: str, denominator: str, places: int) -> str:
    """Quotient of two whole numbers, rounded half away from zero, as DOUBLE."""
    num, den = f"CAST(({numerator}) AS HUGEINT)", f"CAST(({denominator}) AS HUGEINT)"
    return f"CAST((2 * {num} * {10**places} + {den}) // (2 * {den}) AS DOUBLE) / {10**places}"
