"""Edge algebra, ids and degrees."""

from pyspark.sql import functions as F

from scanweave.functions.suffix import with_redirect_host
from scanweave.operators.degrees import attach_degrees, degrees, number_vertices
from scanweave.operators.edges import (
    edge_members,
    fold_edges,
    merge_observations,
    resolve_endpoints,
    reverse_valid,
    semi_edges,
)
from scanweave.operators.ids import assign_ids
from scanweave.operators.nodes import cert_nodes
from scanweave.plans.graph import redirect_observations
from scanweave.workspace import materialize, scratch_dir

from .base import HOST, rules, table

_OBSERVED = """concat('c_', o_custkey) AS "from", concat('p_', l_partkey) AS "to",
    CAST(o_orderdate AS DATE) AS scan_date, concat(l_returnflag, l_linestatus) AS sni,
    CASE l_returnflag WHEN 'R' THEN false WHEN 'A' THEN true END AS valid"""
_ITEMS = "orders JOIN lineitem ON o_orderkey = l_orderkey"


def _items(spark, folder):
    # Orders, the smaller side, are hashed: the items need no sort in a task's memory.
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return orders.hint("shuffle_hash").join(items, F.col("o_orderkey") == F.col("l_orderkey"))


def _observed(spark, folder):
    return _items(spark, folder).select(
        F.concat(F.lit("c_"), F.col("o_custkey")).alias("from"),
        F.concat(F.lit("p_"), F.col("l_partkey")).alias("to"),
        F.col("o_orderdate").cast("date").alias("scan_date"),
        F.concat("l_returnflag", "l_linestatus").alias("sni"),
        F.expr("CASE l_returnflag WHEN 'R' THEN false WHEN 'A' THEN true END").alias("valid"),
    )


def _keys(spark, folder):
    parts = []
    for name, prefix, column in _KINDS:
        parts.append(table(spark, folder, name).select(F.concat(F.lit(prefix), F.col(column)).alias("guid")))
    return parts[0].union(parts[1]).union(parts[2])


_KINDS = [("customer", "c_", "c_custkey"), ("part", "p_", "p_partkey"), ("supplier", "s_", "s_suppkey")]
_IDS = """ids AS (SELECT guid, row_number() OVER (ORDER BY guid) - 1 AS id FROM (
    SELECT concat('c_', c_custkey) AS guid FROM customer UNION
    SELECT concat('p_', p_partkey) FROM part UNION SELECT concat('s_', s_suppkey) FROM supplier))"""


def dense_ids(spark, folder):
    return assign_ids(_keys(spark, folder))


# Every fifth line number names an unknown part, a third of all rows one customer.
_SRC_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN 'c_1' ELSE concat('c_', o_custkey) END AS src_key"
_DST_KEY = "CASE WHEN l_linenumber = 5 THEN 'p_unknown' ELSE concat('p_', l_partkey) END AS dst_key"


def _keyed(spark, folder):
    return _items(spark, folder).selectExpr(_SRC_KEY, _DST_KEY, "l_quantity AS quantity")


def resolve_edges(spark, folder):
    ids = dense_ids(spark, folder)
    return resolve_endpoints(_keyed(spark, folder), ids, "src_key", "dst_key", split_heavy=False)


def resolve_edges_heavy(spark, folder):
    edges = materialize(_keyed(spark, folder), scratch_dir(spark, "edges"))
    return resolve_endpoints(edges, dense_ids(spark, folder), "src_key", "dst_key", rows_per_task=1000)


def _folded(spark, folder):
    return fold_edges(_observed(spark, folder), ("from", "to"), sets={"sni": "server_name_indicators"})


def _as_text(rows):
    lists = [c for c in ("scan_dates", "server_name_indicators", "locations") if c in rows.columns]
    return rows.withColumns({c: F.concat_ws(";", F.col(c)) for c in lists})


def folded_edges(spark, folder):
    return _as_text(_folded(spark, folder))


def folded_edges_heavy(spark, folder):
    # A third of all rows between one pair of ends.
    seen = _observed(spark, folder).withColumns(
        {
            "to": F.when(F.dayofmonth("scan_date") <= 10, F.lit("p_0")).otherwise(F.col("to")),
            "from": F.when(F.dayofmonth("scan_date") <= 10, F.lit("c_0")).otherwise(F.col("from")),
        }
    )
    return _as_text(fold_edges(seen, ("from", "to"), sets={"sni": "server_name_indicators"}))


def returns_names(spark, folder):
    return edge_members(_observed(spark, folder), "sni", ("from", "to"))


_FOLD = """array_to_string(list_sort(list(DISTINCT scan_date)), ';') AS scan_dates,
    array_to_string(list_sort(list(DISTINCT sni)), ';') AS server_name_indicators,
    bool_or(valid) AS valid"""
_FOLDED = f"""observed AS (SELECT {_OBSERVED} FROM {_ITEMS}),
  folded AS (SELECT "from", "to", {_FOLD} FROM observed GROUP BY ALL)"""


def merged_observations(spark, folder):
    plain = _items(spark, folder).select(
        F.concat(F.lit("c_"), F.col("o_custkey")).alias("from"),
        F.concat(F.lit("p_"), F.col("l_suppkey")).alias("to"),
        F.col("o_orderdate").cast("date").alias("scan_date"),
    )
    return merge_observations(_observed(spark, folder).drop("sni"), plain)


def reversed_edges(spark, folder):
    rows = _folded(spark, folder).withColumnsRenamed({"from": "src", "to": "dst"})
    return _as_text(reverse_valid(rows))


def subject_edges(spark, folder):
    items = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier")
    contains = items.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    returns = items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"), (F.col("s_acctbal") > 3000).alias("valid")
    )
    return semi_edges(contains, returns, split_heavy=False)


def _edge_kinds(spark, folder):
    items = _items(spark, folder)
    customer = F.col("o_custkey") * 3
    part = F.col("l_partkey") * 3 + 1
    supplier = F.col("l_suppkey") * 3 + 2
    return [
        items.select(customer.alias("src"), part.alias("dst")),
        items.select(supplier.alias("src"), part.alias("dst")),
        items.select(part.alias("src"), customer.alias("dst")),
    ]


_EDGE_KINDS = f"""edges AS (
    SELECT o_custkey * 3 AS src, l_partkey * 3 + 1 AS dst FROM {_ITEMS} UNION ALL
    SELECT l_suppkey * 3 + 2, l_partkey * 3 + 1 FROM {_ITEMS} UNION ALL
    SELECT l_partkey * 3 + 1, o_custkey * 3 FROM {_ITEMS}),
  ind AS (SELECT dst AS id, count(*) AS "inDegree" FROM edges GROUP BY dst),
  outd AS (SELECT src AS id, count(*) AS "outDegree" FROM edges GROUP BY src)"""


def edge_degrees(spark, folder):
    return degrees(*_edge_kinds(spark, folder))


def vertices_with_degrees(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.concat(F.lit("c_"), F.col("c_custkey")).alias("guid"), "c_name", "c_mktsegment"
    )
    ids = dense_ids(spark, folder)
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("c_"), F.col("o_custkey")).alias("from"), F.concat(F.lit("p_"), F.col("o_orderkey")).alias("to")
    )
    edges = resolve_endpoints(orders, ids, split_heavy=False)
    return attach_degrees(number_vertices(customer, ids), degrees(edges))


def collapsed_certs(spark, folder):
    part = table(spark, folder, "part")
    rows = part.select(
        F.concat(F.lit("c_"), F.col("p_brand")).alias("guid"),
        F.sha1(F.col("p_brand").cast("binary")).alias("sha1"),
        F.sha2(F.col("p_brand").cast("binary"), 256).alias("sha256"),
        F.col("p_name").alias("subject"),
        F.col("p_type").alias("issuer"),
        (F.col("p_partkey") * 10).alias("notBefore"),
        (-F.col("p_partkey")).alias("notAfter"),
        F.col("p_size").alias("numAltNames"),
    )
    return cert_nodes(rows)


_SCAN = "date_add(DATE '2024-01-01', CAST(page_id % 3 AS INT))"


def redirect_edges(spark, folder):
    pages = table(spark, folder, "pages")
    hosts = pages.selectExpr(
        f"{_SCAN} AS scan_date", "'tls' AS source", "CAST(page_id AS INT) AS id", f"{HOST} AS server_name",
        "CASE page_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 END AS cert_valid",
    )
    http = pages.selectExpr(
        f"{_SCAN} AS scan_date", "'tls' AS source",
        "CASE WHEN page_id % 10 = 9 THEN 'no number' ELSE CAST(page_id AS STRING) END AS id",
        "CASE WHEN page_id % 5 = 4 THEN '/relative' ELSE concat(regexp_replace(url, '^(https?://)[a-z]+[.]', '$1'), '?q=a b%41~*é') END AS Location",
    )
    located = with_redirect_host(http, F.col("Location"), rules(spark))
    seen = redirect_observations(located, hosts)
    return _as_text(fold_edges(seen, ("from", "to"), sets={"location": "locations"}))


CATALOG = {
    "assign_ids": (dense_ids, f"WITH {_IDS} SELECT guid, id FROM ids"),
    "resolve_edges": (
        resolve_edges,
        f"""WITH {_IDS} SELECT a.id AS src, b.id AS dst, l_quantity AS quantity
        FROM (SELECT {_SRC_KEY}, {_DST_KEY}, l_quantity FROM {_ITEMS}) e
        JOIN ids a ON a.guid = src_key JOIN ids b ON b.guid = dst_key""",
    ),
    "fold_edges": (folded_edges, f"WITH {_FOLDED} SELECT * FROM folded"),
    "fold_edges_heavy": (
        folded_edges_heavy,
        f"""WITH observed AS (SELECT {_OBSERVED} FROM {_ITEMS}),
          one_pair AS (SELECT CASE WHEN day(scan_date) <= 10 THEN 'c_0' ELSE "from" END AS "from",
            CASE WHEN day(scan_date) <= 10 THEN 'p_0' ELSE "to" END AS "to", scan_date, sni, valid FROM observed)
        SELECT "from", "to", {_FOLD} FROM one_pair GROUP BY ALL""",
    ),
    "returns_names": (
        returns_names,
        f"""WITH observed AS (SELECT {_OBSERVED} FROM {_ITEMS})
        SELECT "from", "to", sni, bool_or(valid) AS valid FROM observed WHERE sni IS NOT NULL GROUP BY ALL""",
    ),
    "merge_observations": (
        merged_observations,
        f"""SELECT "from", "to", scan_date, bool_or(valid) AS valid FROM (
          SELECT "from", "to", scan_date, valid FROM (SELECT {_OBSERVED} FROM {_ITEMS})
          UNION ALL SELECT concat('c_', o_custkey), concat('p_', l_suppkey), CAST(o_orderdate AS DATE), NULL
          FROM {_ITEMS}) GROUP BY ALL""",
    ),
    "reverse_valid": (
        reversed_edges,
        f'WITH {_FOLDED} SELECT "to" AS src, "from" AS dst, scan_dates FROM folded WHERE valid',
    ),
    "subject_edges": (
        subject_edges,
        """SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem l WHERE EXISTS (
          SELECT 1 FROM lineitem r JOIN supplier ON s_suppkey = r.l_suppkey
          WHERE r.l_suppkey = l.l_suppkey AND s_acctbal > 3000)""",
    ),
    "degrees": (
        edge_degrees,
        f'WITH {_EDGE_KINDS} SELECT id, "inDegree", "outDegree" FROM ind FULL JOIN outd USING (id)',
    ),
    "vertices_with_degrees": (
        vertices_with_degrees,
        f"""WITH {_IDS},
          edges AS (SELECT a.id AS src, b.id AS dst FROM orders
            JOIN ids a ON a.guid = concat('c_', o_custkey) JOIN ids b ON b.guid = concat('p_', o_orderkey)),
          ind AS (SELECT dst AS id, count(*) AS "inDegree" FROM edges GROUP BY dst),
          outd AS (SELECT src AS id, count(*) AS "outDegree" FROM edges GROUP BY src)
        SELECT id, c_name, c_mktsegment, "inDegree", "outDegree" FROM customer
        JOIN ids ON guid = concat('c_', c_custkey) LEFT JOIN ind USING (id) LEFT JOIN outd USING (id)""",
    ),
    "cert_vertices": (
        collapsed_certs,
        """SELECT concat('c_', p_brand) AS guid, sha1(p_brand) AS sha1, sha256(p_brand) AS sha256,
          max(p_name) AS subject, max(p_type) AS issuer, max(p_partkey * 10) AS "notBefore",
          max(-p_partkey) AS "notAfter", max(p_size) AS "numAltNames" FROM part GROUP BY p_brand""",
    ),
    "redirect_edges": (
        redirect_edges,
        f"""WITH observed AS (
          SELECT CAST({_SCAN} AS DATE) AS scan_date, concat('d_', {HOST}) AS "from",
            concat('d_', regexp_replace({HOST}, '^[a-z]+[.]', '')) AS "to",
            CASE page_id % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true END AS valid,
            concat(regexp_replace(url, '^(https?://)[a-z]+[.]', '\\1'), '?q=a b%41~*é') AS x
          FROM pages WHERE page_id % 10 <> 9 AND page_id % 5 <> 4),
        quoted AS (SELECT *, replace(replace(replace(replace(replace(url_encode(x), '%3A', ':'), '%2F', '/'),
            '%3F', '?'), '%3D', '='), '%26', '&') AS location FROM observed)
        SELECT "from", "to", array_to_string(list_sort(list(DISTINCT scan_date)), ';') AS scan_dates,
          array_to_string(list_sort(list(DISTINCT location)), ';') AS locations, bool_or(valid) AS valid
        FROM quoted GROUP BY ALL""",
    ),
}
CATALOG["resolve_edges_heavy"] = (resolve_edges_heavy, CATALOG["resolve_edges"][1])
