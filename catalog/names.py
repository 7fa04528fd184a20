"""Host names, URLs and addresses."""

from pyspark.sql import functions as F

from scanweave.functions.address import is_valid_ip
from scanweave.functions.names import is_valid_domain
from scanweave.functions.suffix import with_ancestors, with_redirect_host
from scanweave.functions.text import quote_url, strip_dot, strip_dots
from scanweave.operators.degrees import attach_degrees, degrees, number_vertices
from scanweave.operators.edges import resolve_endpoints
from scanweave.operators.ids import assign_ids
from scanweave.operators.nodes import domain_nodes, parent_edges, san_names

from .base import HOST, rules, table

# Each page's URL in one of seven shapes, and the host that shape points at.
SHAPED_URL = f"""CASE page_id % 7
    WHEN 0 THEN url
    WHEN 1 THEN concat('https://user:pw@', {HOST}, ':8443/x?y=1')
    WHEN 2 THEN regexp_replace(url, '^https?://[^/]+', '')
    WHEN 3 THEN concat('//', {HOST}, '/a@b')
    WHEN 4 THEN concat(upper({HOST}), '.')
    WHEN 5 THEN concat('ftp://', {HOST}, './#x')
    WHEN 6 THEN concat('https://', {HOST}, '.invalidzone/') END"""
SHAPED_HOST = f"""CASE page_id % 7 WHEN 2 THEN NULL WHEN 6 THEN NULL
    WHEN 4 THEN upper({HOST}) ELSE {HOST} END"""

# Each page's host below one of five kinds of suffix, some as wildcard names.
_STEM = f"regexp_replace({HOST}, '[.](com|net|org)$', '')"
SHAPED_NAME = f"""concat(CASE WHEN page_id % 11 = 0 THEN '*.' ELSE '' END, CASE page_id % 5
    WHEN 0 THEN {HOST}
    WHEN 1 THEN concat({_STEM}, '.co.uk')
    WHEN 2 THEN concat({_STEM}, '.github.io')
    WHEN 3 THEN concat({_STEM}, '.kobe.jp')
    WHEN 4 THEN concat({_STEM}, '.localzone') END)"""
SUFFIX_LABELS = "CASE page_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 0 END"

_NAMES_CTE = f"""names AS (
    SELECT DISTINCT {SHAPED_NAME} AS name, {SUFFIX_LABELS} AS k FROM pages),
  parts AS (
    SELECT name, string_split(name, '.') AS l,
      CASE WHEN k > 0 THEN len(string_split(name, '.')) - k
           ELSE len(string_split(name, '.')) - 1 END AS m FROM names),
  chain AS (
    SELECT name, i, array_to_string(l[i:], '.') AS ancestor,
      CASE WHEN i < m THEN array_to_string(l[i + 1:], '.') END AS parent
    FROM parts, LATERAL (SELECT unnest(range(1, m + 1)) AS i)),
  nodes AS (SELECT DISTINCT ancestor AS domain_name, parent FROM chain),
  ids AS (
    SELECT domain_name, row_number() OVER (ORDER BY domain_name) - 1 AS id FROM nodes),
  parents AS (
    SELECT c.id AS src, p.id AS dst FROM nodes n
    JOIN ids c ON c.domain_name = n.domain_name JOIN ids p ON p.domain_name = n.parent)"""


def _names(spark, folder):
    return table(spark, folder, "pages").selectExpr(f"{SHAPED_NAME} AS name")


def redirect_host(spark, folder):
    pages = table(spark, folder, "pages").selectExpr("page_id", f"{SHAPED_URL} AS location")
    return with_redirect_host(pages, F.col("location"), rules(spark)).select("page_id", "redirect_host")


def domain_ancestors(spark, folder):
    rows = with_ancestors(_names(spark, folder).distinct(), F.col("name"), rules(spark))
    rows = rows.select("name", F.posexplode("ancestors").alias("i", "ancestor"))
    return rows.select("name", (F.col("i") + 1).cast("long").alias("i"), "ancestor")


def domain_vertices(spark, folder):
    return domain_nodes(_names(spark, folder), rules(spark))


def _domain_graph(spark, names):
    nodes = domain_nodes(names, rules(spark))
    ids = assign_ids(nodes.select("guid"))
    edges = resolve_endpoints(parent_edges(nodes), ids, split_heavy=False)
    return nodes, ids, edges


def subdomain_edges(spark, folder):
    return _domain_graph(spark, _names(spark, folder))[2]


def domain_graph(spark, folder):
    nodes, ids, edges = _domain_graph(spark, _names(spark, folder))
    return attach_degrees(number_vertices(nodes.drop("parent"), ids), degrees(edges))


def domain_filter(spark, folder):
    rows = table(spark, folder, "customer").selectExpr("c_custkey", f"{_DOMAIN_SHAPES} AS name")
    return rows.select("c_custkey", "name", is_valid_domain(F.col("name")).alias("valid"))


_SEGMENT = "lower(c_mktsegment)"
_DOMAIN_SHAPES = f"""CASE c_custkey % 8
    WHEN 0 THEN concat('www.', {_SEGMENT}, c_custkey, '.com')
    WHEN 1 THEN concat('_x.', {_SEGMENT}, '.com')
    WHEN 2 THEN concat('-', {_SEGMENT}, '.com')
    WHEN 3 THEN {_SEGMENT}
    WHEN 4 THEN concat('a_b.', {_SEGMENT}, '-', c_custkey, '.org')
    WHEN 5 THEN concat({_SEGMENT}, '.', c_custkey)
    WHEN 6 THEN concat('bücher', c_custkey, '.de')
    WHEN 7 THEN concat(c_name, '.com') END"""


def quoted_urls(spark, folder):
    pages = table(spark, folder, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("x"))
    docs = table(spark, folder, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("x"))
    return pages.union(docs).select("kind", "id", quote_url(F.col("x")).alias("quoted"))


_IP_SHAPES = """CASE l_linenumber
    WHEN 1 THEN concat('10.', l_partkey % 300, '.', l_suppkey, '.7')
    WHEN 2 THEN concat('fe80::', l_partkey * 7)
    WHEN 3 THEN concat('::ffff:10.0.', l_partkey % 300, '.1')
    WHEN 4 THEN concat('10.', l_partkey, '.1')
    WHEN 5 THEN concat('1:2:3:4:5:6:7:', l_partkey)
    WHEN 6 THEN concat(l_partkey, '::', l_suppkey, '::1')
    ELSE concat('00', l_suppkey, '.0.0.1') END"""


def ip_vertices(spark, folder):
    items = table(spark, folder, "lineitem").selectExpr(f"{_IP_SHAPES} AS ip")
    found = F.regexp_extract_all("text", F.lit("([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+)"), 1)
    docs = table(spark, folder, "documents").select(F.explode(found).alias("ip"))
    rows = items.union(docs).where(is_valid_ip(F.col("ip")))
    return rows.groupBy("ip").agg(F.count(F.lit(1)).alias("seen"))


_OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_GROUP = "0*([0-9a-fA-F]{1,4}|10000)"
_V4 = f"{_OCTET}([.]{_OCTET}){{3}}"

_SAN_JSON = """CASE WHEN s_suppkey % 7 = 0 THEN 'null' ELSE concat('["s', s_suppkey,
    '.example.com","*.n', s_nationkey, '.example.org","192.0.', s_suppkey % 300, '.1","::', s_nationkey, '"]') END"""


def san_split(spark, folder):
    rows = table(spark, folder, "supplier").selectExpr("concat('c_', s_suppkey) AS guid", f"{_SAN_JSON} AS j")
    return san_names(rows.select("guid", F.from_json("j", "array<string>").alias("altNames")))


def stripped_dots(spark, folder):
    tail = "CASE page_id % 4 WHEN 0 THEN '.' WHEN 1 THEN '. .' WHEN 2 THEN '..' ELSE '' END"
    rows = table(spark, folder, "pages").selectExpr("page_id", f"concat({HOST}, {tail}) AS x")
    return rows.select("page_id", strip_dot(F.col("x")).alias("one"), strip_dots(F.col("x")).alias("every"))


_QUOTE_SQL = "replace(replace(replace(replace(replace(url_encode(x), '%3A', ':'), '%2F', '/'), '%3F', '?'), '%3D', '='), '%26', '&')"

CATALOG = {
    "redirect_host": (
        redirect_host,
        f"SELECT page_id, {SHAPED_HOST} AS redirect_host FROM pages",
    ),
    "domain_ancestors": (
        domain_ancestors,
        f"WITH {_NAMES_CTE} SELECT name, i, ancestor FROM chain",
    ),
    "domain_vertices": (
        domain_vertices,
        f"WITH {_NAMES_CTE} SELECT concat('d_', domain_name) AS guid, domain_name, parent FROM nodes",
    ),
    "subdomain_edges": (subdomain_edges, f"WITH {_NAMES_CTE} SELECT src, dst FROM parents"),
    "domain_graph": (
        domain_graph,
        f"""WITH {_NAMES_CTE}
        SELECT id, domain_name,
          nullif((SELECT count(*) FROM parents WHERE dst = id), 0) AS "inDegree",
          nullif((SELECT count(*) FROM parents WHERE src = id), 0) AS "outDegree" FROM ids""",
    ),
    "domain_filter": (
        domain_filter,
        f"""SELECT c_custkey, name, CASE WHEN c_custkey % 8 = 6 THEN true ELSE regexp_full_match(name,
          '([A-Za-z0-9]([A-Za-z0-9_-]{{0,61}}[A-Za-z0-9])?[.])+[A-Za-z0-9][A-Za-z0-9_-]{{0,61}}[A-Za-z]')
          END AS valid FROM (SELECT c_custkey, {_DOMAIN_SHAPES} AS name FROM customer)""",
    ),
    "quote_url": (
        quoted_urls,
        f"""SELECT kind, id, {_QUOTE_SQL} AS quoted FROM (
          SELECT 'page' AS kind, page_id AS id, url AS x FROM pages
          UNION ALL SELECT 'document', doc_id, text FROM documents)""",
    ),
    "ip_vertices": (
        ip_vertices,
        f"""SELECT ip, count(*) AS seen FROM (
          SELECT {_IP_SHAPES} AS ip FROM lineitem UNION ALL
          SELECT unnest(regexp_extract_all(text, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+')) FROM documents)
        WHERE regexp_full_match(ip, '{_V4}') OR regexp_full_match(ip, 'fe80::{_GROUP}')
          OR regexp_full_match(ip, '::ffff:{_V4}') OR regexp_full_match(ip, '({_GROUP}:){{7}}{_GROUP}')
        GROUP BY ip""",
    ),
    "san_split": (
        san_split,
        f"""SELECT guid, CASE WHEN NOT ip THEN name END AS domain_name, CASE WHEN ip THEN name END AS ip FROM (
          SELECT guid, name, regexp_full_match(name, '{_V4}') OR name LIKE '::%' AS ip FROM (
            SELECT concat('c_', s_suppkey) AS guid, unnest(from_json({_SAN_JSON}, '["VARCHAR"]')) AS name
            FROM supplier))""",
    ),
    "strip_dots": (
        stripped_dots,
        f"""SELECT page_id, regexp_replace(x, '[.]$', '') AS one, rtrim(x, '. ') AS every FROM (
          SELECT page_id, concat({HOST}, CASE page_id % 4 WHEN 0 THEN '.' WHEN 1 THEN '. .'
            WHEN 2 THEN '..' ELSE '' END) AS x FROM pages)""",
    ),
}
