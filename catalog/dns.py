"""DNS records as JSON lines, one per order, and what is read from them."""

from pyspark.sql import functions as F

from scanweave.operators.dns import answer_errors, flatten_answers, long_aliases, resolve_cnames
from scanweave.sinks.graph import write_dns_pairs
from scanweave.sources.files import (
    list_files,
    read_dns_pairs,
    read_dns_records,
    unusable_records,
    usable_records,
)
from scanweave.workspace import materialize, scratch_dir

from .base import table

_JOINED = "orders JOIN customer ON o_custkey = c_custkey"


def _answer(owner, kind, data):
    return f"""concat('{{"name":"', {owner}, '","type":"{kind}","data":"', {data}, '"}}')"""


# order -> customer -> nation -> address. Every 11th order has an alias loop, every
# 13th an alias of itself, every 7th a second way to the nation.
_ORDER, _CUSTOMER, _NATION = "concat('o', o_orderkey)", "concat('c', c_custkey)", "concat('n', c_nationkey)"
_DOTTED = f"concat({_CUSTOMER}, '. ')"
_V4, _V6 = "concat('10.0.0.', c_nationkey)", "concat('2001:db8::', c_nationkey)"
_ANSWERS = [
    ("true", _ORDER, "CNAME", _DOTTED),
    ("true", _DOTTED, "CNAME", _NATION),
    ("o_orderkey % 7 = 0", _ORDER, "CNAME", _NATION),
    ("o_orderkey % 11 = 0", _CUSTOMER, "CNAME", _ORDER),
    ("o_orderkey % 13 = 0", _ORDER, "CNAME", _ORDER),
    ("true", _NATION, "A", _V4),
    ("o_orderkey % 2 = 0", _NATION, "AAAA", _V6),
    ("o_orderkey % 5 = 0", _ORDER, "TXT", "'text'"),
]
_LIST = "concat(" + ", ".join(
    # The first answer always exists, so the others can bring their own comma.
    f"CASE WHEN {when} THEN concat('{',' if i else ''}', {_answer(*rest)}) ELSE '' END"
    for i, (when, *rest) in enumerate(_ANSWERS)
) + ")"
_LINE = f"""CASE WHEN o_orderkey % 17 = 0 THEN concat('{{"name": broken ', o_orderkey)
    WHEN o_orderkey % 19 = 0 THEN concat('{{"data":{{"answers":[', {_LIST}, ']}}}}')
    WHEN o_orderkey % 23 = 0 THEN concat('{{"name":"', {_ORDER}, '"}}')
    ELSE concat('{{"name":"', {_ORDER}, '","data":{{"answers":[', {_LIST}, ']}}}}') END"""


def _records(spark, folder):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    path = f"{scratch_dir(spark, 'dns')}/2024-01-02-dns"
    rows.selectExpr(f"{_LINE} AS value").write.text(path)
    return read_dns_records(spark, [path])


_USABLE = f"""usable AS (SELECT * FROM {_JOINED}
    WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0),
  answers AS ({" UNION ALL ".join(
    f"SELECT o_orderkey AS record, rtrim({owner}, '. ') AS owner, '{kind}' AS kind, rtrim({data}, '. ') AS data "
    f"FROM usable WHERE {when}" for when, owner, kind, data in _ANSWERS)}),
  direct AS (SELECT record, data AS ip, owner AS domain, kind AS type FROM answers WHERE kind IN ('A', 'AAAA')),
  paths AS (
    SELECT record, owner AS root, data AS cur, [owner, data] AS seen FROM answers
    WHERE kind = 'CNAME' AND owner <> data
    UNION ALL
    SELECT p.record, p.root, a.data, list_append(p.seen, a.data) FROM paths p JOIN answers a
    ON a.record = p.record AND a.kind = 'CNAME' AND a.owner = p.cur AND NOT list_contains(p.seen, a.data)),
  chased AS (SELECT p.record, d.ip, p.root AS domain, d.type FROM paths p
    JOIN direct d ON d.record = p.record AND d.domain = p.cur),
  every_pair AS (SELECT * FROM direct UNION ALL SELECT * FROM chased)"""


def dns_answers(spark, folder):
    return flatten_answers(usable_records(_records(spark, folder)), keep=["scan_date"])


def dns_paths(spark, folder):
    return resolve_cnames(usable_records(_records(spark, folder)), keep=["name", "scan_date"], bag=True).drop("name")


def dns_pairs(spark, folder):
    rows = resolve_cnames(usable_records(_records(spark, folder)), keep=["name"])
    return rows.select(F.col("name").alias("record"), "ip", "domain", "type")


def dns_pair_files(spark, folder):
    pairs = resolve_cnames(usable_records(_records(spark, folder)), keep=["scan_date"])
    path = scratch_dir(spark, "pairs")
    write_dns_pairs(pairs, path)
    return _typed_pairs(spark, path).groupBy("ip", "domain", "scan_date", "type").agg(
        F.count(F.lit(1)).alias("seen")
    )


def _typed_pairs(spark, path):
    """Pair files as the writer lays them out: the type is in the folder name."""
    found = list_files(spark, [f"{path}/scan_date=*/type=*"]).collect()
    both = [
        read_dns_pairs(spark, [r.path for r in found if r.source == f"type={t}"]).withColumn("type", F.lit(t))
        for t in ("A", "AAAA")
    ]
    return both[0].union(both[1])


def dns_errors(spark, folder):
    records = _records(spark, folder)
    bad = unusable_records(records).select("scan_date", "reason", "payload")
    return bad.unionByName(answer_errors(usable_records(records), keep=["scan_date"]))


# Five names of a record are aliases of each other, all twenty pairs; the last has an address.
_MESH = """concat(flatten(transform(sequence(0, 4), i -> transform(filter(sequence(0, 4), j -> j <> i),
    j -> named_struct('name', concat('x', i), 'type', 'CNAME', 'data', concat('x', j))))),
    array(named_struct('name', 'x4', 'type', 'A', 'data', concat('10.0.0.', c_custkey % 200)))) AS answers"""


def cname_bounded(spark, folder):
    """Paths of up to two aliases in a dense mesh, and where longer ones are cut off."""
    records = table(spark, folder, "customer").selectExpr("c_custkey AS record", _MESH)
    # The search is all the work, and a small file is one task: records are dealt out first.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = materialize(records, scratch_dir(spark, "mesh"), partitions=spread)
    pairs = resolve_cnames(records, keep=["record"], bag=True, max_hops=2)
    pairs = pairs.groupBy("record", "ip", "domain").agg(F.count(F.lit(1)).alias("paths"))
    cut = long_aliases(records, keep=["record"], bag=True, max_hops=2)
    return pairs.withColumns({"reason": F.lit(None).cast("string"), "payload": F.lit(None).cast("string")}).unionByName(
        cut, allowMissingColumns=True
    )


CATALOG = {
    "cname_bounded": (
        cname_bounded,
        """WITH RECURSIVE paths AS (
          SELECT c_custkey AS record, concat('10.0.0.', c_custkey % 200) AS ip, i AS root, j AS cur, [i, j] AS seen, 1 AS hops
          FROM customer, range(5) a(i), range(5) b(j) WHERE i <> j
          UNION ALL SELECT record, ip, root, j, list_append(seen, j), hops + 1 FROM paths, range(5) b(j)
          WHERE hops < 3 AND NOT list_contains(seen, j))
        SELECT record, ip, concat('x', root) AS domain, count(*) AS paths, NULL AS reason, NULL AS payload
        FROM paths WHERE hops < 3 AND cur = 4 GROUP BY record, ip, root
        UNION ALL SELECT c_custkey, concat('10.0.0.', c_custkey % 200), 'x4', 1, NULL, NULL FROM customer
        UNION ALL SELECT DISTINCT record, NULL, NULL, NULL::BIGINT, 'alias path too long',
          concat('{"root":"x', root, '","name":"x', cur, '"}') FROM paths WHERE hops = 3""",
    ),
    "dns_flatten": (
        dns_answers,
        f"WITH RECURSIVE {_USABLE} SELECT DATE '2024-01-02' AS scan_date, ip, domain, type FROM direct",
    ),
    "cname_resolution": (
        dns_paths,
        f"WITH RECURSIVE {_USABLE} SELECT DATE '2024-01-02' AS scan_date, ip, domain, type FROM every_pair",
    ),
    "cname_pairs": (
        dns_pairs,
        f"WITH RECURSIVE {_USABLE} SELECT DISTINCT concat('o', record) AS record, ip, domain, type FROM every_pair",
    ),
    "dns_pair_files": (
        dns_pair_files,
        f"""WITH RECURSIVE {_USABLE} SELECT ip, domain, DATE '2024-01-02' AS scan_date, type, count(*) AS seen
        FROM (SELECT DISTINCT * FROM every_pair) GROUP BY ALL""",
    ),
    "dns_errors": (
        dns_errors,
        f"""SELECT DATE '2024-01-02' AS scan_date, reason, payload FROM (
          SELECT 'malformed line' AS reason, {_LINE} AS payload FROM {_JOINED} WHERE o_orderkey % 17 = 0
          UNION ALL SELECT 'no name', concat('{{"answers":[', {_LIST}, ']}}') FROM {_JOINED}
          WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 = 0
          UNION ALL SELECT 'unknown type', {_answer(_ORDER, 'TXT', "'text'")} FROM {_JOINED}
          WHERE o_orderkey % 5 = 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0)""",
    ),
}
