"""The whole graph: scan tables in, three vertex and eight edge tables out."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.suffix import SuffixRules, with_redirect_host
from ..functions.text import quote_url
from ..operators.cluster import cluster_by_id
from ..operators.degrees import attach_degrees, degrees
from ..operators.edges import (
    edge_members,
    fold_edges,
    folds_at_once,
    heavy_ends,
    pack_keys,
    resolve_endpoints,
    reverse_valid,
    semi_edges,
    small_kinds,
)
from ..operators.ids import assign_ids
from ..operators.nodes import (
    CERT,
    DOMAIN,
    IP,
    cert_nodes,
    domain_nodes,
    entity_key,
    ip_nodes,
    parent_edges,
    san_names,
    valid_certs,
)
from ..operators.skew import PIECES, HeavyKeys, heavy_keys, with_pieces
from ..schemas import GRAPH_COLUMNS
from ..sinks.graph import write_graph_table
from ..sources.files import clean_names
from ..sources.snapshots import ingest_scans, read_snapshot
from ..workspace import COMPACT, fingerprint, is_current, materialize, release_steps, remove, scratch_dir

VERTICES = ("certs", "domains", "ip_addresses")
EDGES = (
    "returns",
    "resolves",
    "contains",
    "redirects",
    "subdomain_of",
    "subject_to",
    "assigned_to",
    "serves",
)


def returns_observations(hosts: DataFrame) -> DataFrame:
    """``(from, to, valid, sni, scan_date)``: an address presented a certificate."""
    return hosts.select(
        entity_key(IP, F.col("ip")).alias("from"),
        entity_key(CERT, F.col("cert_hash")).alias("to"),
        (F.col("cert_valid") == 1).alias("valid"),
        F.col("server_name").alias("sni"),
        "scan_date",
    )


def resolves_observations(hosts: DataFrame, dns: DataFrame) -> DataFrame:
    """``(from, to, valid, scan_date)``: a name led to an address, in a TLS scan or in the DNS.

    Only TLS scans know of validity. Folding takes the maximum of the flag over all dates,
    which is the maximum of the maxima per date: one aggregation does for both.
    """
    address = entity_key(IP, F.col("ip")).alias("to")
    seen = hosts.select(
        entity_key(DOMAIN, F.col("server_name")).alias("from"),
        address,
        (F.col("cert_valid") == 1).alias("valid"),
        "scan_date",
    )
    named = dns.select(entity_key(DOMAIN, F.col("domain")).alias("from"), address, "scan_date")
    return seen.unionByName(named, allowMissingColumns=True)


def contains_observations(san: DataFrame) -> DataFrame:
    """``(from, to)``: a certificate is made out to a name or an address."""
    address = entity_key(IP, F.col("ip"))
    return san.select(
        F.col("guid").alias("from"),
        F.coalesce(entity_key(DOMAIN, F.col("domain_name")), address).alias("to"),
    )


#: One scan row in so many is looked at to see how redirects repeat.
_SEEN = 64


def _some_redirects(http: DataFrame, hosts: DataFrame, *, match_source: bool) -> DataFrame:
    """The ``redirect_observations`` of one row number in ``_SEEN``."""
    number = F.col("id").try_cast(hosts.schema["id"].dataType)
    seen = F.pmod(F.xxhash64(number), F.lit(_SEEN)) == 0
    return redirect_observations(http.where(seen), hosts.where(seen), match_source=match_source)


def redirect_observations(
    http: DataFrame, hosts: DataFrame, *, match_source: bool = True
) -> DataFrame:
    """``(from, to, valid, location, scan_date)``: HTTP rows that redirect to a host,
    joined with the host row of the same scan.

    ``http`` has ``redirect_host`` already, and only rows with one take part. A row
    number occurs once per scan, so the join key spreads evenly. With
    ``match_source=False`` all scans of one date match each other.
    """
    origin = [c for c in ("source", "scan") if c in http.columns and c in hosts.columns]
    keys = ["scan_date", *(origin if match_source else ()), "id"]
    left = http.where(F.col("redirect_host").isNotNull()).select(*keys, "Location", "redirect_host")
    right = hosts.where(F.col("server_name").isNotNull()).select(*keys, "server_name", "cert_valid")
    left = left.withColumn("id", F.col("id").try_cast(right.schema["id"].dataType))
    return left.join(right, on=keys).select(
        entity_key(DOMAIN, F.col("server_name")).alias("from"),
        entity_key(DOMAIN, F.col("redirect_host")).alias("to"),
        (F.col("cert_valid") == 1).alias("valid"),
        quote_url(F.col("Location")).alias("location"),
        "scan_date",
    )


#: Which scan tables each stored step is made from; all others depend on all.
_MADE_FROM = {
    "alt_names": ("certs",),
    "redirect_hosts": ("http",),
    "redirect_observations": ("http", "hosts"),
    "returns_keys": ("hosts",),
    "resolves_keys": ("hosts", "dns"),
    "contains_keys": ("certs",),
    "redirects_keys": ("http", "hosts"),
}
#: What is not read again once the keys of an edge kind are stored.
_LAST_READ = {"contains": "alt_names", "redirects": "redirect_hosts", "subdomain_of": "domains"}
_MEMBERS = {"returns": ("sni", "server_name_indicator"), "redirects": ("location", "location")}


class _Steps:
    """Stored steps of one run: where they lie, what they were made from, how many rows they have."""

    def __init__(self, spark: SparkSession, scans: Mapping[str, DataFrame], options: str, *, resume: bool, kept: bool):
        self.spark, self.resume = spark, resume
        # Steps in a folder of this run alone are not looked at again.
        self.kept = kept
        self.prints = {n: fingerprint(df) for n, df in scans.items()} if kept else {}
        self.options, self.rows = options, {}

    def inputs(self, name: str) -> str:
        if not self.prints:
            return ""
        text = "\n".join([self.options, *(self.prints[n] for n in _MADE_FROM.get(name, sorted(self.prints)))])
        return hashlib.sha256(text.encode()).hexdigest()

    def store(self, name: str, df: DataFrame, path: str) -> DataFrame:
        """Write a step and count its rows on the way; a current one is read and counted."""
        inputs = self.inputs(name)
        if self.resume and is_current(self.spark, path, inputs):
            table = materialize(df, path, resume=True, inputs=inputs)
            self.rows[name] = table.count()
            return table
        release_steps(self.spark)  # what earlier steps have shuffled
        counted = Observation()
        table = materialize(
            df.observe(counted, F.count(F.lit(1)).alias("rows")), path, inputs=inputs, options=COMPACT
        )
        self.rows[name] = counted.get.get("rows") or 0
        return table

    def drop(self, path: str) -> None:
        """Delete a step that no later one reads, if nobody asked to keep them."""
        if not self.kept:
            remove(self.spark, path)


def build_graph(
    hosts: DataFrame,
    http: DataFrame,
    certs: DataFrame,
    dns: DataFrame,
    out: str,
    *,
    rules: SuffixRules | None = None,
    work: str | None = None,
    match_source: bool = True,
    partitions: int | None = None,
    cluster: bool = True,
    resume: bool = False,
    members: bool = False,
) -> dict[str, DataFrame]:
    """Write the eleven tables below ``out`` as Parquet and return scans of them.

    Steps that feed several others are stored in ``work`` (by default a folder
    in the checkpoint directory, where each is deleted when it was read for the last time). With ``resume`` and the same folders, a step that a
    former run has finished is read instead of computed if its scan tables are as they were.
    ``cluster`` lays the files out by id: their place is computed from the dense ids, so
    every join runs once. ``members`` adds the tables ``returns_members`` and
    ``redirects_members``, one row per edge and name or location, for edges whose lists
    would be too long. The rows of every stage are counted, see ``read_counters``.
    """
    spark = hosts.sparkSession
    rules = rules or SuffixRules(spark)
    scans = {"hosts": hosts, "http": http, "certs": certs, "dns": dns}
    kept = resume or work is not None
    steps = _Steps(spark, scans, f"{match_source} {rules.digest}", resume=resume, kept=kept)
    work = work or scratch_dir(spark, "graph")

    def step(name: str, df: DataFrame) -> DataFrame:
        return steps.store(name, df, f"{work}/{name}")

    hosts = clean_names(hosts, "server_name")
    dns = clean_names(dns, "domain")
    certs = valid_certs(certs)
    san = step("alt_names", san_names(certs))
    located = http.where(F.col("Location").isNotNull())
    located = with_redirect_host(located, F.col("Location"), rules)
    located = step("redirect_hosts", located.where(F.col("redirect_host").isNotNull()))

    names = [
        san.select("domain_name"),
        hosts.select("server_name"),
        dns.select("domain"),
        located.select("redirect_host"),
    ]
    domains = step("domains", domain_nodes(reduce(DataFrame.union, names), rules))
    addresses = ip_nodes(hosts.select("ip"), dns.select("ip"), san.select("ip"))
    keys = [certs.select("guid").distinct(), domains.select("guid"), addresses.select("guid").distinct()]
    ids = assign_ids(
        reduce(DataFrame.union, keys),
        partitions=partitions,
        path=f"{work}/ids",
        resume=resume,
        inputs=steps.inputs("ids"),
        distinct=True,
    )
    n_ids = steps.rows["ids"] = ids.count()
    small = small_kinds(ids, (CERT, DOMAIN, IP))

    def save(name: str, df: DataFrame, by: str, then: str | None, total: int, hub_pieces: int = 0) -> DataFrame:
        if cluster:
            df = cluster_by_id(df, by, ids=n_ids, total=total, then=then, hub_pieces=hub_pieces, partitions=partitions)
        elif partitions:
            df = df.drop(PIECES).repartition(partitions)
        return steps.store(name, df.drop(PIECES), f"{out}/{name}")

    observed = {
        "returns": returns_observations(hosts),
        "resolves": resolves_observations(hosts, dns),
        "contains": contains_observations(san),
        "redirects": redirect_observations(located, hosts, match_source=match_source),
        "subdomain_of": parent_edges(domains),
    }
    sets = {"sni": "server_name_indicators", "location": "locations"}
    ends = {
        "returns": ([IP], [CERT]),
        "resolves": ([DOMAIN], [IP]),
        "contains": ([CERT], [DOMAIN, IP]),
        "redirects": ([DOMAIN], [DOMAIN]),
        "subdomain_of": ([DOMAIN], [DOMAIN]),
    }

    def numbered_edges(name: str, folded: DataFrame, saved_as: str) -> DataFrame:
        """A stored table of edges between keys, as one between ids."""
        total = steps.rows[f"{saved_as}_keys"]
        heavy = heavy_ends(folded, total=total)
        hubs = heavy["from"] if cluster else HeavyKeys(("from",))
        rows = with_pieces(folded, hubs) if hubs else folded
        edges = resolve_endpoints(rows, ids, src_kinds=ends[name][0], dst_kinds=ends[name][1], heavy=heavy, small_kinds=small)
        order = [*_properties(edges), *([PIECES] if hubs else [])]
        table = save(saved_as, edges.select("src", "dst", *order), "src", "dst", total, hubs.pieces)
        steps.drop(f"{work}/{saved_as}_keys")
        return table

    def differ(name: str) -> bool:
        """Whether the observations of an edge kind can be folded without reducing them first."""
        if name not in ("returns", "resolves", "redirects"):
            return False
        rows, share = observed[name], 1
        if name == "redirects":  # of a join, a part is enough
            rows, share = _some_redirects(located, hosts, match_source=match_source), _SEEN
        rows = rows.where(F.col("from").isNotNull() & F.col("to").isNotNull())
        return folds_at_once(rows, ("from", "to"), share=share)

    tables: dict[str, DataFrame] = {}
    for name, seen in observed.items():
        seen = pack_keys(seen.where(F.col("from").isNotNull() & F.col("to").isNotNull()), "from", "to")
        if members and name in _MEMBERS:
            old, new = _MEMBERS[name]
            seen = step(f"{name}_observations", seen)
            rows = edge_members(seen, old, ("from", "to")).withColumnRenamed(old, new)
            numbered_edges(name, step(f"{name}_members_keys", rows), f"{name}_members")
        # Keys and ids correspond one to one: folding first makes the joins smaller.
        if name != "subdomain_of":  # a domain has one parent: these edges are distinct
            seen = fold_edges(seen, ("from", "to"), sets=sets, reduce_first=not differ(name))
        folded = step(f"{name}_keys", seen)
        steps.drop(f"{work}/{name}_observations")
        if name in _LAST_READ:
            steps.drop(f"{work}/{_LAST_READ[name]}")
        tables[name] = numbered_edges(name, folded, name)

    derived = {
        "subject_to": ("contains", lambda: semi_edges(tables["contains"], tables["returns"])),
        "assigned_to": ("returns", lambda: reverse_valid(tables["returns"])),
        "serves": ("resolves", lambda: reverse_valid(tables["resolves"])),
    }
    for name, (origin, edges) in derived.items():
        total = steps.rows[origin]
        hubs = heavy_keys(tables[origin], ["dst"], total=total) if cluster else HeavyKeys(("dst",))
        hubs = replace(hubs, columns=("src",))  # turned round, its target is the source
        rows = with_pieces(edges(), hubs) if hubs else edges()
        tables[name] = save(name, rows, "src", "dst", total, hubs.pieces)

    # The id table is the vertex table of names and addresses: their key holds
    # all there is. Ids follow the keys, so each kind is one stretch of it, and what is
    # read from it is laid out by id already. Only certificates have attributes to join.
    numbered = attach_degrees(ids, degrees(*(tables[name] for name in EDGES)))
    numbered = cluster_by_id(numbered, "id", ids=n_ids, total=n_ids, partitions=partitions)
    numbered = step("numbered", numbered)
    steps.drop(f"{work}/ids")
    metrics = ["inDegree", "outDegree"]
    of_certs = numbered.where(F.col("guid").startswith(CERT))
    rows = cert_nodes(certs)
    columns = [c for c in rows.columns if c != "guid"]
    rows = rows.join(of_certs, on="guid").select("id", *columns, *metrics)
    tables["certs"] = save("certs", rows, "id", None, n_ids)
    for name, kind, column in (("domains", DOMAIN, "domain_name"), ("ip_addresses", IP, "ip")):
        part = numbered.where(F.col("guid").startswith(kind))
        value = F.substr(F.col("guid"), F.lit(len(kind) + 1))
        part = part.select("id", value.alias(column), *metrics)
        tables[name] = steps.store(f"{name}_table", part, f"{out}/{name}")
    steps.drop(f"{work}/numbered")
    release_steps(spark)
    counters = spark.createDataFrame(sorted(steps.rows.items()), "stage string, n_rows long")
    counters.coalesce(1).write.mode("overwrite").parquet(f"{out}/counters")
    return tables


def read_counters(spark: SparkSession, out: str) -> DataFrame:
    """``(stage, n_rows)``: the rows of every stored step and table of the graph below ``out``."""
    return spark.read.parquet(f"{out}/counters")


def _properties(edges: DataFrame) -> list[str]:
    order = ["scan_dates", "server_name_indicator", "server_name_indicators", "location", "valid", "locations"]
    return [c for c in order if c in edges.columns]


def run(
    spark: SparkSession,
    folders: Sequence[str],
    store: str,
    out: str,
    *,
    kind: str = "parquet",
    dates: Sequence[str] = (),
    **options,
) -> dict[str, DataFrame]:
    """Ingest new scans of ``folders`` into ``store`` and build the graph below ``out``.

    ``dates`` limits the graph to some scans. ``kind="csv"`` adds import files.
    """
    ingest_scans(spark, folders, store)
    scans = {
        name: read_snapshot(spark, f"{store}/{name}", columns, dates)
        for name, columns in GRAPH_COLUMNS.items()
    }
    if kind == "parquet":
        return build_graph(**scans, out=out, **options)
    tables = build_graph(**scans, out=f"{store}/graph", **options)
    for name, table in tables.items():
        write_graph_table(table, f"{out}/{name}", kind=kind)
    return tables
