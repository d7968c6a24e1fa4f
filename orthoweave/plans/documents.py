"""Queries on sidecars, manifests and logs, rendered from the tables as text and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import documents
from orthoweave.plans.registry import query
from orthoweave.sources.roles import SCENES, TELEMETRY, scenes, table, telemetry

_S = f"WITH {SCENES}"


def _tag(name, value):
    return F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))


@query("S7 B149", _S + " SELECT entity_id, west, south, east, north FROM scenes")
def bbox_xml(spark, sf_dir):
    c = F.col
    xml = F.concat(F.lit("<idinfo><spdom><bounding>"), _tag("westbc", c("west")), _tag("eastbc", c("east")), _tag("northbc", c("north")), _tag("southbc", c("south")), F.lit("</bounding></spdom></idinfo>"))
    rows = scenes(spark, sf_dir).select("entity_id", xml.alias("xml"))
    return rows.select("entity_id", *[v.alias(k) for k, v in documents.bbox_xml(c("xml")).items()])


@query("S8", _S + " SELECT entity_id, north AS nw_lat, west AS nw_lon, CAST(acq_date AS VARCHAR) AS acquired FROM scenes")
def portal_xml(spark, sf_dir):
    c = F.col
    field = lambda name, v: F.concat(F.lit("<metadataField>"), _tag("fieldName", F.lit(name)), _tag("metadataValue", v), F.lit("</metadataField>"))
    xml = F.concat(F.lit("<scene><metadataFields>"), field("NW Corner Lat dec", c("north")), field("NW Corner Long dec", c("west")), field("Acquisition Date", c("acq_date")), F.lit("</metadataFields></scene>"))
    rows = scenes(spark, sf_dir).select("entity_id", documents.portal_fields(xml).alias("f"))
    return rows.select("entity_id", c("f")["NW Corner Lat dec"].cast("double").alias("nw_lat"), c("f")["NW Corner Long dec"].cast("double").alias("nw_lon"), c("f")["Acquisition Date"].alias("acquired"))


@query("S9 S10", _S + " SELECT entity_id, CASE WHEN entity_id % 3 = 2 THEN NULL ELSE west END AS west, east, 'p' || entity_id AS name FROM scenes")
def prior_json(spark, sf_dir):
    """A list, an object of priors with other names for its sides, and a single object whose west is 0."""
    k, c = F.col("entity_id"), F.col
    name = F.concat(F.lit("p"), k)
    long_, short = F.struct(c("west").alias("west"), c("east").alias("east"), name.alias("name")), F.struct(c("west").alias("left"), c("east").alias("right"), name.alias("name"))
    text = F.when(k % 3 == 0, F.to_json(F.array(long_))).when(k % 3 == 1, F.to_json(F.struct(F.array(short).alias("priors")))).otherwise(F.to_json(F.struct(F.lit(0.0).alias("west"), c("east").alias("east"), name.alias("name"))))
    rows = scenes(spark, sf_dir).select(k, F.explode(documents.priors(text)).alias("p"))
    return rows.select("entity_id", "p.west", "p.east", "p.name")


@query("S12 U6", "WITH f AS (SELECT p_partkey % 100 AS stem, p_partkey AS path, p_size % 4 AS kind FROM part) SELECT stem, kind, min(path) AS path FROM f GROUP BY ALL")
def sidecar_discovery(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") % 100).alias("stem"), F.col("p_partkey").alias("path"), (F.col("p_size") % 4).alias("kind"))
    return documents.first_of_each(rows, key=["stem", "kind"], order=["path"])


@query("S13 S14 S15 F42", "SELECT o_custkey AS strip, count(*) AS jobs, count(*) FILTER (WHERE o_orderstatus = 'F') AS own_profile, sum(CAST(CASE WHEN o_orderstatus = 'F' THEN 4 ELSE 9 END AS BIGINT))::BIGINT AS profile_sum FROM orders GROUP BY o_custkey")
def manifest_jobs(spark, sf_dir):
    job = F.create_map(F.lit("input"), F.col("o_orderkey").cast("string"), F.lit("profile"), F.when(F.col("o_orderstatus") == "F", "4"), F.lit("note"), F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("strip")).agg(F.to_json(F.struct(F.create_map(F.lit("profile"), F.lit("9")).alias("shared"), F.collect_list(job).alias("jobs"))).alias("text"))
    jobs = documents.manifest_jobs(rows, "text", fields=["input", "profile"])
    return jobs.groupBy("strip").agg(F.count("*").alias("jobs"), F.count_if(F.col("profile") == "4").alias("own_profile"), F.sum(F.col("profile").cast("long")).alias("profile_sum"))


@query("S37 B158", f"WITH {TELEMETRY} SELECT scene, max(seq) FILTER (stage <> 'error')::DOUBLE AS last_step, arg_max(round(residual_m, 2), seq) AS last_residual FROM telemetry GROUP BY scene")
def log_fields(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    line = F.concat(F.when(F.col("stage") != "error", F.concat(F.lit("step "), "seq", F.lit(" "))).otherwise(""), F.lit("residual: "), F.format_string("%.2f", F.round("residual_m", 2)), F.lit(" m"))
    return documents.log_fields(rows.select("scene", "seq", line.alias("line")), run="scene", line="line", patterns={"last_step": r"step (\d+)", "last_residual": r"residual: (-?[\d.]+)"})


@query("S39 B148", _S + " SELECT entity_id, west, south, east, north FROM scenes")
def boundary_text(spark, sf_dir):
    c = F.col
    ring = F.array(*[F.array(c(x), c(y)) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    geo = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(ring).alias("coordinates")).alias("geometry"))).alias("features")))
    text = F.when(c("entity_id") % 2 == 0, geo).otherwise(F.concat_ws(" , ", "west", "south", "east", "north"))
    return scenes(spark, sf_dir).select("entity_id", documents.boundary_box(text).alias("b")).select("entity_id", "b.*")


@query("K5", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'aligned' ELSE 'stitched' END AS status, 'kh4b' AS profile FROM orders")
def metadata_merge(spark, sf_dir):
    old = F.create_map(F.lit("status"), F.lit("stitched"), F.lit("profile"), F.lit("kh4b"))
    new = F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("status"), F.lit("aligned"))).otherwise(F.create_map().cast("map<string,string>"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", documents.merged(old, new).alias("m"))
    return rows.select("o_orderkey", F.col("m")["status"].alias("status"), F.col("m")["profile"].alias("profile"))


@query("K6", """SELECT p_partkey, sha256('{"designation":"' || CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'F' END || '","profile":"' || p_brand || '","size":' || p_size || '}') AS key FROM part""")
def cache_key(spark, sf_dir):
    got = documents.cache_key(profile=F.col("p_brand"), designation=F.when(F.col("p_size") % 2 == 0, "A").otherwise("F"), size=F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", got.alias("key"))


@query("K7 K8", "SELECT p_partkey, p_size % 4 >= 2 AND p_size % 3 = 0 AS ok FROM part")
def provenance(spark, sf_dir):
    size = F.col("p_size")
    ok = documents.provenance_matches({"name": F.col("p_brand"), "size": size}, {"name": F.col("p_brand"), "size": F.when(size % 3 == 0, size)}, size % 4)
    return table(spark, sf_dir, "part").select("p_partkey", ok.alias("ok"))


@query("K10", "SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_quantity < 10 OR l_discount * 1000 > l_quantity OR l_tax * 1000 > l_quantity) AS stale FROM lineitem GROUP BY ALL")
def stale_outputs(spark, sf_dir):
    q = F.col("l_quantity")
    is_stale = documents.stale(F.when(q >= 10, q), F.col("l_discount") * 1000, F.col("l_tax") * 1000)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.count_if(is_stale).alias("stale"))


@query("B37", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n FROM part")
def path_lists(spark, sf_dir):
    s = F.col("p_size") % 3
    text = F.when(s == 0, F.to_json(F.array("p_brand", "p_name"))).when(s == 1, F.col("p_name")).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", F.size(documents.path_list(text)).alias("n"))


@query("F27 B85", "SELECT p_partkey, p_retailprice AS focal, p_size AS pitch, p_brand AS name FROM part")
def camera_file(spark, sf_dir):
    text = documents.camera_text(f=F.col("p_retailprice"), pitch=F.col("p_size"), camera=F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select("p_partkey", documents.camera_fields(text).alias("m"))
    return rows.select("p_partkey", F.col("m")["f"].cast("double").alias("focal"), F.col("m")["pitch"].cast("int").alias("pitch"), F.col("m")["camera"].alias("name"))


@query("B95", "SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN '/vsicurl/r' || p_partkey || ',/vsicurl/g' || p_partkey END AS urls FROM part")
def asset_urls(spark, sf_dir):
    k = F.col("p_partkey")
    href = lambda c: F.struct(F.concat(F.lit(c), k).alias("href"))
    item = F.to_json(F.struct(F.struct(href("r").alias("red"), F.when(F.col("p_size") % 3 != 0, href("g")).alias("green")).alias("assets")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(documents.asset_urls(item, ["red", "green"]), ",").alias("urls"))
