"""Source mappings: the dimension from a file and the as-of lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark import contracts as C

# Defaults of a mapping.
DEFAULT_PRODUCT = "sdar-mcp-provider-platform"
DEFAULT_ROUTES = ["standalone-smpp"]
IDENTITY = ["collector_id", "trust_domain", "deployment_id", "provider_id", "instance_id"]
MAPPING_SCHEMA = (
    "ordinal int, collector_id string, trust_domain string, deployment_id string, provider_id string, instance_id string, smpp_source_id string, tenant_id string, project_id string, environment string, "
    "source_product string, mapping_version int, policy_version int, route_ids array<string>, status string, valid_from timestamp, valid_to timestamp"
)
_FILE_SCHEMA = (
    "version string, mappings array<struct<collectorId:string,trustDomain:string,deploymentId:string,providerId:string,instanceId:string,smppSourceId:string,tenantId:string,projectId:string,environment:string,"
    "sourceProduct:string,mappingVersion:string,policyVersion:int,projectionRouteIds:array<string>,status:string,validFrom:timestamp,validTo:timestamp>>"
)


def load_source_mappings(spark: SparkSession, path: str, allow_wildcards: bool = False) -> DataFrame:
    """S4. The mapping file as rows in file order; raises ValueError with the contract's code."""
    doc = spark.read.schema(_FILE_SCHEMA).option("multiLine", True).json(path)
    head = doc.select("version", F.col("mappings").isNotNull().alias("some")).first()
    if head is None or head["version"] not in ("4", "4.0") or not head["some"]:
        raise ValueError("SOURCE_MAPPINGS_V4_REQUIRED")
    m = doc.select(F.posexplode("mappings").alias("ordinal", "m")).select("ordinal", "m.*")
    star = F.lit(False)
    for c in ("collectorId", "trustDomain", "deploymentId", "providerId", "instanceId"):
        star = star | F.coalesce(F.col(c) == "*", F.lit(False))
    bad_id = ~F.coalesce(F.col("smppSourceId").rlike(C.SOURCE_ID_PATTERN), F.lit(False))
    found = m.agg(F.max(star).alias("star"), F.max(bad_id).alias("id"), F.max(~F.col("mappingVersion").try_cast("double").eqNullSafe(4.0)).alias("version")).first()
    if found["star"] and not allow_wildcards:
        raise ValueError("SOURCE_MAPPING_WILDCARD_FORBIDDEN")
    if found["id"]:
        raise ValueError("SMPP_SOURCE_MAPPING_ID_MISSING")
    if found["version"]:
        raise ValueError("SOURCE_MAPPING_VERSION_INVALID")
    any_ = lambda c: F.coalesce(F.col(c), F.lit("*"))
    return m.select(
        "ordinal", any_("collectorId").alias("collector_id"), any_("trustDomain").alias("trust_domain"), any_("deploymentId").alias("deployment_id"), F.col("providerId").alias("provider_id"), any_("instanceId").alias("instance_id"),
        F.col("smppSourceId").alias("smpp_source_id"), F.col("tenantId").alias("tenant_id"), F.col("projectId").alias("project_id"), "environment", F.coalesce("sourceProduct", F.lit(DEFAULT_PRODUCT)).alias("source_product"),
        F.lit(4).alias("mapping_version"), F.coalesce("policyVersion", F.lit(1)).alias("policy_version"), F.coalesce("projectionRouteIds", F.array(*map(F.lit, DEFAULT_ROUTES))).alias("route_ids"), "status",
        F.coalesce("validFrom", F.lit("1970-01-01").cast("timestamp")).alias("valid_from"), F.col("validTo").alias("valid_to"),
    )


def resolve_source_mapping(records: DataFrame, mappings: DataFrame, max_broadcast_rows: int = 100_000) -> DataFrame:
    """J1. Adds ``mapping`` (null: unmapped): of the active entries that fit and are valid at ``received_at`` the first in file order.

    Entries of a provider meet its records by an equality join, as one array a provider, so no record is doubled
    or lost and nothing is sorted. Entries for any provider are one more array. The dimension is configuration; it is
    broadcast only after its rows are counted, which changes the plan alone.
    """
    fields = ["tenant_id", "project_id", "environment", "smpp_source_id", "mapping_version", "policy_version", "source_product", "route_ids"]
    entries = F.collect_list(F.struct("ordinal", *IDENTITY, "valid_from", "valid_to", F.struct(*fields).alias("mapping")))
    active = mappings.filter("status = 'active'")
    general = F.coalesce(F.col("provider_id") == "*", F.lit(True)) if "provider_id" in records.columns else F.lit(True)
    n = active.agg(F.count("*").alias("all"), F.count_if(general).alias("general")).first()

    def first_fit(candidates: str) -> Column:
        def fits(x: Column) -> Column:
            ok = (x["valid_from"] <= F.col("received_at")) & (x["valid_to"].isNull() | (F.col("received_at") < x["valid_to"]))
            for c in IDENTITY:
                if c in records.columns:
                    ok = ok & ((x[c] == "*") | x[c].eqNullSafe(F.col(c)))
            return ok

        return F.array_min(F.filter(candidates, fits))

    out, found = records, []
    for own, some in ((True, n["all"] > n["general"]), (False, n["general"] > 0)):
        if not some:
            continue
        if own:
            dim = active.filter(~general).groupBy(F.col("provider_id").alias("_provider")).agg(entries.alias("_own"))
            cond = F.col("provider_id") == F.col("_provider")
        else:
            # One row for all records.
            dim, cond = active.filter(general).agg(entries.alias("_general")), F.lit(True)
        out = out.join(F.broadcast(dim) if n["all"] <= max_broadcast_rows else dim, cond, "left")
        found.append(first_fit("_own" if own else "_general"))
    best = found[0] if len(found) == 1 else F.least(*found) if found else None
    kind = "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in mappings.select(fields).schema) + ">"
    mapping = F.lit(None).cast(kind) if best is None else best["mapping"]
    return out.withColumn("mapping", mapping).select(*records.columns, "mapping")
