"""Ingress and envelope validation: one ordered chain of rules, the first failure wins."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark import contracts as C
from telmark.functions import scalars as S


def parse_envelopes(df: DataFrame, column: str = "envelope_json") -> DataFrame:
    """S3. Envelope JSON text to the contract's columns, ``present_keys`` and ``is_object``.

    Scalars come as text, objects as JSON text. Text that is no JSON object has ``is_object`` false.
    """
    # A text that parses is an object if it begins as one.
    is_object = F.coalesce(F.col(column).rlike(r"^[ \t\r\n]*\{") & F.try_parse_json(F.col(column)).isNotNull(), F.lit(False))
    df, is_object = S.settled(df, {"is_object": is_object}), F.col("is_object")
    schema = ", ".join(f"`{key}` string" for _, key in C.ENVELOPE_FIELDS)
    parsed = F.from_json(F.when(is_object, F.col(column)), schema)
    out = df.withColumn("present_keys", F.when(is_object, F.json_object_keys(F.col(column)))).withColumn("_e", parsed)
    cols = {name: F.col(f"_e.{key}") for name, key in C.ENVELOPE_FIELDS}
    for number in ("provider_event_sequence", "observation_revision", "command_sequence"):
        cols[number] = cols[number].try_cast("bigint")
    cols["occurred_at"], cols["emitted_at"] = S.iso_timestamp(F.col("_e.occurredAt")), S.iso_timestamp(F.col("_e.emittedAt"))
    return out.withColumns(cols).drop("_e")


def validate_ingress(df: DataFrame, require_collector: bool = True, allowed_ids: list[str] | None = None) -> DataFrame:
    """P5. Adds ``ingress_code`` (null if fine) and ``context`` from ``resource`` overlaid by ``attributes`` (maps)."""
    get = lambda key: F.coalesce(F.col("attributes")[key], F.col("resource")[key])
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    collector, trust, deployment = get("telemetry.source.collector_id"), get("telemetry.source.trust_domain"), get("telemetry.source.deployment_id")
    rules = [(~get("telemetry.channel").eqNullSafe(C.CHANNEL), "CHANNEL_INVALID"), (~get("telemetry.source.system").eqNullSafe(C.SOURCE_SYSTEM), "SOURCE_SYSTEM_INVALID")]
    if require_collector:
        rules.append((empty(collector), "COLLECTOR_ID_REQUIRED"))
    if allowed_ids:
        rules.append((~F.coalesce(collector, F.lit("")).isin(allowed_ids), "COLLECTOR_ID_NOT_ALLOWED"))
    rules += [(empty(trust), "TRUST_DOMAIN_REQUIRED"), (empty(deployment), "DEPLOYMENT_ID_REQUIRED")]
    code = F.coalesce(*[F.when(c, F.lit(k)) for c, k in rules])
    context = F.struct(F.coalesce(collector, F.lit("")).alias("collector_id"), trust.alias("trust_domain"), deployment.alias("deployment_id"), F.coalesce(get("telemetry.ingress.mode"), F.lit("gateway")).alias("ingress_mode"))
    return df.withColumn("ingress_code", code).withColumn("context", F.when(F.col("ingress_code").isNull(), context))


def _names_evaluation(value: object, depth: int = 0) -> bool:
    if depth > 12:
        return False
    if isinstance(value, list):
        return any(_names_evaluation(item, depth + 1) for item in value)
    if isinstance(value, dict):
        return any(key in C.EVALUATION_KEYS or re.search(C.EVALUATION_PATTERN, key) or _names_evaluation(child, depth + 1) for key, child in value.items())
    return False


def _parsed(text: str) -> object:
    """The JSON value, null where the text is none; a string where it is nested beyond every limit."""
    try:
        return json.loads(text)
    except RecursionError:
        return _DEEP
    except ValueError:
        return None


_DEEP = object()


#: A key of the evaluation domain with its quotes and colon. In JSON without escapes it can stand nowhere but where a key does.
_EVALUATION = rf'"(?=[{"".join(sorted({k[0] for k in C.EVALUATION_KEYS}))}mfhtrgMFHTRG])(?:{"|".join(C.EVALUATION_KEYS)}|(?i:{C.EVALUATION_PATTERN.removeprefix("(?i)^").removesuffix("$")}))"\s*:'
_EVALUATION_CODE = "SMPP_EVALUATION_DOMAIN_IDENTITY_FORBIDDEN"


@F.pandas_udf(T.StringType())
def _walk_evaluation(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _EVALUATION_CODE if t is not None and _names_evaluation(_parsed(t)) else None)


def evaluation_forms(text: Column) -> Column:
    """``struct(odd, found)``: whether a plain text has such a key; the text if that takes a walk."""
    plain = F.coalesce(~F.contains(text, F.lit("\\")) & (_opens(text) <= 12), F.lit(True))
    return F.struct(F.when(~plain, text).alias("odd"), F.when(plain, text.rlike(_EVALUATION)).alias("found"))


def evaluation_code(forms: Column) -> Column:
    return F.coalesce(F.when(forms["found"], F.lit(_EVALUATION_CODE)), _walk_evaluation(forms["odd"]))


def forbid_evaluation_identity(text: Column) -> Column:
    """P8. The code if any key of the JSON text, 12 levels down at most, names an identity of the evaluation domain, else null.

    Texts without an escape and not deep are settled in the JVM; the others are walked, in Arrow batches.
    """
    return evaluation_code(evaluation_forms(text))


def _count(text: Column, chars: str) -> Column:
    """How often any of these ASCII characters stands in the text."""
    out = F.lit(0)
    for c in chars:
        out = out + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return out


def _opens(text: Column) -> Column:
    """Brackets that open, no fewer than the levels of a JSON text."""
    return _count(text, "{[")


@lru_cache(4096)
def _forbidden_key(key: str) -> bool:
    return re.search(C.FORBIDDEN_KEY, key) is not None


def _forbidden_value(value: str) -> bool:
    # One of these is part of every match; no other character folds to a letter of the word.
    return ("-----" in value or "://" in value or "bearer" in value.lower()) and re.search(C.FORBIDDEN_VALUE, value) is not None


def _walk(value: object, state: dict, limits: dict, depth: int = 0) -> str | None:
    if depth > limits["depth"]:
        return "PAYLOAD_TOO_DEEP"
    state["nodes"] += 1
    if state["nodes"] > limits["nodes"]:
        return "PAYLOAD_TOO_COMPLEX"
    if isinstance(value, str):
        if len(value.encode("utf-16-le", "surrogatepass")) // 2 > limits["string"]:
            return "STRING_TOO_LONG"
        if _forbidden_value(value):
            return "SENSITIVE_VALUE_DETECTED"
    elif isinstance(value, list):
        if len(value) > limits["array"]:
            return "ARRAY_TOO_LONG"
        for item in value:
            if code := _walk(item, state, limits, depth + 1):
                return code
    elif isinstance(value, dict):
        if len(value) > limits["object"]:
            return "OBJECT_TOO_WIDE"
        for key, child in value.items():
            if _forbidden_key(key) if len(key) <= 256 else re.search(C.FORBIDDEN_KEY, key):
                return "SENSITIVE_KEY_DETECTED"
            if code := _walk(child, state, limits, depth + 1):
                return code
    return None


#: The forbidden patterns, tried only at characters that can begin a match.
_SENSITIVE = [C.FORBIDDEN_KEY.replace("(?i)", "(?i)(?=[acdjprst])", 1), C.FORBIDDEN_VALUE.replace("(?i)", "(?i)(?=[-bmp])", 1)]


def _harmless(text: Column, bounds: dict) -> Column:
    """Whether the JSON text is within all limits by its counts and can hold no forbidden key or value."""
    # Each value but the first follows one of these characters, and no string has more UTF-16 units than the text has bytes.
    values = _count(text, ",:{[") + 1
    small = (F.octet_length(text) <= bounds["string"]) & (values <= min(bounds["nodes"], bounds["array"], bounds["object"])) & (_opens(text) <= bounds["depth"])
    return small & ~F.contains(text, F.lit("\\")) & ~text.rlike(_SENSITIVE[0]) & ~text.rlike(_SENSITIVE[1])


def sensitive_forms(text: Column, limits: dict | None = None) -> Column:
    """The text if it takes a walk to tell whether it is sensitive or beyond the limits, else null."""
    return F.when(~F.coalesce(_harmless(text, C.LIMITS | (limits or {})), F.lit(True)), text)


def sensitive_code(odd: Column, limits: dict | None = None) -> Column:
    bounds = C.LIMITS | (limits or {})

    @F.pandas_udf(T.StringType())
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else "PAYLOAD_TOO_DEEP" if (v := _parsed(t)) is _DEEP else _walk(v, {"nodes": 0}, bounds))

    return walk(odd)


def scan_sensitive(text: Column, limits: dict | None = None) -> Column:
    """P7. First code that a depth-first walk of the JSON meets, else null.

    Plain rows are settled in the JVM: short, with few values and shallow by count of separators and brackets, without an escape (which could spell a key or
    value in another way) and without a forbidden key or value. Only the others are walked, in Arrow batches.
    """
    return sensitive_code(sensitive_forms(text, limits), limits)


def normalize_correlation(df: DataFrame) -> DataFrame:
    """P9. Adds ``correlation_code`` (null if fine) and ``correlation`` from the attributes and envelope columns."""
    names = (("runtime", "originRuntimeInstanceIds"), ("task", "originTaskIds"), ("invocation", "originInvocationIds"))
    # Each column is worked out once and used several times below, so that Catalyst keeps the projections apart.
    out = df.withColumn("_v", F.try_parse_json("attributes_json")).withColumn("_c", F.try_variant_get("_v", "$.correlation", "variant"))
    member = lambda key: F.try_variant_get("_c", f"$.{key}", "variant")
    out = out.withColumns({f"_{n}": F.try_variant_get("_c", f"$.{key}", "array<string>") for n, key in names} | {f"_kind_{n}": F.coalesce(F.schema_of_variant(member(key)), F.lit("VOID")) for n, key in names} | {f"_{k}": F.try_variant_get("_c", f"$.{k}", "string") for k in ("originSystem", "originDeploymentId")})
    attr = lambda key: F.try_variant_get("_v", f"$.{key}", "string")
    corr = lambda key: F.col(f"_{key}") if key in ("originSystem", "originDeploymentId") else F.try_variant_get("_c", f"$.{key}", "string")
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    # Keys are listed only where the text could hold one of those looked for.
    keys_of = lambda text: F.coalesce(F.when(F.contains(text, F.lit("origin")) | F.contains(text, F.lit("\\")), F.json_object_keys(text)), F.array().cast("array<string>"))
    keys, payload_keys = keys_of(F.col("attributes_json")), keys_of(F.col("payload_json"))
    single = F.col("attributes_json").rlike("|".join(f'{k}"' for k in C.SINGULAR_ORIGIN_KEYS) + r"|\\")
    corr_keys = F.coalesce(F.when(single, F.json_object_keys(F.get_json_object("attributes_json", "$.correlation"))), F.array().cast("array<string>"))
    legacy = F.array(*[F.lit(k) for k in C.LEGACY_ORIGIN_KEYS])
    singular = F.array(*[F.lit(k) for k in C.SINGULAR_ORIGIN_KEYS])
    arrays, kinds = {n: F.col(f"_{n}") for n, _ in names}, {n: F.col(f"_kind_{n}") for n, _ in names}
    invalid, large = F.lit("SMPP_ORIGIN_METADATA_INVALID"), F.lit("SMPP_ORIGIN_METADATA_TOO_LARGE")
    steps = [
        F.when(F.arrays_overlap(keys, legacy) | F.arrays_overlap(payload_keys, legacy), invalid),
        F.when(~(kind(F.col("_c")).startswith("OBJECT") | (kind(F.col("_c")) == "VOID")), invalid),
        F.when(F.arrays_overlap(corr_keys, singular), invalid),
    ]
    for name in ("runtime", "task", "invocation"):
        a, k = arrays[name], kinds[name]
        steps.append(F.when(~(k.startswith("ARRAY") | (k == "VOID")), invalid))
        steps.append(F.when(F.size(a) > 64, large))
        # A null element is skipped by none of the rules, so only strings of 1 to 256 characters or nulls pass.
        steps.append(F.when(~k.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>") | F.exists(a, lambda x: x.isNotNull() & ~F.length(x).between(1, 256)), invalid))
    for key, most in (("originSystem", 64), ("originDeploymentId", 256)):
        k = kind(member(key))
        steps.append(F.when((k != "VOID") & ~((k == "STRING") & F.length(corr(key)).between(1, most)), invalid))
    some = F.lit(0)
    for a in arrays.values():
        some = some + F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0))
    steps.append(F.when((some > 0) & corr("originSystem").isNull(), F.lit("SMPP_ORIGIN_SYSTEM_MISSING")))
    steps.append(F.when((some > 0) & (corr("originSystem") == C.ORIGIN_SYSTEM) & corr("originDeploymentId").isNull(), F.lit("SMPP_ORIGIN_DEPLOYMENT_MISSING")))
    first = lambda column, key: F.coalesce(F.col(column), corr(key), attr(key)).alias(column)
    value = F.struct(
        first("correlation_id", "correlationId"), first("causation_record_id", "causationRecordId"), first("trace_id", "traceId"), first("span_id", "spanId"),
        F.coalesce(corr("routeId"), attr("routeId")).alias("route_id"), F.coalesce(corr("attemptNo"), attr("attemptNo")).alias("attempt_no"),
        corr("originSystem").alias("origin_system"), corr("originDeploymentId").alias("origin_deployment_id"),
        *[S.origin_ids(F.filter(arrays[n], lambda x: x.isNotNull())).alias(f"origin_{n}_ids") for n in ("runtime", "task", "invocation")],
        F.lit(C.SEMANTIC_CLASS).alias("semantic_class"), F.lit(False).alias("authoritative"), F.lit(False).alias("may_select_facts"), F.lit(False).alias("may_override_binding"),
        F.lit(C.POLICY_ID).alias("policy_id"), F.lit(C.POLICY_VERSION).alias("policy_version"),
    )
    return out.withColumns({"correlation_code": F.coalesce(*steps), "correlation": value}).select(*df.columns, "correlation_code", "correlation")


def _rules(columns: list[str]) -> list[tuple[Column, str]]:
    """Steps 1 to 16, in order."""
    c = lambda name: F.col(name)
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit("null"))
    falsy = lambda name: F.coalesce(c(name).cast("string"), F.lit("")) == ""
    business = F.startswith(text("record_type"), F.lit(C.BUSINESS_PREFIX))
    expected = F.create_map(*[F.lit(x) for kv in C.CATEGORY_OF.items() for x in kv])[c("record_type")]
    rules: list[tuple[Column, str]] = []
    if "is_object" in columns:
        rules.append((~c("is_object"), "ENVELOPE_NOT_OBJECT"))
    if "present_keys" in columns:
        missing = F.size(F.array_except(F.array(*[F.lit(k) for k in C.REQUIRED_KEYS]), c("present_keys"))) > 0
        rules.append((F.coalesce(missing, F.lit(False)), "REQUIRED_FIELD_MISSING"))
    command = F.get_json_object(S.may_hold(F.col("payload_json"), "externalCommandId"), "$.externalCommandId") if "payload_json" in columns else F.lit(None).cast("string")
    rt = text("record_type")
    local = (
        F.when(rt == "provider.task.lifecycle", falsy("task_id"))
        .when(rt == "provider.command.lifecycle", falsy("external_command_id") & (F.coalesce(command, F.lit("")) == ""))
        .when(rt.startswith("provider.resource."), falsy("resource_id"))
        .when(rt == "provider.execution.progress", falsy("external_execution_id"))
        .when(business, falsy("provider_event_id") | ~F.coalesce(c("provider_event_sequence").between(0, 9007199254740991), F.lit(False)))
        .otherwise(False)
    )
    trace = c("trace_id").isNotNull() & ~text("trace_id").rlike(C.TRACE_PATTERN)
    span = c("span_id").isNotNull() & ~text("span_id").rlike(C.SPAN_PATTERN)
    rules += [
        (~c("schema_name").eqNullSafe(C.SCHEMA_NAME), "SCHEMA_NAME_INVALID"),
        (~c("schema_version").eqNullSafe(C.SCHEMA_VERSION), "SCHEMA_VERSION_UNSUPPORTED"),
        (~text("record_id").rlike(C.UUID_PATTERN), "RECORD_ID_INVALID"),
        (~text("record_hash").rlike(C.HASH_PATTERN), "RECORD_HASH_INVALID"),
        (~rt.isin(C.RECORD_TYPES), "RECORD_TYPE_UNSUPPORTED"),
        (~text("event_category").isin(C.EVENT_CATEGORIES), "EVENT_CATEGORY_UNSUPPORTED"),
        (~text("delivery_class").isin(C.DELIVERY_CLASSES), "DELIVERY_CLASS_UNSUPPORTED"),
        (falsy("provider_id") | falsy("instance_id"), "SOURCE_IDENTITY_MISSING"),
        (trace, "TRACE_ID_INVALID"),
        (span, "SPAN_ID_INVALID"),
        (c("occurred_at").isNull() | c("emitted_at").isNull(), "TIMESTAMP_INVALID"),
        (c("emitted_at") < c("occurred_at"), "SMPP_EVENT_TIME_INVALID"),
        (~expected.eqNullSafe(c("event_category")), "RECORD_EVENT_CATEGORY_MISMATCH"),
        (local, "PROVIDER_LOCAL_IDENTITY_MISSING"),
    ]
    return rules


def validate_envelopes(df: DataFrame, limits: dict | None = None, check_hash: bool = True) -> DataFrame:
    """P6. Adds ``error_code`` and ``error_message``; both null for a valid envelope.

    Takes envelope columns (from ``parse_envelopes`` or a table). Steps 17 to 22 apply where their
    inputs are there: ``envelope_json``, ``attributes_json`` and the ``otlp`` map.
    """
    cols = df.columns
    steps = [F.when(F.coalesce(cond, F.lit(False)), F.lit(code)) for cond, code in _rules(cols)]
    out, drop = df, []
    if "envelope_json" in cols:
        # Texts are looked through only where no rule has failed before.
        out, drop = S.settled(out, {"_rule": F.coalesce(*steps)}), ["_rule"]
        steps = []
    if "attributes_json" in cols and "payload_json" in cols:
        out, drop = normalize_correlation(out), [*drop, "correlation_code", "correlation"]
        steps.append(F.col("correlation_code"))
    if "otlp" in cols:
        o = lambda k: F.col("otlp")[k]
        pairs = [("sdar.schema.name", "schema_name", "OTLP_SCHEMA_NAME_MISMATCH"), ("sdar.schema.version", "schema_version", "OTLP_SCHEMA_VERSION_MISMATCH"), ("sdar.record.id", "record_id", "OTLP_RECORD_ID_MISMATCH"), ("sdar.record.hash", "record_hash", "OTLP_RECORD_HASH_MISMATCH")]
        steps += [F.when(F.coalesce(o(k), F.lit("")) == "", F.lit("OTLP_CONTRACT_ATTRIBUTE_MISSING")) for k, _, _ in pairs]
        steps += [F.when(~o(k).eqNullSafe(F.col(name)), F.lit(code)) for k, name, code in pairs]
        version = o("telemetry.contract.version")
        steps.append(F.when((F.coalesce(version, F.lit("")) != "") & ~version.eqNullSafe(F.col("schema_version")), F.lit("OTLP_SCHEMA_VERSION_MISMATCH")))
    if "envelope_json" in cols:
        none = F.lit(None).cast("string")
        out = S.settled(out, {"_later": F.when(F.col("_rule").isNull(), F.coalesce(*steps, none))})
        text = F.when(F.col("_rule").isNull(), F.col("envelope_json"))
        passed = F.when(F.col("_rule").isNull() & F.col("_later").isNull(), F.col("envelope_json"))
        identity, scanned = evaluation_forms(text), sensitive_forms(passed, limits)
        big = F.octet_length("envelope_json") > C.LIMITS["bytes"]
        settled = {"_identity": identity, "_scanned": scanned, "_big": big} | ({"_hashed": S.hash_forms(passed)} if check_hash else {})
        out = S.settled(out, settled)
        differs = ~S.hash_of(F.col("_hashed")).eqNullSafe(F.col("record_hash")) if check_hash else F.lit(False)
        hashed, big = F.when(differs, F.lit("RECORD_HASH_MISMATCH")), F.when(F.col("_big"), F.lit("EVENT_TOO_LARGE"))
        # One pass through Python serves the walks and the hash, without the texts that need neither. The hash is null where a rule has failed before, and so read after those.
        code = F.coalesce("_rule", evaluation_code(F.col("_identity")), "_later", hashed, sensitive_code(F.col("_scanned"), limits), big)
        drop += ["_later", *settled]
    else:
        code = F.coalesce(*steps)
    message = F.col("_code")
    if "present_keys" in cols:
        missing = F.array_except(F.array(*[F.lit(k) for k in C.REQUIRED_KEYS]), F.col("present_keys"))
        message = F.when(message == "REQUIRED_FIELD_MISSING", F.get(missing, F.lit(0))).otherwise(message)
    # A generator's output is no expression that a caller's filter on it could repeat: the chain is worked once a row.
    verdict = F.inline(F.array(F.struct(F.col("_code").alias("error_code"), error_summary(message).alias("error_message"))))
    kept = [c for c in out.columns if c not in (*drop, "error_code", "error_message") or c == "correlation"]
    return out.withColumn("_code", code).select(*kept, verdict)


def safe_source_hint(df: DataFrame) -> Column:
    """P10. JSON of the identity columns that are short and plain."""
    names = [("schemaName", "schema_name"), ("schemaVersion", "schema_version"), ("recordId", "record_id"), ("recordHash", "record_hash"), ("recordType", "record_type"), ("providerId", "provider_id"), ("instanceId", "instance_id")]
    return F.to_json(F.struct(*[F.when(F.col(c).rlike(C.HINT_PATTERN), F.col(c)).alias(k) for k, c in names if c in df.columns]))


def error_summary(message: Column) -> Column:
    """P11."""
    return F.substring(message, 1, 256)
