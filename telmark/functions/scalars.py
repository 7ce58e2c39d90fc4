"""Scalar functions as Column expressions: canonical JSON, hashes, ids, URNs, payload fields."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark import contracts as C

# Numbers whose text differs between the engine's JSON writer and the canonical form.
_ODD_NUMBER = r'[:\[,]\s*-?(?:[0-9]*\.?[0-9]+[eE]|0\.0000|[0-9]{16,}|[0-9]+\.0*[,}\]]|-0[,}\]])'


def _number(x: float | int) -> str:
    """A number as ECMAScript prints it."""
    if isinstance(x, bool):
        return "true" if x else "false"
    x = float(x)
    if x == 0:
        return "0"
    digits, exp = f"{x!r}", 0
    if "e" in digits:
        digits, _, e = digits.partition("e")
        exp = int(e)
    sign = "-" if digits.startswith("-") else ""
    digits = digits.lstrip("-")
    whole, _, frac = digits.partition(".")
    point = len(whole) + exp
    all_digits = (whole + frac).lstrip("0")
    point -= len(whole + frac) - len((whole + frac).lstrip("0"))
    all_digits = all_digits.rstrip("0")
    n = len(all_digits)
    if n <= point <= 21:
        return sign + all_digits + "0" * (point - n)
    if 0 < point <= 21:
        return sign + all_digits[:point] + "." + all_digits[point:]
    if -6 < point <= 0:
        return sign + "0." + "0" * -point + all_digits
    e = point - 1
    return sign + all_digits[0] + ("." + all_digits[1:] if n > 1 else "") + f"e{'+' if e >= 0 else '-'}{abs(e)}"


def canonical_text(value: object) -> str:
    """Canonical JSON of a parsed value: keys by UTF-16 code unit, no white space."""
    import json

    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + canonical_text(value[k]) for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical_text, value)) + "]"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return _number(value)
    return json.dumps(value, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def _canonical_odd(texts: pd.Series) -> pd.Series:
    import json

    return texts.map(lambda t: None if t is None else canonical_text(json.loads(t)))


def canonical_json(text: Column) -> Column:
    """F1. Canonical JSON text; null for text that is no JSON. Only rows with unusual numbers leave the JVM."""

    def forms(t: Column) -> Column:
        plain = F.to_json(F.try_parse_json(t))
        odd = t.rlike(_ODD_NUMBER)
        # The text, however it is made, is worked out once for both.
        return F.struct(F.when(odd & plain.isNotNull(), t).alias("odd"), F.when(~odd, plain).alias("plain"))

    both = let(text, forms)
    return F.coalesce(_canonical_odd(both["odd"]), both["plain"])


def canonical_json_native(text: Column) -> Column:
    """F1 without the number fallback, for inputs whose numbers are known to be plain."""
    return F.to_json(F.try_parse_json(text))


def _odd_members(members: Column, text: Column) -> Column:
    """Whether the JSON text of a map of variants has a number, or a control character, that is written in another way than the canonical one. Of a long text only members with numbers are looked through."""
    numeric = lambda v: F.schema_of_variant(v).rlike("BIGINT|DECIMAL|DOUBLE|VARIANT")
    return F.contains(text, F.lit("\\u00")) | F.when(F.octet_length(text) <= 1024, text.rlike(_ODD_NUMBER)).otherwise(F.to_json(F.filter(F.map_values(members), numeric)).rlike(_ODD_NUMBER))


def hash_forms(envelope: Column) -> Column:
    """The envelope without the delivery keys, as ``struct(odd, hash)``: its hash, or where numbers are to be written again its text.

    Members of a variant come in order of their keys and print as canonical JSON, so that the text is parsed and written once.
    """
    fields = F.try_variant_get(F.try_parse_json(envelope), "$", "map<string,variant>")

    kept = let(F.map_filter(fields, lambda k, _: ~k.isin(C.HASH_EXCLUDED)), lambda m: F.struct(m.alias("members"), F.to_json(m).alias("text")))
    told = let(kept, lambda x: F.struct(x["text"].alias("text"), _odd_members(x["members"], x["text"]).alias("is_odd")))
    return let(told, lambda x: F.struct(F.when(x["is_odd"], x["text"]).alias("odd"), F.when(~x["is_odd"], F.sha2(x["text"], 256)).alias("hash")))


def hash_of(forms: Column) -> Column:
    """F2 of ``hash_forms``. A caller that settles these first has them worked out once, not before and after the way through Python."""
    return F.coalesce(forms["hash"], F.sha2(_canonical_odd(forms["odd"]), 256))


def record_hash(envelope: Column, native: bool = False) -> Column:
    """F2. SHA-256 of the canonical envelope without the delivery keys."""
    forms = hash_forms(envelope)
    return let(forms, lambda f: F.coalesce(f["hash"], F.sha2(f["odd"], 256))) if native else hash_of(forms)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, wherever the expression stands."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns through a generator: its output is no expression that later uses could repeat, so each is worked out once a row."""
    made = df.withColumns({f"_{k}": v for k, v in columns.items()})
    kept = [c for c in df.columns if c not in columns]
    return made.select(*[f"`{c}`" for c in kept], F.inline(F.array(F.struct(*[F.col(f"_{k}").alias(k) for k in columns]))))


def uuid_v5(name: Column) -> Column:
    """F3. Version 5 UUID of a name in the contract's namespace."""
    def text(h: Column) -> Column:
        part = lambda a, n: F.substring(h, a, n)
        variant = F.substring(F.lit("89ab89ab89ab89ab"), F.instr(F.lit("0123456789abcdef"), part(17, 1)), F.lit(1))
        return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))

    return let(F.sha1(F.concat(F.unhex(F.lit(C.UUID_NAMESPACE)), F.encode(name, "UTF-8"))), text)


def fact_id(record_id: Column, record_type: Column) -> Column:
    """F4."""
    return uuid_v5(F.concat_ws("|", F.lit(C.SOURCE_SYSTEM), record_id, record_type))


def _by_key(value: Column, kind: T.DataType) -> Column | None:
    """The value with the fields of all its structs in order of their names; null if its JSON needs more than that to be canonical."""
    if isinstance(kind, T.StructType):
        parts = {f.name: _by_key(value[f.name], f.dataType) for f in sorted(kind, key=lambda f: f.name.encode("utf-16-be"))}
        return None if any(p is None for p in parts.values()) else F.when(value.isNotNull(), F.struct(*[p.alias(k) for k, p in parts.items()]))
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, (T.StructType, T.ArrayType)):
            return None if _by_key(value[0], inner) is None else F.transform(value, lambda x: _by_key(x, inner))
        return value if _by_key(value, inner) is not None else None
    return value if isinstance(kind, (T.StringType, T.IntegerType, T.LongType, T.BooleanType, T.TimestampType)) else None


def fact_hash(fact: Column, kind: T.StructType | None = None) -> Column:
    """F5. Hash of a fact struct (which must leave out the time of normalization).

    With its type, fields are put in order before they are written, so that the text need not be parsed and written again.
    """
    ordered = None if kind is None else _by_key(fact, kind)
    text = F.to_json(fact if ordered is None else ordered, {"ignoreNullFields": "false"})
    return F.sha2(canonical_json_native(text) if ordered is None else text, 256)


def relation_id(fact: Column, source: Column, target: Column, kind: Column) -> Column:
    """F6."""
    return uuid_v5(F.concat_ws("|", fact, source, target, kind))


def encode_uri_component(text: Column) -> Column:
    """F8. Percent-encoding that leaves letters, digits and ``-_.!~*'()``."""
    out = F.url_encode(text)
    for code, char in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def entity_urn(tenant: Column, system: Column, deployment: Column, kind: Column, local_id: Column) -> Column:
    """F7. Null unless all five parts are non-empty."""
    parts = [tenant, system, deployment, kind, local_id]
    ok = F.lit(True)
    for p in parts:
        ok = ok & F.coalesce(F.length(p) > 0, F.lit(False))
    return F.when(ok, F.concat_ws(":", F.lit("urn:telemetry"), encode_uri_component(tenant), system, encode_uri_component(deployment), kind, encode_uri_component(local_id)))


def parse_urn(urn: Column) -> Column:
    """F9. ``struct(tenant_id, source_system, deployment_id, entity_type, entity_id)``; null if the URN is not canonical."""
    parts = F.split(urn, ":", -1)
    at = lambda i: F.get(parts, F.lit(i))
    # A literal plus stands for itself in a URN, unlike in a query string.
    decode = lambda p: F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))
    ok = (F.size(parts) == 7) & (at(0) == "urn") & (at(1) == "telemetry") & at(3).rlike(C.URN_NAME_PATTERN) & at(5).rlike(C.URN_NAME_PATTERN)
    for i in (2, 4, 6):
        ok = ok & (F.length(at(i)) > 0) & (encode_uri_component(decode(at(i))) == at(i))
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(decode(at(2)).alias("tenant_id"), at(3).alias("source_system"), decode(at(4)).alias("deployment_id"), at(5).alias("entity_type"), decode(at(6)).alias("entity_id")))


def variant_type(value: Column) -> Column:
    """The type name of a variant: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>; null if absent."""
    return F.schema_of_variant(value)


def _number_type(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)")


def payload_semantics(record_type: Column, payload: Column) -> Column:
    """F10. ``struct(error_code, <typed fields>)`` of a payload JSON text by the record type's catalog.

    A field that is present with a wrong type makes ``error_code`` SMPP_PAYLOAD_CONTRACT_INVALID. The text is parsed once for all fields.
    """
    return let(F.try_parse_json(payload), lambda v: _semantics_of(record_type, v))


def _semantics_of(record_type: Column, v: Column) -> Column:
    kind_of = lambda key: variant_type(F.try_variant_get(v, f"$.{key}", "variant"))
    text_of = lambda key: F.try_variant_get(v, f"$.{key}", "string")
    sources = sorted({(s, C.PAYLOAD_KINDS.get(c, "string")) for t in C.RECORD_TYPES for c, s in C.PAYLOAD_CATALOG[t].items()})
    valid = {}
    for source, kind in sources:
        t, s = kind_of(source), text_of(source)
        if kind == "string":
            good = (t == "STRING") & F.length(s).between(1, 512)
        elif kind == "utc":
            good = (t == "STRING") & s.rlike(C.UTC_PATTERN) & F.try_to_timestamp(s).isNotNull()
        else:
            good = _number_type(t) & F.try_variant_get(v, f"$.{source}", "double").between(0.0, 100.0)
        valid[source] = t.isNull() | F.coalesce(good, F.lit(False))
    bad, columns = F.lit(False), {c: F.lit(None).cast("string") for c in C.SEMANTIC_COLUMNS}
    for rt in C.RECORD_TYPES:
        wrong = F.lit(False)
        for source in C.PAYLOAD_CATALOG[rt].values():
            wrong = wrong | ~valid[source]
        bad = F.when(record_type == rt, wrong).otherwise(bad)
    for c in C.SEMANTIC_COLUMNS:
        by_source: dict[str, list[str]] = {}
        for rt in C.RECORD_TYPES:
            if c in C.PAYLOAD_CATALOG[rt]:
                by_source.setdefault(C.PAYLOAD_CATALOG[rt][c], []).append(rt)
        expr = F.lit(None).cast("string")
        for source, types in by_source.items():
            expr = F.when(record_type.isin(types), text_of(source)).otherwise(expr)
        columns[c] = expr
    # A JSON null is present and of a wrong type; only an absent key is skipped.
    not_object = ~F.coalesce(variant_type(v).startswith("OBJECT"), F.lit(False))
    code = F.when(~F.coalesce(record_type.isin(C.RECORD_TYPES), F.lit(False)), "SMPP_PAYLOAD_CONTRACT_MISSING").when(not_object | bad, "SMPP_PAYLOAD_CONTRACT_INVALID")
    cols = [columns[c].cast("double" if c == "progress_percent" else "string").alias(c) for c in C.SEMANTIC_COLUMNS]
    return F.struct(code.alias("error_code"), *cols)


def core_table_of(fact_type: Column) -> Column:
    """J3. The specialised core table of a record type; null if none."""
    return F.create_map(*[F.lit(x) for kv in C.CORE_TABLE_OF.items() for x in kv])[fact_type]


def first_ref(refs: Column, kind: str, field: str) -> Column:
    return F.get(F.filter(refs, lambda r: r["entity_type"] == kind), F.lit(0))[field]


def local_id(refs: Column, kind: str) -> Column:
    """F12. Local id of the first reference of a type, else an empty string."""
    return F.coalesce(first_ref(refs, kind, "local_id"), F.lit(""))


def primary_entity_urn(refs: Column, fallback: Column) -> Column:
    """F11. The task's, else the resource's, else the provider's URN, else the source instance's."""
    return F.coalesce(*[first_ref(refs, k, "urn") for k in ("task", "resource", "provider")], fallback)


def safe_int(text: Column) -> Column:
    """F13. A JSON number token within 2^53, else the text as a JSON string."""
    n = text.try_cast("decimal(38,0)")
    return F.when(F.abs(n) <= F.lit(9007199254740991).cast("decimal(38,0)"), n.cast("string")).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"\s*(Z|UTC|GMT)?\s*([+-]\d{2}:?\d{2})?(?:\s*\([^()]*\))?"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_NAME = rf"({'|'.join(_MONTHS.split())})[a-z]*"
_WEEKDAY = r"(?:(?:sun|mon|tue|wed|thu|fri|sat)[a-z]*,?\s+)?"
#: Families of date texts: a pattern, and which of its groups are year, month and day; hour, minute, second, fraction, UTC and offset follow those three.
_DATE_FORMS = (
    # ISO 8601: a date alone is in UTC, and so is a time without an offset, as the service runs in UTC.
    (r"(?:(\d{4}|[+-]\d{6})(?:-(\d{2})(?:-(\d{2}))?)?)(?:[Tt ]%s)?\s*([Zz])?([+-]\d{2}:?\d{2})?" % _TIME, (1, 2, 3)),
    # Mail and HTTP: 5 Jan 2024 10:00:00 +0100.
    (rf"(?i){_WEEKDAY}(\d{{1,2}})[ -]{_NAME}[ -](\d{{4}})(?:\s+{_TIME})?{_ZONE}", (3, 2, 1)),
    # As a date prints: Fri Jan 05 2024 10:00:00 GMT+0100 (name).
    (rf"(?i){_WEEKDAY}{_NAME}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:\s+{_TIME})?{_ZONE}", (3, 1, 2)),
    # 2024/1/5 and 1/5/2024.
    (rf"(?i)(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?:\s+{_TIME})?{_ZONE}", (1, 2, 3)),
    (rf"(?i)(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:\s+{_TIME})?{_ZONE}", (3, 1, 2)),
)


def _epoch_millis(x: Column) -> Column:
    """Milliseconds of a struct ``y, m, d, h, mi, s, f, o`` of numbers; null unless all are in range. A day past a month's end goes on in the next."""
    year = x["y"] - F.when(x["m"] <= 2, 1).otherwise(0)
    era = F.floor(year / 400)
    of_era = year - era * 400
    day = F.floor((153 * (x["m"] + F.when(x["m"] > 2, -3).otherwise(9)) + 2) / 5) + x["d"] - 1
    days = era * 146097 + of_era * 365 + F.floor(of_era / 4) - F.floor(of_era / 100) + day - 719468
    ok = x["m"].between(1, 12) & x["d"].between(1, 31) & (x["mi"] <= 59) & (x["s"] <= 59) & ((x["h"] <= 23) | ((x["h"] == 24) & (x["mi"] + x["s"] + x["f"] == 0))) & (F.abs(x["o"]) < 24 * 60)
    millis = days * 86_400_000 + (x["h"] * 60 + x["mi"] - x["o"]) * 60_000 + x["s"] * 1000 + x["f"]
    return F.when(ok & F.abs(millis).between(0, 8_640_000_000_000_000), millis.cast("bigint"))


_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"


def iso_timestamp(text: Column) -> Column:
    """F14. A date text in any of ``_DATE_FORMS`` to a timestamp of milliseconds; null if it is none of them, or out of range.

    The usual form is left to the parser of timestamps; only other texts are matched with the forms, one by one.
    """
    number = lambda c, default: F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))

    def matched(t: Column) -> Column:
        out = None
        for pattern, (y, m, d) in _DATE_FORMS:
            whole = rf"^\s*(?:{pattern})\s*$"
            group = lambda i, whole=whole: F.regexp_extract(t, whole, i)
            month = F.ceil((F.instr(F.lit(_MONTHS), F.lower(group(m))) + 3) / 4).cast("bigint") if "jan" in pattern else number(group(m), 1)
            offset = F.replace(group(9), F.lit(":"))
            minutes = number(F.substring(offset, 2, 2), 0) * 60 + number(F.substring(offset, 4, 2), 0)
            parts = F.struct(
                number(group(y), 0).alias("y"), month.alias("m"), number(group(d), 1).alias("d"), number(group(4), 0).alias("h"), number(group(5), 0).alias("mi"), number(group(6), 0).alias("s"),
                number(F.substring(F.concat(group(7), F.lit("000")), 1, 3), 0).alias("f"), F.when(offset.startswith("-"), -minutes).otherwise(minutes).alias("o"),
            )
            one = F.when(t.rlike(whole), let(parts, _epoch_millis))
            out = one if out is None else F.coalesce(out, one)
        return out

    def read(t: Column) -> Column:
        plain = F.date_trunc("MILLISECOND", F.try_to_timestamp(F.when(t.rlike(_PLAIN), t)))
        return F.coalesce(plain, F.timestamp_millis(matched(t)))

    return let(text, read)


def may_hold(text: Column, key: str) -> Column:
    """The JSON text if a key of it can be this one, else null: most texts need not be parsed. An escape could spell it in another way."""
    return F.when(F.contains(text, F.lit(key)) | F.contains(text, F.lit("\\")), text)


def revision_text(payload: Column, observation_revision: Column, command_sequence: Column) -> Column:
    """F15. The revision as text, from a string or a safe integer."""
    parsed = F.try_parse_json(may_hold(payload, "providerRevision"))
    v = F.try_variant_get(parsed, "$.providerRevision", "variant")
    kind = variant_type(v)
    own = F.when((kind == "STRING") | kind.rlike("^(BIGINT|DECIMAL.*,0)"), F.try_variant_get(parsed, "$.providerRevision", "string"))
    rest = F.coalesce(observation_revision.cast("string"), command_sequence.cast("string"))
    return F.when(kind.isNotNull() & (kind != "VOID"), own).otherwise(rest)


def origin_ids(ids: Column) -> Column:
    """G4. Distinct ids in order; an empty array for null."""
    return F.array_sort(F.array_distinct(F.coalesce(ids, F.array().cast("array<string>"))))


def register_sql_functions(spark: SparkSession) -> None:
    """The expressions that fit one SQL expression, as temporary SQL functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION canonical_json(s STRING) RETURNS STRING RETURN to_json(try_parse_json(s))")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION uuid_v5(s STRING) RETURNS STRING RETURN regexp_replace(concat(substr(sha1(concat(unhex('{C.UUID_NAMESPACE}'), encode(s, 'UTF-8'))), 1, 12), '5', "
        f"substr(sha1(concat(unhex('{C.UUID_NAMESPACE}'), encode(s, 'UTF-8'))), 14, 3), substr('89ab', pmod(cast(conv(substr(sha1(concat(unhex('{C.UUID_NAMESPACE}'), encode(s, 'UTF-8'))), 17, 1), 16, 10) AS INT), 4) + 1, 1), "
        f"substr(sha1(concat(unhex('{C.UUID_NAMESPACE}'), encode(s, 'UTF-8'))), 18, 15)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
    )
