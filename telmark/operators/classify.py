"""Classification of arriving records: new, duplicate or conflict, and the quality of provider event order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmark.functions import scalars as S
from telmark.sources.store import discard, stored

REVISION, TERMINAL, SEQUENCE = "SMPP_PROVIDER_REVISION_CONFLICT", "SMPP_PROVIDER_TERMINAL_CONFLICT", "SMPP_PROVIDER_EVENT_SEQUENCE_CONFLICT"
OUT_OF_ORDER, GAP = "SMPP_PROVIDER_EVENT_OUT_OF_ORDER", "SMPP_PROVIDER_EVENT_SEQUENCE_GAP"
SEPARATOR = "\u001f"
ALONE = "\u001e"


def provider_identity() -> Column:
    """W3. Provider, instance, type and first local id, joined; null if one is missing."""
    local = F.coalesce("task_id", "external_command_id", F.get_json_object(S.may_hold(F.col("payload_json"), "externalCommandId"), "$.externalCommandId"), "resource_id", "external_execution_id", "provider_event_id")
    ok = F.col("provider_id").isNotNull() & F.col("instance_id").isNotNull() & F.col("record_type").isNotNull() & (F.length(local) > 0)
    return F.when(ok, F.concat_ws(SEPARATOR, "provider_id", "instance_id", "record_type", local))


def provider_terminal() -> Column:
    explicit = F.get_json_object(S.may_hold(F.col("payload_json"), "terminalStatus"), "$.terminalStatus")
    implied = F.when(F.get_json_object(S.may_hold(F.col("attributes_json"), "terminal"), "$.terminal") == "true", F.get_json_object(S.may_hold(F.col("payload_json"), "currentState"), "$.currentState"))
    return F.coalesce(F.when(F.length(explicit) > 0, explicit), implied)


def with_identity(records: DataFrame) -> DataFrame:
    """Adds ``identity``, ``revision`` and ``terminal`` from the envelope columns."""
    return records.withColumns({"identity": provider_identity(), "revision": S.revision_text(F.col("payload_json"), F.col("observation_revision"), F.col("command_sequence")), "terminal": provider_terminal()})


def identity_or_own() -> Column:
    """The identity; a record without one stands alone under its record id, so that no null key gathers them."""
    return F.coalesce(F.col("identity"), F.concat(F.lit(ALONE), F.col("record_id")))


def classify_records(records: DataFrame, accepted: DataFrame | None = None, order: str = "arrival_seq") -> DataFrame:
    """W2. Adds ``status`` (new, duplicate, conflict) and ``accepted_hash`` by source system and record id in arrival order.

    J2: ``accepted`` holds records accepted before (source_system, record_id, record_hash); they come first. Of
    several hashes that it holds for an id the least counts.
    """
    keys = ["source_system", "record_id"]
    first = F.first("record_hash").over(Window.partitionBy(*keys).orderBy(order))
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    out = records.withColumns({"_first": first, "_rn": rn})
    if accepted is not None:
        prior = accepted.groupBy(*keys).agg(F.min("record_hash").alias("_prior"))
        out = out.join(prior, keys, "left")
    else:
        out = out.withColumn("_prior", F.lit(None).cast("string"))
    known = F.coalesce("_prior", F.when(F.col("_rn") > 1, F.col("_first")))
    status = F.when(known.isNull(), "new").when(known == F.col("record_hash"), "duplicate").otherwise("conflict")
    return out.withColumns({"status": status, "accepted_hash": known}).drop("_first", "_rn", "_prior")


def sequence_quality(records: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """W7. Adds ``sequence_reason``: out of order or gap against the largest sequence before, per identity."""
    before = Window.partitionBy("_who").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    marked = records.withColumn("_who", identity_or_own()).withColumn("_top", F.max("provider_event_sequence").over(before))
    return marked.withColumn("sequence_reason", _order_reason(F.col("identity").isNotNull())).drop("_who", "_top")


def _order_reason(applies: Column) -> Column:
    seq, top = F.col("provider_event_sequence"), F.col("_top")
    return F.when(applies & (seq < top), OUT_OF_ORDER).when(applies & (seq > top + 1), GAP)


SEEDS = {"_h_record": "string", "_h_revision": "string", "_h_terminal": "string", "_h_sequence": "string", "_h_top": "bigint"}


def _judged(rows: DataFrame, record_key: list[str], order: str) -> DataFrame:
    """W2 and W4 to W6 for every row against what was accepted earlier (``SEEDS``) and the rows before it for which ``_accepted`` holds.

    Adds the known hash of the record id, the blocking code, the largest sequence before, and ``_next``: whether the row would be accepted.
    """
    def before(*keys: str) -> Window:
        return Window.partitionBy(*keys).orderBy(order, "_row").rowsBetween(Window.unboundedPreceding, -1)

    def evidence(c: str) -> Column:
        return F.when(F.col("_accepted"), F.col(c))

    def clash(c: str, seed: str, *keys: str) -> Column:
        w, other = before(*keys), lambda x: F.coalesce(x != F.col(c), F.lit(False))
        return other(F.min(evidence(c)).over(w)) | other(F.max(evidence(c)).over(w)) | other(F.col(seed))

    has = F.col("identity").isNotNull()
    # One exchange by identity serves its three windows.
    out = rows.withColumn("_who", identity_or_own()).repartition("_who")
    out = out.withColumn("_revision", has & F.col("revision").isNotNull() & clash("record_hash", "_h_revision", "_who", "revision"))
    top = F.greatest("_h_top", F.max(evidence("provider_event_sequence")).over(before("_who")))
    out = out.withColumns({"_terminal": has & clash("terminal", "_h_terminal", "_who"), "_top": top})
    out = out.withColumn("_sequence", has & F.col("provider_event_sequence").isNotNull() & clash("record_hash", "_h_sequence", "_who", "provider_event_sequence"))
    out = out.withColumn("_known", F.coalesce("_h_record", F.first(evidence("record_hash"), ignorenulls=True).over(before(*record_key))))
    code = F.when(F.col("_revision"), REVISION).when(F.col("_terminal"), TERMINAL).when(F.col("_sequence"), SEQUENCE)
    out = out.withColumn("_code", F.when(F.col("_known").isNull(), code))
    return out.withColumn("_next", F.col("_known").isNull() & F.col("_code").isNull())


#: Envelope columns that verdicts depend on, besides the order and what ``with_identity`` adds.
JUDGED = ["source_system", "record_id", "record_hash", "provider_event_sequence"]


def assess(records: DataFrame, valid: Column | None = None, order: str = "arrival_seq", seeds: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """W2 and W8 together, exactly as if records were judged one by one in arrival order; a blocked record leaves no trace.

    Adds ``outcome`` (duplicate, conflict, semantic_conflict, not_applicable, accepted_with_quality_issue, accepted;
    null where ``valid`` does not hold), ``accepted_hash``, ``blocking_code``, ``quality_status`` and ``reason_codes``. What a
    record is depends on which ones before it were accepted, so windows are worked to a fixpoint: the more are taken
    for accepted, the fewer are accepted next. Every second round therefore bounds the accepted ones from above and every
    other from below, and where two rounds agree they are exact. Two rounds are enough unless blocked records are
    the only evidence against others; each further one settles a step of such a chain.

    Records are written once and read back; rows that are not valid take no part in any exchange. Only columns that a caller
    reads meet the verdicts, by row. ``seeds`` adds what earlier batches accepted (``SEEDS``) to the valid rows, see ``history``.
    The tables that the result is read from are its ``stored_parts``.
    """
    record_key = [c for c in ("source_system", "record_id") if c in records.columns]
    ok = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    base = stored(records.withColumns({"_row": F.monotonically_increasing_id(), "_valid": ok}), "records")
    used = list(dict.fromkeys(["_row", order, *record_key, "record_hash", "identity", "revision", "terminal", "provider_event_sequence"]))
    rows = base.filter("_valid").select(used)
    if seeds is not None:
        rows = seeds(rows)
    rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in SEEDS.items() if c not in rows.columns})
    if seeds is not None:
        rows = stored(rows, "seeded")
    used += SEEDS
    taken, verdict = rows.withColumn("_accepted", F.lit(True)), None
    while True:
        once = _judged(taken, record_key, order).select(*used, F.col("_next").alias("_accepted"))
        last, verdict = verdict, stored(_judged(once, record_key, order).select("_row", "_accepted", "_next", "_known", "_code", "_top"), "verdicts")
        if last is not None:
            discard(last)
        if verdict.filter("_accepted <> _next").isEmpty():
            break
        taken = rows.join(verdict.select("_row", F.col("_next").alias("_accepted")), "_row")
    if seeds is not None:
        discard(rows)
    out = base.filter("_valid").join(verdict.drop("_accepted"), "_row")
    reason = F.when(F.col("_next"), _order_reason(F.col("identity").isNotNull()))
    out = out.withColumns({"accepted_hash": F.col("_known"), "blocking_code": F.col("_code"), "_reason": reason})
    quality = F.when(F.col("identity").isNull(), "not_applicable").when(F.col("_code").isNotNull(), "conflict").when(F.col("_reason").isNotNull(), "accepted_with_quality_issue").otherwise("accepted")
    out = out.withColumns({"quality_status": F.when(F.col("_known").isNull(), quality), "reason_codes": F.array_compact(F.array(F.coalesce("_code", "_reason")))})
    outcome = F.when(F.col("_known") == F.col("record_hash"), "duplicate").when(F.col("_known").isNotNull(), "conflict").when(F.col("_code").isNotNull(), "semantic_conflict").otherwise(F.col("quality_status"))
    out = out.withColumn("outcome", outcome).drop("_row", "_valid", "_next", "_known", "_code", "_top", "_reason")
    none = F.lit(None).cast("string")
    rest = base.filter("NOT _valid").drop("_row", "_valid").withColumns({"accepted_hash": none, "blocking_code": none, "quality_status": none, "reason_codes": F.array().cast("array<string>"), "outcome": none})
    out = out.unionByName(rest)
    out.stored_parts = [base, verdict]
    return out


class DictStore:
    """What ``fold`` remembers, in dictionaries. A streaming store has the same two methods."""

    def __init__(self) -> None:
        self.values: dict[tuple[str, str], str] = {}

    def get(self, kind: str, key: str) -> str | None:
        return self.values.get((kind, key))

    def put(self, kind: str, key: str, value: str) -> None:
        self.values[kind, key] = value


def fold(store: DictStore, row: dict) -> tuple[str, str | None, list[str]]:
    """One record against the accepted ones in the store, in arrival order; a blocked record leaves no trace.

    Returns the outcome, the accepted hash of a repeated record id, and reason codes.
    """
    h, identity = row["record_hash"], row["identity"]
    known = store.get("record", row["record_id"])
    if known is not None:
        return ("duplicate" if known == h else "conflict"), known, []
    if identity is None:
        store.put("record", row["record_id"], h)
        return "not_applicable", None, []
    rev, term, seq = row["revision"], row["terminal"], row["provider_event_sequence"]
    seq = None if seq is None or seq != seq else int(seq)
    rev_key, seq_key = f"{identity}{SEPARATOR}{rev}", f"{identity}{SEPARATOR}{seq}"
    if rev is not None and (store.get("revision", rev_key) or h) != h:
        return "semantic_conflict", None, [REVISION]
    if term is not None and (store.get("terminal", identity) or term) != term:
        return "semantic_conflict", None, [TERMINAL]
    reasons, top = [], store.get("top", identity)
    if seq is not None:
        if (store.get("sequence", seq_key) or h) != h:
            return "semantic_conflict", None, [SEQUENCE]
        if top is not None:
            reasons = [OUT_OF_ORDER] if seq < int(top) else [GAP] if seq > int(top) + 1 else []
    if rev is not None:
        store.put("revision", rev_key, h)
    if term is not None:
        store.put("terminal", identity, term)
    if seq is not None:
        store.put("sequence", seq_key, h)
        store.put("top", identity, str(seq if top is None else max(seq, int(top))))
    store.put("record", row["record_id"], h)
    return ("accepted_with_quality_issue" if reasons else "accepted"), None, reasons


FOLD_COLUMNS = ["arrival_seq", "provider_id", "record_id", "record_hash", "identity", "revision", "terminal", "provider_event_sequence"]
FOLD_SCHEMA = "arrival_seq long, outcome string, accepted_hash string, reason_codes array<string>"


def assess_sequential(records: DataFrame) -> DataFrame:
    """W2 and W8 as one fold per identity, rows streamed in arrival order; the batch form of the streaming fold.

    A record id that comes under two identities is judged apart in each; ``assess`` has no such limit, and keeps no state.
    """
    schema = pa.schema([("arrival_seq", pa.int64()), ("outcome", pa.string()), ("accepted_hash", pa.string()), ("reason_codes", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, own = DictStore(), None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["who"] != own:
                    store, own = DictStore(), r["who"]
                out.append(dict(zip(schema.names, (r["arrival_seq"], *fold(store, r)), strict=True)))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    rows = records.select(*FOLD_COLUMNS, identity_or_own().alias("who")).repartition("who").sortWithinPartitions("who", "arrival_seq")
    return records.join(rows.mapInArrow(run, FOLD_SCHEMA), "arrival_seq")
