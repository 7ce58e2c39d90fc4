"""The whole way from records to layers, as one set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark.operators import classify, mapping, normalize, project, validate
from telmark.sources.store import discard, stored


@dataclass
class Classified:
    """All records with their ``outcome``; each is in exactly one of the frames below, which are filters of one table."""

    records: DataFrame
    parts: list[DataFrame] = field(default_factory=list, repr=False)

    def discard(self) -> None:
        """Removes the tables that the records are read from, when nothing reads them any more."""
        for df in self.parts:
            discard(df)

    def _of(self, *outcomes: str) -> DataFrame:
        return self.records.filter(F.col("outcome").isin(*outcomes))

    @property
    def accepted(self) -> DataFrame:
        return self._of("accepted", "accepted_with_quality_issue", "not_applicable")

    @property
    def duplicates(self) -> DataFrame:
        return self._of("duplicate")

    @property
    def conflicts(self) -> DataFrame:
        return self._of("conflict", "semantic_conflict")

    @property
    def rejected(self) -> DataFrame:
        return self._of("rejected")

    def outcomes(self) -> DataFrame:
        """``(arrival_seq, outcome, error_code)`` of all records."""
        return self.records.select("arrival_seq", "outcome", F.coalesce("error_code", "blocking_code").alias("error_code"))


def classify_all(records: DataFrame, mappings: DataFrame) -> Classified:
    """Validate, map, classify and assess. Checked and mapped records are written once; only the columns that order depends on shuffle."""
    mapped = mapping.resolve_source_mapping(validate.validate_envelopes(records), mappings)
    mapped = mapped.withColumn("error_code", F.coalesce("error_code", F.when(F.col("mapping").isNull(), "SOURCE_UNMAPPED")))
    assessed = classify.assess(classify.with_identity(mapped), F.col("error_code").isNull())
    return Classified(assessed.withColumn("outcome", F.coalesce("outcome", F.lit("rejected"))), assessed.stored_parts)


def facts_of(accepted: DataFrame, delay: str = "1 second") -> DataFrame:
    """Facts of accepted records, normalized at a fixed delay after receipt, so that runs are repeatable."""
    return normalize.normalize(accepted, F.col("received_at") + F.expr(f"INTERVAL {delay}"))


def projected_at(delay: str = "1 second") -> Column:
    return F.col("received_at") + F.expr(f"INTERVAL {delay}")


def layers(records: DataFrame, mappings: DataFrame) -> dict[str, DataFrame]:
    """All tables of the standalone warehouse, by ``layer.table``. Facts are written once."""
    c = classify_all(records, mappings)
    facts = stored(facts_of(c.accepted), "facts")
    core = project.core_rows(facts, projected_at("2 seconds"))
    return {
        "landing.provider_ops": project.landing_rows(c.accepted, projected_at()),
        "landing.conflict": project.conflict_rows(c.conflicts),
        "landing.rejected": project.rejected_rows(c.rejected, validate.safe_source_hint(c.rejected)),
        "normalized.facts": facts,
        "normalized.canonical_fact": project.canonical_rows(facts),
        "normalized.entity_ref": normalize.entity_ref_rows(facts),
        "core.provider_operation_fact": core,
        "core.entity_relation_fact": project.project_core_relations(facts),
    }
