"""Stateful classification of a stream: the sequential fold, keyed by identity."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from telmark.operators.classify import FOLD_COLUMNS, fold, identity_or_own, with_identity

OUTPUT = T.StructType([
    T.StructField("provider_id", T.StringType()), T.StructField("arrival_seq", T.LongType()), T.StructField("outcome", T.StringType()),
    T.StructField("accepted_hash", T.StringType()), T.StructField("reason_codes", T.ArrayType(T.StringType())),
])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Fold(StatefulProcessor):
    """One map state per identity: each entry is read and written alone, so state size costs nothing per batch."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = T.StructType([T.StructField("kind", T.StringType()), T.StructField("key", T.StringType())])
        value = T.StructType([T.StructField("value", T.StringType())])
        self.state = handle.getMapState("seen", key, value, self.ttl_ms)

    def get(self, kind: str, key: str) -> str | None:
        return self.state.getValue((kind, key))[0] if self.state.containsKey((kind, key)) else None

    def put(self, kind: str, key: str, value: str) -> None:
        self.state.updateValue((kind, key), (value,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        pdf = pd.concat(list(rows))
        pdf = pdf.astype(object).where(pdf.notna(), None).sort_values("arrival_seq")
        out = [(r["provider_id"], int(r["arrival_seq"]), *fold(self, r)) for r in pdf.to_dict("records")]
        yield pd.DataFrame(out, columns=OUTPUT.names)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that this operator needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stateful_classify(stream: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """T4. ``(provider_id, arrival_seq, outcome, accepted_hash, reason_codes)`` of a stream of valid records.

    Records of one identity are folded in arrival order within and across micro-batches; a record without one stands
    alone under its record id. A record id that comes under two identities is judged apart in each. State is
    unbounded unless ``ttl_ms`` is set, which may miss repeats older than that.
    """
    rows = with_identity(stream).select(*FOLD_COLUMNS, identity_or_own().alias("who"))
    return rows.groupBy("who").transformWithStateInPandas(statefulProcessor=_Fold(ttl_ms), outputStructType=OUTPUT, outputMode="append", timeMode="none" if ttl_ms is None else "processingTime")
