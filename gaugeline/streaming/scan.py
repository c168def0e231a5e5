"""The exact scan on a stream: each micro-batch is a run that continues the devices' states."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import DynamicConfig
from ..operators.scan import RESULT, DeviceState, scan_rows

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DeviceProcessor(StatefulProcessor):
    """Keeps a device's state between micro-batches; its rows of one batch are ordered as in a batch run."""

    def __init__(self, fields: list[str], config: DynamicConfig):
        self.fields, self.config = fields, config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("device", "state string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        self.kept.update((initialState["state"].iloc[0],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        pdf = pd.concat(list(rows), ignore_index=True)
        state = DeviceState.load(self.kept.get()[0] if self.kept.exists() else None)
        out = scan_rows(key[0], pdf, self.fields, self.config, state)
        self.kept.update((out["state"].iloc[-1],))
        yield out.assign(state=None)

    def close(self) -> None:
        pass


def scan_stream(records: DataFrame, fields: list[str], config: DynamicConfig, states: DataFrame | None = None) -> DataFrame:
    """Findings of a stream of records as ``scan_devices`` takes them; ``spark.sql.streaming.stateStore.providerClass`` must be PROVIDER.

    ``states`` (device_id, state) are those that batch runs left; a new stream begins with them (one that goes on from its
    checkpoint has its own). ``stream_states`` gives the states for a batch run afterwards. A device's ledger holds the capacity for itself while
    the stream runs. Rows later than the state are judged as in a later run: no step or rate, and values join
    the baseline in the order of arrival.
    """
    needed = ["device_id", "seq", "record_id", "family", "ts_us", "quality_state", "fingerprint", *fields]
    initial = None if states is None else states.select("device_id", "state").groupBy("device_id")
    return records.select(*needed).groupBy("device_id").transformWithStateInPandas(DeviceProcessor(fields, config), RESULT, "Append", "None", initialState=initial)


def stream_states(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(device_id, state) of a stream that ``scan_stream`` made, read from its checkpoint: after the last micro-batch, or after ``batch``."""
    rows = spark.read.format("statestore").option("stateVarName", "device")
    rows = rows if batch is None else rows.option("batchId", batch)
    return rows.load(checkpoint).select(F.col("key.device_id").alias("device_id"), F.col("value.state").alias("state"))
