"""The exact scan of records in parallel, also within a device: segments from guessed states, run anew where a guess was wrong.

Where a device is long, records are dealt in their order (device, time) to ranges of about equal size. What a range holds of a device is a
segment. The first segment of a device begins with its kept state. Every other one begins with a guess: the state after
the last records of the range before it. All segments are folded at once, and each notes which cells of its state (a series'
baseline, a family's last time, an open event, ...) it touched.

Then the segments of a device are chained: a segment's results stand if its guess agrees with the state before it in all touched
cells; the others keep what the chain brings. Neighbouring segments with wrong guesses are folded anew from the chain's
state, as one chain, and the check is repeated until all stand. A chain that is run anew passes by segments that agree with its
state. Each round also takes segments behind the wrong ones, twice as many as the round before, so that the number of rounds grows
with the logarithm of the segments. By induction over the chain the results are those of one fold.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from ..config import DynamicConfig
from ..functions.scratch import materialize
from . import dedup
from .scan import BATCH, COLUMNS, RESULT, DeviceScan, DeviceState, as_record, fold

SEGMENT_ROWS, WARM_ROWS = 100_000, 1_000
NEEDED = ["device_id", "seq", "record_id", "family", "ts_us", "quality_state", "fingerprint", "duplicate"]
META = ", part int, start string, touched string, family string"
HELD = ("head", "begin", "was", "became", "cells")
#: In place of a chain's head: the segment stands, but its shifts are numbered from another version.
RENUMBERED = -1


def in_order(*first: str) -> list:
    return [*first, F.col("ts_us").isNull(), "ts_us", "family", "record_id", "seq"]


def placed(rows: DataFrame, parts: int) -> DataFrame:
    """Rows in ``parts`` ranges of (device, time), sorted, with the range's number and whether they are among its last WARM_ROWS. Equal times of a device lie in one range; undated records are spread."""
    key = ["device_id", F.col("ts_us").isNull(), "ts_us", F.when(F.col("ts_us").isNull(), F.xxhash64("seq"))]
    dealt = rows.repartitionByRange(parts, *key).sortWithinPartitions(*in_order("device_id"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), []

        def out(batch: pa.RecordBatch, tail: bool) -> pa.RecordBatch:
            more = [pa.array([part] * len(batch), pa.int32()), pa.array([tail] * len(batch), pa.bool_())]
            return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "tail"])

        for batch in batches:
            held.append(batch)
            while len(held) > 1 and sum(map(len, held[1:])) >= WARM_ROWS:
                yield out(held.pop(0), False)
        last = sum(map(len, held))
        for batch in held:
            before = max(0, min(len(batch), last - WARM_ROWS))
            last -= len(batch)
            yield from (out(b, t) for b, t in ((batch.slice(0, before), False), (batch.slice(before), True)) if len(b))

    schema = StructType([*dealt.schema.fields, StructField("part", IntegerType()), StructField("tail", BooleanType())])
    return materialize(dealt.mapInArrow(number, schema), "scan-rows")


def rows_of(pdfs: Iterable[pd.DataFrame]) -> Iterator:
    for pdf in pdfs:
        pdf = pdf.assign(ts_us=pdf["ts_us"].astype("Int64").astype(object).where(pdf["ts_us"].notna(), None))
        yield from pdf.itertuples(index=False)


def framed(rows: Iterable[list]) -> Iterator[pd.DataFrame]:
    ready, names = [], [*COLUMNS, "part", "start", "touched", "family"]
    for row in rows:
        ready.append(row)
        if len(ready) == BATCH:
            yield pd.DataFrame(ready, columns=names)
            ready = []
    yield pd.DataFrame(ready, columns=names)


def segment(device: str, part: int, records: Iterable[dict], config: DynamicConfig, start: DeviceState, guessed: bool) -> Iterator[list]:
    """Result rows of a segment; the last one has the end state, the start state if it was guessed, and the touched cells. Returns the end state."""
    given = start.dump(ledger=False)
    scan, last, families = DeviceScan(device, config, start), None, {}

    def noted() -> Iterator[dict]:
        for r in records:
            families[r["seq"]] = r["family"]
            yield r

    for row in fold(scan, noted()):
        if last is not None:
            yield [*last, part, None, None, families.pop(last[1])]
        last = row
    if last is not None:
        yield [*last[:-1], scan.state.dump(ledger=False), part, given if guessed else None, json.dumps(sorted(scan.touched)), families[last[1]]]
    return scan.state


def fold_parts(pdfs: Iterable[pd.DataFrame], fields: list[str], config: DynamicConfig) -> Iterator[pd.DataFrame]:
    """First round. Rows come by range and device: its kept state or the records before the range, then its own records."""

    def run() -> Iterator[list]:
        for (part, device), own in groupby(rows_of(pdfs), key=lambda r: (r.part, r.device_id)):
            state, guessed, records = DeviceState(), False, None
            for kind, some in groupby(own, key=lambda r: r.kind):
                if kind == 0:
                    state = DeviceState.load(next(some).kept)
                elif kind == 1:
                    warm = DeviceScan(device, config, DeviceState())
                    for _ in fold(warm, (as_record(r, fields) for r in some)):
                        pass
                    state, guessed = warm.state, True
                else:
                    records = (as_record(r, fields) for r in some)
                    yield from segment(device, part, records, config, state, guessed)

    return framed(run())


def loaded(text: str) -> list[tuple[str, str]]:
    return [tuple(c) for c in json.loads(text)]


def chained(metas: DataFrame, more: int) -> DataFrame:
    """Chain the segments of each device: a row for each segment that is to run anew (``head``: the first of its chain, with
    the state ``begin``; ``was``, ``became``, ``cells``: what it did last), one with ``head`` null and the last state for each device, and one
    with RENUMBERED and how many versions to add by series (``cells``) for segments whose shifts are numbered anew.
    ``more`` segments behind the wrong ones go with them."""

    def run(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, ready = ["device_id", "part", *HELD], []
        for device, own in groupby((r for pdf in pdfs for r in pdf.itertuples(index=False)), key=lambda r: r.device_id):
            state, head, left, part = None, None, 0, None
            for r in own:
                part, cells = r.part, loaded(r.touched)
                end = DeviceState.load(r.state)
                if state is None or r.start is None:
                    state = end
                    continue
                start = DeviceState.load(r.start)
                good = start.agrees(state, cells)
                begin = None
                if not good:
                    if head is None:
                        head, begin = r.part, state.dump(ledger=False)
                    left = more
                if head is not None and (not good or left > 0):
                    left -= good
                    ready.append([device, r.part, head, begin, r.start, r.state, r.touched])
                else:
                    head = None
                    more_shifts = {name: state.series[name].version - start.series[name].version if name in start.series else state.series[name].version - 1 for kind, name in cells if kind == "version" and name in state.series}
                    if any(more_shifts.values()):
                        ready.append([device, r.part, RENUMBERED, None, None, None, json.dumps(more_shifts)])
                state = state.after(start, end, cells)
            ready.append([device, part, None, state.dump(ledger=False), None, None, None])
            if len(ready) >= BATCH:
                yield pd.DataFrame(ready, columns=names)
                ready = []
        yield pd.DataFrame(ready, columns=names)

    schema = "device_id string, part int, head int, begin string, was string, became string, cells string"
    return metas.repartition("device_id").sortWithinPartitions("device_id", "part").mapInPandas(run, schema)


def fold_chains(pdfs: Iterable[pd.DataFrame], fields: list[str], config: DynamicConfig) -> Iterator[pd.DataFrame]:
    """A later round. Rows come by device, chain and range: what the segment did last, then its records."""

    def run() -> Iterator[list]:
        for _, chain in groupby(rows_of(pdfs), key=lambda r: (r.device_id, r.head)):
            state = None
            for (device, part), own in groupby(chain, key=lambda r: (r.device_id, r.part)):
                last = next(own)
                if last.begin is not None:
                    state = DeviceState.load(last.begin)
                start, cells = DeviceState.load(last.was), loaded(last.cells)
                if start.agrees(state, cells):  # what it did last stands
                    state = state.after(start, DeviceState.load(last.became), cells)
                    for _ in own:
                        pass
                    continue
                state = yield from segment(device, part, (as_record(r, fields) for r in own), config, DeviceState.load(state.dump()), True)

    return framed(run())


def ledger_of(states: DataFrame) -> DataFrame:
    """(fingerprint, device_id, place) of the ledgers in the states of devices."""
    entries = F.from_json(F.get_json_object("state", "$.ledger"), "array<array<string>>")
    e = states.select("device_id", F.posexplode(F.coalesce(entries, F.array())).alias("at", "e"))
    return e.select(F.col("e")[0].alias("fingerprint"), "device_id", F.col("e")[1].cast("long").alias("place"))


def scan_devices(df: DataFrame, fields: list[str], config: DynamicConfig, states: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Exact findings for records (device_id, seq, record_id, family, ts_us, quality_state, fingerprint, value columns[, extra]).

    The result is that of one fold over each device's records in the order of time (then family, id, seq), but a device with many records is
    folded in segments side by side. ``parts``: ranges of records; by default, where a device has more than SEGMENT_ROWS records, at
    least as many as cores and one for SEGMENT_ROWS records, else none: devices are dealt to tasks whole. ``ts_us`` may be null; records of one time of a device are one task's. ``states`` (device_id, state) are the
    states that an earlier run left, one for each device; ``next_states`` gives those after this one.

    Duplicates are told by one ledger for all devices, in the order of (device, time): at most ``deduplication_capacity`` fingerprints,
    the oldest go first. Its entries are kept in the states of their devices with their place.
    """
    spark = df.sparkSession
    eligible = (F.coalesce("quality_state", F.lit("")) != "invalid") & F.col("ts_us").isNotNull()
    if config.enabled_families:
        eligible = eligible & F.coalesce("family", F.lit("")).isin(*config.enabled_families)
    given = df.drop("duplicate").withColumn("_eligible", eligible)
    known, _, ledger = dedup.ledger_step(given, ledger_of(states) if states is not None else None, config.deduplication_capacity, ("device_id", "ts_us"), in_order("device_id"), "_eligible")
    # repeats within the run lie in one group, where the fold sees them
    duplicate = F.lit(False)
    if known is not None:
        given, duplicate = given.join(known.withColumn("_known", F.lit(True)), "fingerprint", "left"), F.coalesce("_known", F.lit(False))
    rows = given.withColumn("duplicate", duplicate).select(*NEEDED, *fields, *(["extra"] if "extra" in df.columns else []))
    if parts is None:
        n, largest = df.groupBy("device_id").count().agg(F.sum("count"), F.max("count")).first()
        parts = 0 if (largest or 0) <= SEGMENT_ROWS else max(-(-n // SEGMENT_ROWS), spark.sparkContext.defaultParallelism)
    none = F.lit(None).cast("string")
    if not parts:  # no device is long: one task for several
        told = rows.withColumns({"part": F.lit(0), "kind": F.lit(2), "kept": none})
    else:
        rows = placed(rows, parts)
        spans = rows.groupBy("device_id", "part").agg(F.count(F.lit(1)).alias("n"))
        spans = materialize(spans.withColumn("next", F.lead("part").over(Window.partitionBy("device_id").orderBy("part"))), "scan-spans")
        # the records before a range, of the device that goes on in it
        continued = spans.filter(F.col("next").isNotNull()).select("device_id", "part", "next")
        warm = rows.filter("tail").join(continued, ["device_id", "part"]).drop("part").withColumnRenamed("next", "part")
        told = rows.withColumns({"kind": F.lit(2), "kept": none}).unionByName(warm.withColumns({"kind": F.lit(1), "kept": none}))
    if states is not None:
        kept = states.select("device_id", F.col("state").alias("kept"), F.lit(0).alias("kind"))
        first = spans.groupBy("device_id").agg(F.min("part").alias("part")) if parts else rows.select("device_id", F.lit(0).alias("part")).distinct()
        told = told.unionByName(kept.join(first, "device_id"), allowMissingColumns=True)
    told = (told.repartition(parts, "part") if parts else told.repartition("device_id")).sortWithinPartitions(*in_order("part", "device_id", "kind"))
    results = materialize(told.mapInPandas(lambda pdfs: fold_parts(pdfs, fields, config), RESULT + META), "scan-results")
    if not parts:
        return with_states(results, None, ledger)

    more = 1
    while True:
        ends = results.filter(F.col("state").isNotNull()).select("device_id", "part", "start", "state", "touched")
        several = ends.filter(F.col("start").isNotNull()).select("device_id").distinct()
        chain = materialize(chained(ends.join(several, "device_id", "left_semi"), more), "scan-chains")
        wrong = chain.filter(F.col("head") >= 0)
        if not wrong.limit(1).count():
            break
        own = rows.join(wrong.select("device_id", "part", "head"), ["device_id", "part"]).withColumns({"kind": F.lit(1), **{c: none for c in HELD[1:]}})
        told = own.unionByName(wrong.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        told = told.repartition("device_id", "head").sortWithinPartitions(*in_order("device_id", "head", "part", "kind"))
        anew = materialize(told.mapInPandas(lambda pdfs: fold_chains(pdfs, fields, config), RESULT + META), "scan-results")
        results = results.join(anew.filter(F.col("state").isNotNull()).select("device_id", "part"), ["device_id", "part"], "left_anti").unionByName(anew)
        more *= 2
    results = renumbered(results, chain.filter(F.col("head") == RENUMBERED))
    return with_states(results, chain.filter(F.col("head").isNull()).select("device_id", F.col("begin").alias("whole")), ledger)


def renumbered(results: DataFrame, segments: DataFrame) -> DataFrame:
    """Add the versions of earlier segments to those that shifts of a baseline report."""
    added = segments.select("device_id", "part", F.from_json("cells", "map<string,double>").alias("_added"))

    def number(f: Column) -> Column:
        more = F.coalesce(F.col("_added")[F.concat_ws("|", "family", f["field"])], F.lit(0.0))
        return f.withField("threshold", F.when(f["rule_id"] == "adaptive.baseline_shift", f["threshold"] + more).otherwise(f["threshold"]))

    out = results.join(added, ["device_id", "part"], "left")
    return out.withColumn("findings", F.when(F.col("_added").isNotNull(), F.transform("findings", number)).otherwise(F.col("findings"))).select(*results.columns)


def with_states(results: DataFrame, whole: DataFrame | None, ledger: DataFrame) -> DataFrame:
    """One row for each record. The last row of each device gets the state of its whole chain, with the device's part of the ledger; of other segments the state is left out."""
    last = results.filter(F.col("state").isNotNull())
    if whole is not None:
        last = last.join(last.groupBy("device_id").agg(F.max("part").alias("top")), "device_id").join(whole, "device_id", "left")
        state = F.when(F.col("part") == F.col("top"), F.coalesce("whole", "state"))
    else:
        state = F.col("state")
    entries = F.transform(F.array_sort(F.collect_list(F.struct("place", "fingerprint"))), lambda e: F.array(e["fingerprint"], e["place"].cast("string")))
    last = last.withColumn("state", state).join(ledger.groupBy("device_id").agg(F.to_json(entries).alias("entries")), "device_id", "left")
    put = F.concat(F.substring("state", F.lit(1), F.length("state") - 1), F.lit(', "ledger": '), F.coalesce("entries", F.lit("[]")), F.lit("}"))
    return results.filter(F.col("state").isNull()).select(*COLUMNS).unionByName(last.withColumn("state", put).select(*COLUMNS))
