"""Reports that arrive one by one, put together by record: a state for each record until both modes are there or time is up."""

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = "at timestamp, path string, content string"
JOINED = "record string, genome_path string, genome string, protein_path string, protein string, complete boolean"
MODES = ("genome", "protein")


class Pairing(StatefulProcessor):
    """Keeps a record's report of each mode, the latest by its time (of one time the greatest path), and gives both when they are there.

    If a mode is still missing ``wait`` milliseconds of event time after a record's first report, what there is goes out
    as incomplete. Either way the record is done, and what comes later for it is left out until ``forget`` milliseconds
    have gone by, after which its state goes too.
    """

    def __init__(self, wait: int, forget: int):
        self.wait, self.forget = wait, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = {mode: handle.getValueState(mode, STATE) for mode in MODES}
        self.done = handle.getValueState("done", "at long")

    def _row(self, record):
        import pandas as pd

        got = {mode: s.get() if s.exists() else (None, None, None) for mode, s in self.kept.items()}
        values = [record, *[v for mode in MODES for v in got[mode][1:]]]
        whole = all(got[mode][0] is not None for mode in MODES)
        return pd.DataFrame([[*values, whole]], columns=[f.split()[0] for f in JOINED.split(", ")])

    def _close(self, now: int) -> None:
        for state in self.kept.values():
            state.clear()
        self.done.update((now,))
        self.handle.registerTimer(now + self.forget)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        now = timerValues.getCurrentWatermarkInMs()
        if self.done.exists():
            return
        new = not any(s.exists() for s in self.kept.values())
        first = None
        for batch in rows:
            for mode, at, path, content in zip(batch["mode"], batch["at"], batch["path"], batch["content"]):
                if mode not in self.kept:
                    continue
                state = self.kept[mode]
                if not state.exists() or (state.get()[0], state.get()[1]) < (at, path):
                    state.update((at, path, content))
                first = at if first is None else min(first, at)
        if all(s.exists() for s in self.kept.values()):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            yield self._row(key[0])
            self._close(max(now, int(first.timestamp() * 1000)) if first is not None else now)
        elif new and first is not None:
            self.handle.registerTimer(max(now, int(first.timestamp() * 1000)) + self.wait)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        if self.done.exists():
            self.done.clear()
            return
        yield self._row(key[0])
        self._close(timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def paired(reports: DataFrame, late: str = "10 minutes", wait: int = 3_600_000, forget: int = 86_400_000) -> DataFrame:
    """JOINED of a stream of reports (record, mode, at, path, content): a row for each record, see Pairing.

    Spark's state store for many keys has to be RocksDB (spark.sql.streaming.stateStore.providerClass). Reports older than
    the watermark, ``late`` behind the newest one, still join what is waiting.
    """
    rows = reports.select(F.col("record").cast("string").alias("record"), "mode", "at", "path", "content").where("record IS NOT NULL").withWatermark("at", late)
    return rows.groupBy("record").transformWithStateInPandas(Pairing(wait, forget), JOINED, "Append", "EventTime")
