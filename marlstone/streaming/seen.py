"""Which rows of a stream are the first of their key, as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Fixed value: the store that ``transformWithState`` needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_in_rocks(spark) -> None:
    """Streams that this session starts from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class _First(StatefulProcessor):
    """State of a key: that it was seen.  Of a batch's rows the smallest is the first.  Rows
    come as they are: a frame for each key would cost more than all the rest."""

    def __init__(self, order: list[str], columns: list[str]):
        self.order, self.made = order, Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        if self.seen.exists():
            for row in rows:
                yield self.made(*row, False)
            return
        best = None
        for row in rows:  # one at a time: a key may have any number of rows
            place = tuple((row[k] is None, row[k]) for k in self.order)
            if best is None or place < best[0]:
                row, best = None if best is None else best[1], (place, row)
            if row is not None:
                yield self.made(*row, False)
        if best is not None:
            self.seen.update((True,))
            yield self.made(*best[1], True)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802
        self.seen.update((True,))

    def close(self) -> None:
        pass


def with_first(stream: DataFrame, key: str, order: list[str], known: DataFrame | None = None, flag: str = "new") -> DataFrame:
    """ST6: the rows of a stream with ``flag``: whether a row is the first of its key that the
    stream has seen (of one batch the smallest by ``order``).  Keys of ``known`` count as seen
    when the stream begins.  State is a row for each key, dealt by key to the tasks, so a batch
    costs what it has and not what came before; it is kept for good, as ``seen`` must be."""
    state_in_rocks(stream.sparkSession)
    out = T.StructType([*stream.schema.fields, T.StructField(flag, T.BooleanType())])
    start = stream.sparkSession.createDataFrame([], T.StructType([stream.schema[key]])) if known is None else known.select(key)
    return stream.groupBy(key).transformWithState(_First(order, out.names), out, "append", "None", initialState=start.groupBy(key))
