"""User-defined aggregates with map-side partial states.

An ``Aggregator`` is user code in three vectorized steps: rows to states,
states to states, states to results. Each task turns its rows into one state
per key before anything moves, states of a key are merged as they stream by,
and each key is finished once. A key that holds most of the rows thus ships one
small row per task, like a built-in partial aggregate; a pandas UDAF would ship
all of its rows to one worker.

Memory is bounded: a task that meets more than ``HELD_STATES`` keys hands its
states on and starts afresh (a key may then ship several), and merging keeps
one batch of states and the key it is at.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
from pyspark.sql.types import StructField, StructType

from strata.config import find_package

HELD_STATES = 1 << 16


class Aggregator(ABC):
    """One aggregate over some input columns.

    ``groups`` numbers the group of every row (or state) from 0 to ``n - 1``;
    each step returns one array per entry of ``state``, ``n`` long.
    """
    columns: tuple[str, ...]
    state: tuple[pa.DataType, ...]
    result: pa.DataType

    @abstractmethod
    def partial(self, groups: np.ndarray, n: int, *values: pa.Array) -> Sequence[np.ndarray]:
        """States of ``n`` groups of rows."""

    @abstractmethod
    def merge(self, groups: np.ndarray, n: int, *states: np.ndarray) -> Sequence[np.ndarray]:
        """States of ``n`` groups of states."""

    @abstractmethod
    def finish(self, *states: np.ndarray) -> pa.Array:
        """The result of each state."""


class Mean(Aggregator):
    """Mean of the values that are not null, null without any."""
    state = (pa.float64(), pa.int64())
    result = pa.float64()

    def __init__(self, column: str):
        self.columns = (column,)

    def partial(self, groups, n, *values):
        kept = values[0].is_valid().to_numpy(zero_copy_only=False)
        return self.merge(groups, n, values[0].cast(pa.float64()).fill_null(0.0).to_numpy(), kept)

    def merge(self, groups, n, *states):
        total, count = states
        return (np.bincount(groups, total, n), np.bincount(groups, count, n).astype(np.int64))

    def finish(self, *states):
        total, count = states
        return pa.array(total / np.maximum(count, 1), mask=count == 0)


class Count(Aggregator):
    """Number of rows."""
    columns, state, result = (), (pa.int64(),), pa.int64()

    def partial(self, groups, n, *values):
        return (np.bincount(groups, minlength=n),)

    def merge(self, groups, n, *states):
        return (np.bincount(groups, states[0], n).astype(np.int64),)

    def finish(self, *states):
        return pa.array(states[0])


def group_rows(keys: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """``(group of every row, first row of every group)``; null keys are equal."""
    codes = np.zeros(len(keys[0]), np.int64)
    for key in keys:
        own = key.dictionary_encode(null_encoding="encode").indices.to_numpy()
        # codes stay below the number of rows, so this can't overflow
        _, codes = np.unique(codes * (int(own.max(initial=0)) + 1) + own, return_inverse=True)
    _, first, groups = np.unique(codes, return_index=True, return_inverse=True)
    return groups, first


def _states(aggs: Sequence[Aggregator], table: list[pa.Array], at: int) -> list[list[np.ndarray]]:
    """The state columns of each aggregate, from column ``at`` on."""
    out = []
    for a in aggs:
        out.append([c.to_numpy(zero_copy_only=False) for c in table[at:at + len(a.state)]])
        at += len(a.state)
    return out


def _merged(aggs: Sequence[Aggregator], n_keys: int, tables: list[list[pa.Array]]) -> list[pa.Array]:
    """States of equal keys merged, in the order in which their keys first stand."""
    table = [pa.concat_arrays(c) for c in zip(*tables)]
    groups, first = group_rows(table[:n_keys])
    order = np.argsort(first)
    groups, first = np.argsort(order)[groups], first[order]
    out = [k.take(pa.array(first)) for k in table[:n_keys]]
    for a, states in zip(aggs, _states(aggs, table, n_keys)):
        out += [pa.array(s, t) for s, t in zip(a.merge(groups, len(first), *states), a.state)]
    return out


def partial_states(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Aggregator]) -> DataFrame:
    """One row of states per key and task: ``k0.., s0..``."""
    keys, aggs = list(keys), list(aggs)
    if not keys:
        raise ValueError("no keys")
    inputs = list(dict.fromkeys(c for a in aggs for c in a.columns))
    find_package(rows.sparkSession)
    kinds = [t for a in aggs for t in a.state]
    schema = StructType([StructField(f"k{i}", rows.schema[k].dataType) for i, k in enumerate(keys)]
                        + [StructField(f"s{i}", from_arrow_type(t)) for i, t in enumerate(kinds)])
    names, held_states = schema.names, HELD_STATES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.Array]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, first = group_rows(batch.columns[:len(keys)])
            new = [c.take(pa.array(first)) for c in batch.columns[:len(keys)]]
            for a in aggs:
                values = [batch.column(len(keys) + inputs.index(c)) for c in a.columns]
                new += [pa.array(s, t) for s, t in zip(a.partial(groups, len(first), *values), a.state)]
            held.append(new)
            size += len(first)
            if size > held_states:
                held = [_merged(aggs, len(keys), held)]
                size = len(held[0][0])
                if size > held_states // 2:
                    yield pa.RecordBatch.from_arrays(held[0], names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(_merged(aggs, len(keys), held), names)

    # the keys first, so that a column may be key and input
    return rows.select(*[rows[k].alias(f"k{i}") for i, k in enumerate(keys)],
                       *[rows[c].alias(f"v{i}") for i, c in enumerate(inputs)]).mapInArrow(run, schema)


def finished(states: DataFrame, keys: Sequence[str], aggs: Mapping[str, Aggregator]) -> DataFrame:
    """States of ``partial_states`` merged by key, each key finished once."""
    n_keys, own = len(keys), list(aggs.values())
    by = [f"k{i}" for i in range(n_keys)]
    schema = StructType([StructField(k, states.schema[b].dataType) for k, b in zip(keys, by)]
                        + [StructField(n, from_arrow_type(a.result)) for n, a in aggs.items()])
    target = to_arrow_schema(schema)

    def done(table: list[pa.Array]) -> pa.RecordBatch:
        results = [a.finish(*s) for a, s in zip(own, _states(own, table, n_keys))]
        return pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip([*table[:n_keys], *results], target)], schema.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.Array] | None = None         # the key that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _merged(own, n_keys, [t for t in (last, batch.columns) if t])
            if len(table[0]) > 1:
                yield done([c.slice(0, len(c) - 1) for c in table])
            last = [c.slice(len(c) - 1) for c in table]
        if last:
            yield done(last)

    return states.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def aggregate(rows: DataFrame, keys: Sequence[str], aggs: Mapping[str, Aggregator]) -> DataFrame:
    """``(*keys, *aggs)``: user-defined aggregates of ``rows`` per key; no rows, no keys."""
    return finished(partial_states(rows, keys, list(aggs.values())), keys, aggs)
