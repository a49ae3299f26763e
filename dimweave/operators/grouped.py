"""Sorted groups handed to numpy, many per Python call."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

GroupFn = Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]


def _starts(pdf: pd.DataFrame, by: list[str]) -> np.ndarray:
    """Positions at which a new group begins; NULL equals NULL."""
    changed = np.zeros(max(len(pdf) - 1, 0), dtype=bool)
    for c in by:
        value, missing = pdf[c].to_numpy(), pdf[c].isna().to_numpy()
        same = (value[1:] == value[:-1]) & ~missing[1:] & ~missing[:-1]
        changed |= ~(same | (missing[1:] & missing[:-1]))
    return np.concatenate([[0], np.flatnonzero(changed) + 1])


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[list[pd.DataFrame]]:
    """The pieces of each group, in the order of arrival."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        starts = _starts(pdf, by)
        ends = np.append(starts[1:], len(pdf))
        for start, end in zip(starts, ends, strict=True):
            piece = pdf.iloc[start:end]
            if held and start == 0:
                seam = pd.concat([held[-1].iloc[-1:], piece.iloc[:1]])
                if len(_starts(seam, by)) == 1:
                    held.append(piece)
                    continue
            if held:
                yield held
            held = [piece]
    if held:
        yield held


def map_groups(
    frame: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    function: GroupFn,
    fields: Sequence[T.StructField],
) -> DataFrame:
    """Apply `function` to the columns of each group, sorted by `order`.

    The result has the grouping columns and `fields`.  Groups share Arrow batches, which
    spares the cost that one call per group has when there are many small ones.
    """
    by, names = list(by), [f.name for f in fields]
    others = [c for c in frame.columns if c not in by]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for pieces in _groups(batches, by):
            columns = {c: np.concatenate([p[c].to_numpy() for p in pieces]) for c in others}
            result = function(columns)
            count = len(result[names[0]])
            if not count:
                continue
            first = pieces[0]
            part = {c: np.repeat(first[c].to_numpy()[:1], count) for c in by}
            parts.append(part | {n: result[n] for n in names})
            size += count
            if size >= 10_000:
                yield _stack(parts)
                parts, size = [], 0
        if parts:
            yield _stack(parts)

    def _stack(parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in [*by, *names]})

    schema = T.StructType([*[frame.schema[c] for c in by], *fields])
    parted = frame.repartition(*by) if by else frame.coalesce(1)
    arranged = parted.sortWithinPartitions(*by, *order)
    return arranged.mapInPandas(run, schema)
