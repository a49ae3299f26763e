"""A keyed store on a parquet table, standing in for a live one."""

from __future__ import annotations

import asyncio
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow.dataset as ds
from pyspark.sql import DataFrame

from dimweave.session import fresh_folder

FILE_ROWS = 250_000
HELD = 2


def laid_out(table: DataFrame, key: str) -> str:
    """The folder of a copy of the table in the order of its key, in files of FILE_ROWS rows."""
    path = fresh_folder(table.sparkSession, "store")
    arranged = table.repartitionByRange(key).sortWithinPartitions(key)
    arranged.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return path


class ParquetStore:
    """Key=value text by key; reads the row groups that can hold the wanted keys only.

    The last HELD row groups stay at hand, so requests in the order of keys read each once."""

    def __init__(self, path: str, key: str, prefix: str, fields: Sequence[str]) -> None:
        self._key, self._prefix, self._fields = key, prefix, list(fields)
        files = ds.dataset(path).get_fragments()
        self._pieces = [piece for file in files for piece in file.split_by_row_group()]
        whole = {"min": np.iinfo(np.int64).min, "max": np.iinfo(np.int64).max}
        self._spans = [(p.row_groups[0].statistics or {}).get(key, whole) for p in self._pieces]
        self._rows = lru_cache(maxsize=HELD)(self._read)

    def _read(self, piece: int) -> tuple:
        rows = self._pieces[piece].to_table(
            columns=[self._key, *self._fields], filter=ds.field(self._key).is_valid(), use_threads=False
        ).sort_by(self._key)
        return rows[self._key].to_numpy(), rows

    def get_many(self, keys: Sequence[str]) -> dict[str, str]:
        start = len(self._prefix)
        numbers = np.unique([int(k[start:]) for k in keys if k[start:].isdigit()])
        found = {}
        for piece, span in enumerate(self._spans):
            wanted = numbers[(numbers >= span["min"]) & (numbers <= span["max"])]
            if not len(wanted):
                continue
            own, rows = self._rows(piece)
            at = np.searchsorted(own, wanted)
            at, wanted = at[at < len(own)], wanted[at < len(own)]
            for row in rows.take(at[own[at] == wanted]).to_pylist():
                text = "|".join(f"{f}={row[f]}" for f in self._fields)
                found[f"{self._prefix}{row[self._key]}"] = text
        return found


class AsyncParquetStore(ParquetStore):
    """The same with requests that can overlap."""

    async def get_many(self, keys: Sequence[str]) -> dict[str, str]:
        return await asyncio.to_thread(super().get_many, keys)
