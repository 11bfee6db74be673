"""What several operators need."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def learns(key: str, parts: int, held: int) -> Column:
    """True for rows that may be learned from: crc32 of the key's text, modulo ``parts``, is not ``held``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts != held


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each slice have about ``limit`` bytes, one text at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 16)
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def texts(column: pa.Array) -> pa.Array:
    """Texts with null read as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under new names, so that no other column can clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def annotate(
    df: DataFrame,
    text: str,
    added: Sequence[str],
    make: Callable[[pa.Array], Sequence[pa.Array]],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """All columns of ``df`` as c0, c1, ... and what ``make`` finds in the texts as a0, a1, ...

    Rows stay where they are and keep all they have, whatever their columns are called. ``added``
    are the types of the new columns.
    """
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))] + [f"a{i}" for i in range(len(added))]
    kinds = [f.dataType.simpleString() for f in df.schema.fields] + list(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, at, limit):
                yield pa.RecordBatch.from_arrays([*cut.columns, *make(texts(cut.column(at)))], names)

    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return df.toDF(*names[: len(df.columns)]).mapInArrow(run, schema)


def restored(annotated: DataFrame, like: DataFrame) -> DataFrame:
    """The original columns of an annotated DataFrame, under their own names."""
    return annotated.select(*(f"c{i}" for i in range(len(like.columns)))).toDF(*like.columns)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i]+1, ... of ``lengths[i]`` places each, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def joined_bytes(column: pa.Array) -> bytes:
    """All texts of a large_string array without nulls, one after the other."""
    if not len(column):
        return b""
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return column.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes() if ends[-1] > ends[0] else b""


def joined_text(column: pa.Array) -> str:
    return joined_bytes(column).decode()
