"""Small shared helpers of the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of one Arrow batch are handed to Python operators in slices of about this many text bytes.
SLICE_BYTES = 8 << 20

_CUT = re.compile(r" (?=\S)")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text as bytes): a null text is empty, rows without an id are left out.

    Other columns are dropped, but those of ``carry`` go along as _carry0, _carry1, ..
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
        *[F.col(c).alias(f"_carry{k}") for k, c in enumerate(carry)],
    ).filter(F.col("doc_id").isNotNull())


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded size, so that memory does not follow the longest texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        mean = max(1, batch.column(batch.schema.get_field_index(column)).nbytes // batch.num_rows)
        step = max(1, size // mean)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_texts(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]], column: str = "text") -> DataFrame:
    """Runs ``make()(batch)`` on bounded batches of a frame sized by their ``column``.

    ``make`` is called once per task, for caches and tables; the inner function
    returns a dict of columns (pyarrow arrays, numpy arrays or lists).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches, column):
            yield as_batch(work(batch))

    return df.mapInArrow(run, schema)


def as_batch(columns: dict) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def units(text: str) -> list[str]:
    """Cuts a text before every space that a non-space follows; all but the first piece lack that space.

    Tokenizers whose patterns attach one leading space to a word never join
    characters across such a cut, so pieces can be tokenized one by one.
    """
    return _CUT.split(text)
