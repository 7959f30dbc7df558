"""BPE encoding and decoding of whole texts by forced-boundary splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import forced_boundary_bpe
from .common import slices, text_or_empty


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_tokens, ids (binary, little-endian unsigned 32-bit integers), decoded (text of the ids).

    A null text counts as empty and gives no ids; ids and texts may repeat or be null, every row gives its own. Texts of any length are
    encoded whole. An empty table gives an empty result. Only the two named columns are read. No row moves between tasks.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_tokens long, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = forced_boundary_bpe(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                ids = [coder.encode(t) for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([np.array(x, "<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([coder.decode(x) for x in ids], pa.string()),
                    ],
                    names=["id", "n_tokens", "ids", "decoded"],
                )

    plain = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)
