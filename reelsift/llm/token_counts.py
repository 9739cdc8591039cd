"""Token counts: lengths of encoded texts, nothing else.

Arrow functions get record batches, encode their texts in batches balanced by bytes
(:data:`pieces.BATCH`), cut long texts at safe places and return the lengths alone.
No shuffle; a task's memory is a record batch and the bounded piece cache.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import encoder


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens, over_limit) of each row.

    tokenizer: a vocabulary file of the tokenizers library.  Ids are counted as the library gives
    them without added special tokens, truncation or padding.  Null texts count as empty: 0 and 0.
    Every row gives a row, repeated ones too; null ids stay null.  Other columns are left out,
    so clashing names don't matter.  An empty table gives an empty one.
    """

    def count(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(ids) // 4 for ids in enc.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    given = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
    kind = given.schema["k"].dataType.simpleString()
    found = given.mapInArrow(count, f"k {kind}, n_bytes long, n_tokens long")
    return found.select(F.col("k").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
