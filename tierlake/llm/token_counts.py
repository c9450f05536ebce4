"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.pretokens import word_table
from tierlake.llm.runtime import prepare, text_or_empty, utf8

SCHEMA = "key {}, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row, as the library counts whole texts.

    A pre-token that is itself a vocabulary string which encodes alone as one token counts one by
    look-up. Only the others are merged, each distinct one once per batch, and remembered. A text
    with a special string is encoded by the library as a whole. Null and empty texts have zero
    bytes and tokens. Rows are neither joined nor grouped: null and repeated keys, ties and other
    columns do not matter, an empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def count(batches):
        table = word_table(tokenizer)
        for batch in batches:
            n_tokens = table.counts(batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(np.diff(utf8(batch["text"])[1])), pa.array(n_tokens),
                 pa.array(n_tokens > limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[key].alias("key"), text_or_empty(text).alias("text"))
    counted = rows.mapInArrow(count, SCHEMA.format(rows.schema["key"].dataType.simpleString()))
    return counted.withColumnRenamed("key", key)
