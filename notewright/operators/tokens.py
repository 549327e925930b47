"""Texts cut at the tokens of a tokenizer file."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def cut_tokens(rows: DataFrame, text: str, tokenizer: str, max_tokens: int, into: str = "cut") -> DataFrame:
    """Adds ``into``, the beginning of ``text`` that its first ``max_tokens`` tokens cover, n_tokens and kept_tokens.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor can open.  Tokens are those of the text alone, no
    special ones added.  A token that ends inside a character is cut with the character.  Null texts stay null.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be positive")

    def run(batches):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        model.no_truncation()
        model.no_padding()
        for b in batches:
            cut, total, kept = [], [], []
            for t in b.column(text).to_pylist():
                if t is None:
                    cut, total, kept = [*cut, None], [*total, None], [*kept, None]
                    continue
                found = model.encode(t, add_special_tokens=False)
                n = len(found.ids)
                cut.append(t if n <= max_tokens else t[: found.offsets[max_tokens - 1][1]])
                total.append(n)
                kept.append(min(n, max_tokens))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cut, pa.string()), pa.array(total, pa.int64()), pa.array(kept, pa.int64())], [*b.schema.names, into, "n_tokens", "kept_tokens"])

    added = [T.StructField(into, T.StringType()), T.StructField("n_tokens", T.LongType()), T.StructField("kept_tokens", T.LongType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))
