"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch are held as one ragged numpy array; each round merges the
lowest-ranked pair of every sequence at once, and the symbols that survive are
counted. Distinct pre-tokens are merged once per task and remembered by their bytes, up to
``REMEMBERED`` of them (then the memory starts anew) and none of over ``LONGEST`` bytes, so
memory does not grow with the corpus. Texts and pre-tokens of any length are counted whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import arrays, bpe, frames

REMEMBERED, LONGEST = 500_000, 256
_known: dict[str, dict[bytes, int]] = {}


def _count(path: str):
    vocab = bpe.vocabulary(path)

    def of(text: pa.Array) -> pa.Array:
        n_bytes, n_tokens = [], []
        for _, data, offsets in arrays.slices(*arrays.text_bytes(text)):
            begins, special, first = bpe.pre_tokens(vocab, data, offsets)
            ends = np.append(begins[1:], len(data))
            words, where, number = bpe.distinct_ranges(data, begins, ends)
            known = _known.setdefault(path, {})
            sizes = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))
            new = np.flatnonzero(sizes == 0)
            if len(new):
                at, length = begins[where[new]], (ends - begins)[where[new]]
                sizes[new] = bpe.merge(vocab, arrays.ragged_take(data, at, length), length)[1]
                if len(known) > REMEMBERED:
                    known.clear()
                known.update((words[i], n) for i, n in zip(new.tolist(), sizes[new].tolist()) if len(words[i]) <= LONGEST)
            each = np.where(special >= 0, 1, sizes[number])
            total = np.concatenate([[0], np.cumsum(each)])
            n_tokens.append(np.diff(total[first]))
            n_bytes.append(np.diff(offsets))
        pack = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        return pa.StructArray.from_arrays([pack(n_bytes), pack(n_tokens)], names=["n_bytes", "n_tokens"])

    return of


def token_counts(text: Column, vocabulary: str) -> Column:
    """struct(n_bytes, n_tokens) of a text; null and empty texts have none.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library, readable
    on every executor. Special strings inside texts count as their one token.
    """
    return F.arrow_udf(lambda column: _count(vocabulary)(column), "n_bytes bigint, n_tokens bigint")(text)


def with_token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``docs`` (all rows and columns; same-named ones give way) with n_bytes, n_tokens, over_limit."""
    rest = frames.without(docs, ("n_bytes", "n_tokens", "over_limit", "_counts"))
    counted = rest.withColumn("_counts", token_counts(F.col("text"), vocabulary))
    return counted.select(*(counted[c] for c in rest.columns), "_counts.*").withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_bytes", "n_tokens", "over_limit")
