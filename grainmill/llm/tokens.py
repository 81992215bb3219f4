"""Token counts of texts with a public tokenizer, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern published with the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_counts(df: DataFrame, keep: list[str], text: str, tokenizer: str = TOKENIZER, out: str = "n_tokens") -> DataFrame:
    """keep, n_tokens. Null texts give no row; an empty text has 0 tokens; whole texts are encoded."""
    rows = df.where(F.col(text).isNotNull()).select(*keep, F.col(text).alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(n, pa.int64())], names=[*keep, out])

    return rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + f", {out} long")
