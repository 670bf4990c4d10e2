"""Token counts of texts with a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary splits text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict[str, object] = {}
PIECE = 20_000  # longer texts are encoded in pieces cut at white space


def encoder(path: str = VOCABULARY):
    """The encoder of a rank file, loaded once a process."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of a text, 0 for null and empty."""
    if not text:
        return 0
    return len(encoder(path).encode_ordinary(text))


def with_tokens(docs: DataFrame, text: str = "text", out: str = "tokens", path: str = VOCABULARY) -> DataFrame:
    """All columns but the text, plus its token count; whole texts, null counts 0."""
    carry = [c for c in docs.columns if c not in (text, out)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) + f", `{out}` int"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            o = b[carry].copy()
            o[out] = pd.Series([len(enc.encode_ordinary(t)) if isinstance(t, str) and t else 0 for t in b[text]], index=b.index, dtype="int32")
            yield o

    return spread(docs.select(*carry, F.col(text))).mapInPandas(scan, schema)
