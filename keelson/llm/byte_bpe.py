"""Byte-level BPE encoding and decoding with tiktoken over a local rank file.

``path`` is a file on every node (the tokenizer package is installed there). Long texts are split
where a letter or digit is followed by a space and a letter or digit: the pattern always starts a new match at that
space, so the pieces encode separately to the same ids. A null text counts as empty.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 16  # characters after which a long text is split at the next safe boundary
# before a space between two plain ASCII words: the space opens a new " ?\p{L}+" or " ?\p{N}+" match
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _names(path: str, pattern: str) -> list[str]:
    return [str(i) for i in range(encoder(path, pattern).n_vocab)]


def pieces(text: str, size: int = PIECE):
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode(text: str | None, path: str, pattern: str, size: int = PIECE) -> list[int]:
    enc = encoder(path, pattern)
    return [i for p in pieces(text or "", size) for i in enc.encode_ordinary(p)]


def encode_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every whole text. Only the text travels through Python: null,
    repeated and large ids stay as they are; extra columns are ignored; an empty table gives an empty result."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(text: pd.Series) -> pd.DataFrame:
        enc, out = encoder(path, pattern), []
        names = _names(path, pattern)
        for t in text:
            ids = encode(t, path, pattern)
            out.append((len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                        hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run("text").alias("p")).select("doc_id", "p.n_tokens", "p.ids_sha256", "p.decoded_sha256")
