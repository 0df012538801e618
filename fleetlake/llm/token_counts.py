"""Exact token counts of whole texts with a given public tokenizer.

A text is cut at safe boundaries: before a run of white space that follows
something else.  The tokenizers' own pre-splitting never joins text across such
a place, so the counts of the pieces add up to the count of the whole, long
texts never need one large encoding, and equal pieces are encoded once per
task.  Pieces a task has not met yet go to the library in batches of about
``batch_bytes``; only their lengths are kept, in a table of at most
``cache_pieces`` entries that starts anew when full.

A null text counts as empty: zero bytes, zero tokens.  Every input row gives
one row, repeated rows too.  Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches

# The characters that the tokenizers' pattern counts as white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+"


def load_json(path: str):
    """Lengths of a batch under a ``tokenizers`` file: no added specials, no truncation, no padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def batches_by_bytes(pieces: list[str], limit: int) -> Iterator[list[str]]:
    """``pieces`` in lists of about ``limit`` characters, so that no call is much longer than another."""
    batch, size = [], 0
    for p in pieces:
        if batch and size + len(p) > limit:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += len(p)
    if batch:
        yield batch


class PieceTable:
    """What ``encode`` makes of each piece of a text; pieces of up to ``LONG`` characters are remembered."""

    LONG = 64

    def __init__(self, encode, batch_bytes: int, cache_pieces: int):
        self.encode, self.batch_bytes, self.cache_pieces = encode, batch_bytes, cache_pieces
        self.split, self.known = re.compile(PIECE).findall, {}

    def values(self, text: str) -> list:
        pieces, known, once = self.split(text), self.known, {}
        new = [p for p in set(pieces) if p not in known]
        if len(known) + len(new) > self.cache_pieces:
            known = self.known = {}
            new = list(set(pieces))
        for batch in batches_by_bytes(new, self.batch_bytes):
            for p, v in zip(batch, self.encode(batch), strict=True):
                (known if len(p) <= self.LONG else once)[p] = v
        if once:
            return [once[p] if p in once else known[p] for p in pieces]
        return list(map(known.__getitem__, pieces))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, batch_bytes: int = 1 << 20,
                 cache_pieces: int = 600_000) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_bytes, n_tokens, over_limit)``."""

    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table = PieceTable(load_json(tokenizer_path), batch_bytes, cache_pieces)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([sum(table.values(t)) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .transform(in_batches, run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
