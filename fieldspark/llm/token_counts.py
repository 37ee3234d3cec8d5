"""Exact token counts of whole texts by a SentencePiece model, without keeping ids.

No piece of the model has its space mark after another character, so no merge crosses the place where a space follows
another character: there a text can be split. Segments (a run of spaces and what follows up to the next space) are
encoded in batches of bounded bytes; a segment that came before is not encoded again. The model's dummy prefix stands
for the one space that a cut takes away.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import buffers, slices, span_hashes
from .memo import Memo

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
MARK = "▁"


def check_splittable(model) -> None:
    """Raises ValueError if a piece has the space mark after another character: then no boundary is safe."""
    for i in range(model.get_piece_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a space: texts can't be split for this model")


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of what is to be encoded of each segment, the replaced space left out."""
    blank = data == 0x20
    cut = np.zeros(len(data), bool)
    cut[1:] = blank[1:] & ~blank[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    cut[first] = True
    s = np.flatnonzero(cut)
    e = np.append(s[1:], len(data))
    own = np.zeros(len(data), bool)
    own[first] = True
    return np.searchsorted(offsets, s, side="right") - 1, np.where(own[s], s, s + 1), e


@lru_cache(1)
def _loaded(path: str) -> tuple[Memo, int]:
    """One per worker: (the memo of segment lengths, the tokens of a last single space)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    check_splittable(model)
    return Memo(lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], lengths_only=True), len(model.encode("a ")) - len(model.encode("a"))


def _count(path: str, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, alone = _loaded(path)
        for whole in batches:
            for b in slices(whole, size=batch_bytes):
                size = np.diff(buffers(b.column("text"))[1])
                data, off = buffers(pc.replace_substring(b.column("text"), MARK, " "))
                total = np.zeros(b.num_rows, np.int64)
                if len(data):
                    doc, s, e = segments(data, off)
                    full = s < e
                    n = np.full(len(s), alone, np.int64)
                    h, g = span_hashes(data, s[full], e[full], 0, len(data), second=True)
                    at = memo.find(data, h, g, s[full], e[full])
                    n[full] = memo.n[at]
                    total = np.bincount(doc, n, b.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(total)], schema=_SCHEMA)

    return run


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, batch_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of docs (doc_id long, text).

    n_tokens is what the model gives for the whole text, without begin and end tokens. A null or empty text has 0 bytes
    and 0 tokens. Null and repeated doc_ids and repeated rows are kept; other columns are ignored; an empty table gives
    an empty table. model_path must be readable on every executor. Nothing is shuffled.
    """
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_count(model_path, batch_bytes), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
