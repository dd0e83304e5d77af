"""Byte-level BPE: whole texts to token ids and ids back to bytes, by the tiktoken library.

The ranks come from a local file, read once per Python worker.  A long text is cut before it is
encoded, at *safe* places only: where white space follows other characters.  No match of the
split pattern runs over such a place (white space can only open a match, and the one look-ahead
asks about white space), so the ids of the parts, end to end, are the ids of the whole.  Parts
keep the memory of the encoder flat for texts of any length.  Decoding joins the raw bytes of the
ids; it never goes through text, so ids that end inside a character lose nothing.

Defined results: a NULL or empty text has no ids and decodes to no bytes.  Strings that look like
special tokens are ordinary text.  Repeated rows stay repeated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.store import map_arrow

#: characters after which the next safe place is looked for
PART = 1 << 16
SAFE = regex.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Cut a text at safe places, ``size`` characters or somewhat more apart."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def _encode_part(coder: tiktoken.Encoding, part: str) -> np.ndarray:
    try:
        return coder.encode_to_numpy(part, disallowed_special=())
    except ValueError:  # a run of white space deeper than the library's pattern stack
        matches = regex.finditer(coder._pat_str, part)
        ids = [i for match in matches for i in coder._encode_single_piece(match.group())]
        return np.array(ids, "<u4")


def encode_text(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    found = [_encode_part(coder, part) for part in parts(text)]
    return (found[0] if len(found) == 1 else np.concatenate(found)).astype("<u4", copy=False)


def _encode(ranks: str, pattern: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            counts, ids = [], []
            for text in batch["text"]:
                found = encode_text(coder, text.as_py() or "")
                counts.append(len(found))
                ids.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"])
    return rows


def _decode(ranks: str, pattern: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in batches:
            decoded = [coder.decode_bytes(np.frombuffer(ids.as_py() or b"", "<u4").tolist())
                       for ids in batch["ids"]]
            yield batch.append_column("decoded", pa.array(decoded, pa.binary()))
    return rows


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers) per row."""
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    return map_arrow(named, _encode(ranks, pattern), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Add ``decoded``, the raw bytes of ``ids``."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return map_arrow(rows, _decode(ranks, pattern),
                     "doc_id long, n_tokens long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Encode, decode what was encoded, and reduce both to digests."""
    return digest(decode(encode(docs, ranks, pattern), ranks, pattern))
