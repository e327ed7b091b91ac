"""Byte-level BPE: texts to ids by the tiktoken library and a local rank file, ids back to bytes.

The library matches its pattern over a whole text, which is slow to hold for very long ones and
fails on a run of about a million spaces. So texts of more than ``CHUNK`` characters are split first
at safe boundaries, places no match crosses and that no match looks past:

* before white space that follows something else: only the first character of a match is a space
  that more may follow;
* after a letter, a kana or an ideograph that punctuation or a digit follows: what follows letters in a match is letters;
* a long run of white space is one match without its last character, which goes to what follows
  (with it, if the text ends there), and is encoded as one piece.

The classes below hold characters whose kind never changed between Unicode versions, so that they
mean the same to this module and to the library. Decoding joins the bytes of the ids: a token may end
inside a character, so no text is made of single tokens.
"""

from __future__ import annotations

import re
from base64 import b64decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 1 << 16
GROUP = 1 << 22

# The characters of Unicode's White_Space, letters, and digits and punctuation.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NEAR_SPACE = r"\x1c-\x1f\u180e\u200b-\u200f\u2060\ufeff"
_LETTER = r"A-Za-z\u0410-\u044f\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_OTHER = r"0-9!-/:-@\[-`{-~\u3001\u3002"
SAFE = re.compile(
    f"(?<=[^{_SPACE}{_NEAR_SPACE}])(?=[ \\n\\t])|(?<=[{_LETTER}])(?=[{_OTHER}])"
)
SPACES = re.compile(f"(?<![{_SPACE}])[{_SPACE}]{{{CHUNK},}}")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """Parts of ``text`` of about ``chunk`` characters between safe boundaries; a part may be longer
    where there is none."""
    at = 0
    while len(text) - at > chunk and (cut := SAFE.search(text, at + chunk)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def ids_of(text: str, path: str, pattern: str, chunk: int = CHUNK) -> np.ndarray:
    own = encoding(path, pattern)
    if len(text) <= chunk:
        return own.encode_to_numpy(text)
    found, at = [], 0
    for run in SPACES.finditer(text):
        end = run.end() - (run.end() < len(text))
        found += [own.encode_to_numpy(part) for part in split(text[at : run.start()], chunk)]
        found.append(np.array(own._encode_single_piece(text[run.start() : end]), dtype=np.uint32))
        at = end
    found += [own.encode_to_numpy(part) for part in split(text[at:], chunk)]
    return np.concatenate(found)


def _listed(rows: list[np.ndarray | None]) -> pa.ListArray:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.uint32), *[r for r in rows if r is not None]])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, text: str, path: str, pattern: str, ids: str = "ids", group: int = GROUP
) -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of the column ``text``.

    ``path`` names the rank file on every node. One row per row, repeated ones too; NULL and empty
    texts have no ids. Bytes that are not UTF-8 count as U+FFFD, as the library has it. Marks of special
    tokens are plain text. A text may be of any length; an empty table gives an empty table. Rows are
    handed back by about ``group`` ids.
    """
    kept = [c for c in docs.columns if c not in (text, ids)]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("binary").alias(ids))
    schema = out.drop(ids).select("*", F.array(F.lit(0)).alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full(batch, start, rows):
            others = batch.slice(start, len(rows)).columns[:-1]
            return pa.RecordBatch.from_arrays([*others, _listed(rows)], names=[*kept, ids])

        for batch in batches:
            start, size, rows = 0, 0, []
            for raw in batch.column(len(kept)):
                found = ids_of((raw.as_py() or b"").decode("utf-8", "replace"), path, pattern)
                rows.append(found)
                size += len(found)
                if size >= group:
                    yield full(batch, start, rows)
                    start, size, rows = start + len(rows), 0, []
            yield full(batch, start, rows)

    return out.mapInArrow(run, schema)


def decode(
    rows: DataFrame, path: str, pattern: str, ids: str = "ids", raw: str = "bytes", group: int = 4 * GROUP
) -> DataFrame:
    """``rows`` with the bytes that their ids stand for in the column ``raw``. NULL ids give NULL, none an
    empty value; an id that the rank file lacks raises."""
    kept = [c for c in rows.columns if c != raw]
    out = rows.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*out.schema.fields, T.StructField(raw, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(path, pattern)
        for batch in batches:
            lists = batch.column(kept.index(ids))
            start, size, found = 0, 0, []
            for i, one in enumerate(lists):
                found.append(own.decode_bytes(one.values.to_pylist()) if one.is_valid else None)
                size += len(found[-1] or b"")
                if size >= group or i == len(lists) - 1:
                    part = batch.slice(start, len(found))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(found, pa.binary())], names=[*kept, raw]
                    )
                    start, size, found = start + len(found), 0, []

    return out.mapInArrow(run, schema)
