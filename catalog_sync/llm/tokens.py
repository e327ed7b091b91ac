"""Token ids of whole texts, cut into pieces.

The tokenizers used drop white space and never join across it, so a text's ids are the ids of
its runs of bytes outside ``[\\x20\\x09-\\x0D]`` in order. Each Python worker keeps a bounded cache of
short runs over all of its tasks, as most words come again; between tasks it keeps the ``KEPT`` runs met
first, among which are the frequent ones, as an idle worker's memory is missed by what follows. Punctuation behind a word of letters begins
a token of its own for these tokenizers, so a new run of known word and punctuation needs no
encoding. New words are encoded together where the tokenizer marks the ends of words. Texts are split and
ids put together array-wise, a group of texts at a time.
"""

from __future__ import annotations

import json
import string
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED = 1_000_000
KEPT = 100_000
LONG = 64
GROUP = 1 << 23
TOGETHER = 128
PUNCTUATION = string.punctuation.encode()


def plain(word: bytes) -> bool:
    """Letters only, also once normalised: one token-to-be that nothing joins."""
    if word.isascii():
        return word.isalpha()
    text = word.decode()
    return text.isalpha() and normalize("NFC", text).lower().isalpha()


class Runs(dict):
    """Run of bytes to its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode
        suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = tokenizer.get_vocab().items() if suffix else ()
        self.ends = {i for token, i in vocabulary if token.endswith(suffix)}

    def __missing__(self, run: bytes) -> bytes:
        word = run.rstrip(PUNCTUATION)
        if len(word) < len(run) and plain(word):
            packed = self[word] + self[run[len(word):]]
        else:
            packed = array("I", self.encode(run.decode(), add_special_tokens=False).ids).tobytes()
        if len(run) <= LONG:
            self[run] = packed
        return packed

    def learn(self, runs: Iterable[bytes]) -> None:
        """Encode the unknown plain words among ``runs`` in one go: tokens that end a word part them."""
        bare = {run.rstrip(PUNCTUATION) for run in runs}
        words = [w for w in bare if len(w) <= LONG and w not in self and plain(w)]
        ids = array("I")
        for at in range(0, len(words), TOGETHER):  # long texts are slower to encode than short ones
            some = b" ".join(words[at : at + TOGETHER]).decode()
            ids.extend(self.encode(some, add_special_tokens=False).ids)
        last = [i for i, x in enumerate(ids, 1) if x in self.ends]
        if len(last) == len(words) and (not last or last[-1] == len(ids)):
            packed = ids.tobytes()
            for word, start, end in zip(words, [0, *last], last, strict=False):
                self[word] = packed[4 * start : 4 * end]

    def trim(self) -> None:
        """Forget all but the runs met first, and give the memory back."""
        if len(self) > KEPT:
            first = dict(islice(self.items(), KEPT))
            self.clear()
            self.update(first)
        pa.default_memory_pool().release_unused()

    def ids(self, texts: pa.Array | list[bytes]) -> Iterator[bytes]:
        """The ids of each text, in groups of about ``GROUP`` bytes; NULL counts as empty.

        A group is split and its distinct runs are numbered array-wise, so Python sees each of them once."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.binary())
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + GROUP, side="right")))
            yield from self._group(texts[at:to])
            at = to

    def _group(self, texts: pa.Array) -> Iterator[bytes]:
        # Marks of special tokens are recognised in their own case only.
        split = pc.ascii_split_whitespace(
            pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        )
        coded = split.flatten().dictionary_encode()
        runs = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self) > CACHED:
            self.trim()
        if self.ends:
            unknown = [run for run in runs if run not in self]
            if unknown:
                self.learn(unknown)
        packed = list(map(self.__getitem__, runs))
        every = np.frombuffer(b"".join(packed), dtype="<u4")
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        codes = np.asarray(coded.indices)
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = every[np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[np.asarray(split.offsets) - split.offsets[0].as_py()].tolist()
        for start, end in zip(bounds, bounds[1:], strict=False):
            yield ids[start:end].tobytes()


@lru_cache(maxsize=1)
def runs_of(path: str) -> Runs:
    return Runs(path)


def pieces(
    docs: DataFrame, key: str, text: str, path: str, size: int, end_id: int, with_ids: bool = False
) -> DataFrame:
    """key, piece (from 0), start, length, ids_crc32 and, if asked for, ids (binary, 4 bytes each).

    A document is the ids of its text, NULL counting as empty, then ``end_id``; only documents of
    more than ``size`` ids are cut, into pieces of ``size`` of which the last may be shorter.
    """
    width = 4 * size
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            owner, number, length, crc, ids = [], [], [], [], []
            for i, packed in enumerate(runs.ids(batch.column(1))):
                packed += end
                for n, at in enumerate(range(0, len(packed), width)):
                    part = packed[at : at + width]
                    owner.append(i)
                    number.append(n)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()),
                pa.array([n * size for n in number], pa.int64()), pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ] + [pa.array(ids, pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names=names)
        runs.trim()

    return docs.select(F.col(key).alias("key"), text).mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    )
