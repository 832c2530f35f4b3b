"""Byte-level BPE with the tiktoken library and a local rank file.

Texts and ids pass between Spark and Python in Arrow batches. Each worker reads the rank file once.
Long texts are encoded in pieces, cut where every match of the pattern ends, so that the ids are
those of the whole text. Long runs of white space go to the merges as the one match they are, past
the regular expression, whose stack they would overflow.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1 << 16
LONG_RUN = 1 << 12

#: Before a space or line feed that follows something else than white space. Of a match only the
#: start may be white space, or all of it, so a match ends here whatever comes before or after.
_BOUNDARY = regex.compile(r"(?<=[\p{L}\p{N}!-~])(?=[ \n])")
_RUN = regex.compile(rf"\p{{White_Space}}{{{LONG_RUN},}}+")
_ONE_MATCH = r"[\s\S]+"


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a file of base64 tokens and ranks, without special tokens."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Consecutive parts of a text, cut at the first boundary at or after ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str, rank_file: str, pattern: str) -> list[np.ndarray]:
    """Token ids of a text, in parts.

    Of a long run of white space all but the last character are one match, which the next match may
    take; at the end of the text the whole run is one.
    """
    known, merges = encoding(rank_file, pattern), encoding(rank_file, _ONE_MATCH)
    parts, start = [], 0
    for run in _RUN.finditer(text):
        stop = run.end() - (run.end() < len(text))
        parts += [known.encode_ordinary(piece) for piece in pieces(text[start : run.start()])]
        parts.append(merges.encode_ordinary(text[run.start() : stop]))
        start = stop
    parts += [known.encode_ordinary(piece) for piece in pieces(text[start:])]
    return [np.array(part, np.int32) for part in parts]


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Token ids of a text as an array of int; a null or empty text has none.

    The pattern has to be one whose matches have white space at their start only, or throughout.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values, ends = [], [0]
            for value in batch:
                parts = token_ids(value.as_py() or "", rank_file, pattern)
                values += parts
                ends.append(ends[-1] + sum(map(len, parts)))
            flat = np.concatenate(values) if values else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return ids(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes that an array of token ids stands for; none for a null or empty array."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = encoding(rank_file, pattern)
        for batch in batches:
            offsets, values = batch.offsets.to_numpy(), batch.values.to_numpy(zero_copy_only=False)
            spans = zip(offsets[:-1], offsets[1:], batch.is_valid().to_pylist())
            yield pa.array(
                [known.decode_bytes(values[a:b].tolist()) if there else b"" for a, b, there in spans],
                pa.binary(),
            )

    return raw(ids)
