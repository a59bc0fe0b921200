"""Packing by power-of-two decomposition.

Each document's tokens are cut into pieces whose lengths are powers of two, the longest
first: 5,000 tokens become 2048 + 2048 + 512 + 256 + 128 + 8. Every piece is a sequence
of its own, so no sequence crosses documents and none needs padding; pieces of equal
length share a bucket, from which batches of one shape are drawn.

A vocabulary's special tokens are single ids wherever a text spells them out, if they are
given; without them their strings are ordinary text.

Defined results: a null or empty text is the closing token alone; repeated rows are packed
each; a null id stays null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

MAX_TOKENS = 2048
END_ID = 1
STRETCH = 20_000
LONG_SPACE = re.compile(rf"(?<!\s)\s{{{STRETCH}}}")  # tried once a stretch
PIECES = (
    "doc_id long, start long, length long, bucket int, ids binary, doc_tokens long"
)


@functools.cache
def encoding(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks; one per worker process."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special)
    )


@functools.cache
def tokenizer(vocabulary_path: str) -> tokenizers.Tokenizer:
    """The same vocabulary as its JSON file gives it; one per worker process."""
    return tokenizers.Tokenizer.from_file(vocabulary_path)


def special_tokens(vocabulary_path: str) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON file."""
    with open(vocabulary_path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} is not a plain string")
    return {token["content"]: token["id"] for token in added}


@functools.cache
def powers(n: int, longest: int) -> tuple[int, ...]:
    """The binary decomposition of n below ``longest``, longest first."""
    return tuple(1 << k for k in range(longest.bit_length() - 1, -1, -1) if n >> k & 1)


def decompose(n: int, longest: int) -> list[int]:
    return [longest] * (n // longest) + list(powers(n % longest, longest))


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = MAX_TOKENS,
    end_id: int = END_ID,
    special: dict[str, int] | None = None,
    vocabulary_path: str | None = None,
) -> DataFrame:
    """One row per piece: ids as little-endian unsigned 32-bit, bucket = log2(length);
    ``special`` are the tokens that a text can hold by their strings. ``vocabulary_path`` is
    the JSON file of the same vocabulary, for texts that the fast encoder's pattern cannot
    take: it recurses over white space, and long stretches of it end the process."""
    if longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    known = tuple(sorted((special or {}).items()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks_path, pattern, known)

        def encode(text: str) -> list[int]:
            if vocabulary_path and len(text) >= STRETCH and LONG_SPACE.search(text):
                return tokenizer(vocabulary_path).encode(text, add_special_tokens=False).ids
            if any(token in text for token, _ in known):
                return own.encode(text, allowed_special="all")
            return own.encode_ordinary(text)

        for batch in batches:
            texts = batch.column(1)
            _, offsets = shared.byte_view(texts)
            for first, last in shared.blocks(offsets, 4 << 20):
                keys, starts, lengths, totals, ids = [], [], [], [], []
                for row in range(first, last):
                    tokens = encode(texts[row].as_py() or "")
                    tokens.append(end_id)
                    ids.append(np.array(tokens, dtype="<u4"))
                    sizes = decompose(len(tokens), longest)
                    keys += [row] * len(sizes)
                    lengths += sizes
                    totals += [len(tokens)] * len(sizes)
                    starts.append(np.cumsum(sizes) - sizes)
                flat = np.concatenate(ids)
                lengths = np.array(lengths, np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(keys, pa.int64())),
                        pa.array(np.concatenate(starts), pa.int64()),
                        pa.array(lengths),
                        pa.array(np.log2(lengths).astype(np.int32)),
                        pa.Array.from_buffers(
                            pa.binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(flat)]
                        ),
                        pa.array(totals, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "bucket", "ids", "doc_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """Pieces as training sequences in buckets of equal length.

    Written once, one folder per length; a sequence's number follows from its place in the
    written files, so a lost executor recomputes the same numbers.
    """
    stored = shared.stage(pieces, "packed", "bucket")
    return stored.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long")
    )
