"""Byte-level BPE: texts to token ids with character offsets, and ids back to texts.

The rank file lists tokens as byte strings. The ``tokenizers`` library works on
characters, so every byte gets a visible character of its own: printable bytes
stand for themselves, the others move above U+0100. A token's name is its bytes
in these characters. The merges follow from the ranks: any two tokens that join
to a third merge, at the rank of the third. A match of the split pattern that is
a token as a whole is that token.

Texts are encoded by Arrow batch, in portions of bounded size. A text longer
than a portion is cut before a single space between two other characters: the
pattern always starts a match there, so the ids are those of the whole text.

An offset is the span of characters a token comes from. It follows from the
lengths of the tokens before it: these give the token's place in the bytes of the
text, and a running count of the bytes that begin a character gives the place
in characters. A token that holds only
part of a character's bytes gets the whole character, so neighbours may share
one: ``n_split`` counts the tokens that begin within a character.

Decoding looks the bytes of each id up through the reversed byte table and joins
them before it reads UTF-8, so characters split over tokens come back whole. A
list of ids that itself begins or ends within a character keeps its exact bytes;
its text has U+FFFD there.

Defined cases: a null or empty text has no ids and decodes to the empty text;
null ids decode to null. Texts are taken whole whatever their length. Rows are
independent, so equal and null document ids, repeated rows and ties need no
rule. Only the named columns are read; an empty table gives an empty result. An
id outside the vocabulary fails the job.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import importable

# Characters encoded at a time: an encoding holds some 100 bytes a token.
PORTION = 1 << 18

ENCODED = "doc_id bigint, ids binary, starts array<int>, ends array<int>, n_split bigint"

_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from lines of base64 text and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens that joins to a token, in the order of the joined token's rank."""
    pairs = []
    for token in sorted(ranks, key=ranks.__getitem__):
        halves = ((token[:i], token[i:]) for i in range(1, len(token)))
        known = [(a, b) for a, b in halves if a in ranks and b in ranks]
        pairs += sorted(known, key=lambda ab: (ranks[ab[0]], ranks[ab[1]]))
    return pairs


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, characters = read_ranks(path), byte_characters()

    def name(token: bytes) -> str:
        return "".join(characters[b] for b in token)

    vocabulary = {name(token): rank for token, rank in ranks.items()}
    merges = [(name(a), name(b)) for a, b in merges_of(ranks)]
    out = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "removed", invert=True),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return out


@lru_cache(maxsize=4)
def token_bytes(path: str, pattern: str) -> pa.Array:
    """The bytes of every id, its name read back through the reversed byte table."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    names = {i: name for name, i in tokenizer(path, pattern).get_vocab().items()}
    table = [None] * (max(names) + 1)
    for i, name in names.items():
        table[i] = bytes(byte_of[c] for c in name)
    return pa.array(table, pa.large_binary())


def pieces(text: str, portion: int) -> Iterator[str]:
    """A text cut to pieces of about ``portion`` characters where the pattern cuts it anyway."""
    start = 0
    while len(text) - start > portion:
        cut = _CUT.search(text, start + portion)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def character_spans(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in characters of tokens of so many bytes that lie one behind the other in UTF-8 ``data``."""
    begins = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
    ends = np.cumsum(lengths)
    # A token starts in the character of its first byte and ends behind that of its last.
    return begins[ends - lengths] - 1, begins[ends - 1]


def _encoded(tok, lengths_of: np.ndarray, doc_ids: pa.Array, texts: list[str], portion: int) -> pa.RecordBatch:
    """One batch of results for texts that are encoded together."""
    parts = [(k, piece) for k, text in enumerate(texts) for piece in pieces(text, portion)]
    of = [k for k, _ in parts]
    encodings = tok.encode_batch_fast([piece for _, piece in parts], add_special_tokens=False)
    found = [e.ids for e in encodings]
    sizes = np.array([len(i) for i in found], np.int64)
    total = int(sizes.sum())
    ids = np.fromiter(chain.from_iterable(found), np.uint32, total)
    starts, ends = character_spans(np.frombuffer("".join(texts).encode(), np.uint8), lengths_of[ids])
    counts = np.bincount(of, sizes, len(texts)).astype(np.int64) if of else np.zeros(len(texts), np.int64)
    at = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(texts)), counts)
    shift = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int32)[row]
    starts, ends = starts - shift, ends - shift
    within = np.zeros(total, bool)
    within[1:] = (starts[1:] < ends[:-1]) & (row[1:] == row[:-1])
    n_split = np.bincount(row[within], minlength=len(texts)).astype(np.int64)
    offsets = pa.array(at, pa.int32())
    packed = ids.astype("<u4").tobytes()
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array([packed[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(starts)),
            pa.ListArray.from_arrays(offsets, pa.array(ends)),
            pa.array(n_split),
        ],
        ["doc_id", "ids", "starts", "ends", "n_split"],
    )


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    portion: int = PORTION,
) -> DataFrame:
    """``doc_id``, ``ids`` and the character span of every token, for each row.

    ``ids`` are packed as little-endian unsigned 32-bit numbers, as training
    files hold them; ``id_array`` unpacks them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        # Spark runs one task per core; the library must not start threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = tokenizer(ranks_path, pattern)
        lengths_of = pc.binary_length(token_bytes(ranks_path, pattern)).to_numpy(zero_copy_only=False)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            first, held, size = 0, [], 0
            for k in range(len(texts)):
                held.append(texts[k].as_py() or "")
                size += len(held[-1])
                if size >= portion:
                    yield _encoded(tok, lengths_of, doc_ids.slice(first, len(held)), held, portion)
                    first, held, size = k + 1, [], 0
            if held:
                yield _encoded(tok, lengths_of, doc_ids.slice(first, len(held)), held, portion)

    importable(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` plus ``bytes`` (exact) and ``text`` (UTF-8, U+FFFD for broken parts) of its ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path, pattern)
        for batch in batches:
            # Token bytes lie one behind the other in the taken array's own buffer.
            column = batch.column(batch.num_columns - 1)
            out = []
            for value in column:
                packed = value.as_py()
                if packed is None:
                    out.append(None)
                    continue
                taken = table.take(pa.array(np.frombuffer(packed, "<u4").astype(np.int64)))
                at = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
                data = taken.buffers()[2]
                out.append(data[int(at[0]) : int(at[-1])].to_pybytes() if len(taken) and data is not None else b"")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.binary())], [*batch.schema.names[:-1], "bytes"]
            )

    importable(encoded.sparkSession)
    kept = encoded.columns
    rows = encoded.select(*(F.col(f"`{c}`") for c in kept), F.col(ids).alias("__ids"))
    schema = encoded.select(*(F.col(f"`{c}`") for c in kept), F.lit(None).cast("binary").alias("bytes")).schema
    out = rows.mapInArrow(run, schema)
    return out.withColumn("text", F.make_valid_utf8(F.col("bytes").cast("string")))


def id_array(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``encoded`` with the packed ids as ARRAY<INT>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(ids)
            lists = [None if v is None else np.frombuffer(v, "<u4").astype(np.int32) for v in batch.column(k).to_pylist()]
            yield batch.set_column(k, ids, pa.array(lists, pa.list_(pa.int32())))

    importable(encoded.sparkSession)
    names = encoded.columns
    schema = encoded.select(
        *(F.lit(None).cast("array<int>").alias(c) if c == ids else F.col(f"`{c}`") for c in names)
    ).schema
    return encoded.mapInArrow(run, schema)
