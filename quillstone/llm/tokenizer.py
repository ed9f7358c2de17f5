"""Encoding with a public byte-level BPE vocabulary through a sentencepiece model built from it.

The model is serialised here, not trained: every vocabulary entry becomes a
piece at the index of its rank, its bytes mapped one to one to printable
characters, its score the negative rank, normalisation the identity. A
pre-token is encoded by sentencepiece (which merges the adjacent pair of the
best score first, ties to the left, as byte-level BPE does) and decoded by the
inverse byte mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the pre-token pattern of the byte_bpe vocabularies.
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Most pre-tokens whose ids a worker remembers; beyond it the memory is emptied, never the result.
REMEMBERED = 400_000


def _byte_chars() -> list[str]:
    """For each byte a printable character: itself where printable in Latin-1, else the next one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


BYTE_CHARS = _byte_chars()
_TO_CHARS = {b: c for b, c in enumerate(BYTE_CHARS)}
_TO_BYTES = {ord(c): b for b, c in enumerate(BYTE_CHARS)}


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a ``.tiktoken`` file in the order of their ranks."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks of ``tokens``."""
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(BYTE_CHARS[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class Encoder:
    """Encodes and decodes texts; holds one sentencepiece processor and the ids of pre-tokens met so far."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._split = regex.compile(PRE_TOKEN).findall
        self._known: dict[str, list[int]] = {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, without special tokens; ``[]`` for null and empty texts."""
        words = [self._split(t) if t else [] for t in texts]
        if len(self._known) > REMEMBERED:
            self._known.clear()
        if new := list({w for ws in words for w in ws if w not in self._known}):
            mapped = [w.encode().decode("latin-1").translate(_TO_CHARS) for w in new]
            self._known.update(zip(new, self._sp.encode(mapped, out_type=int), strict=True))
        known, out = self._known, []
        for ws in words:
            ids: list[int] = []
            for w in ws:
                ids += known[w]
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        pieces = "".join(self._sp.id_to_piece(list(ids))) if len(ids) else ""
        return bytes(_TO_BYTES[ord(c)] for c in pieces).decode()


@lru_cache(maxsize=4)
def encoder(model: bytes) -> Encoder:
    """One encoder per worker process and model."""
    return Encoder(model)


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken", id_name: str = "doc_id") -> DataFrame:
    """One row ``(id_name, ids)`` per row of ``df``.

    Null and empty texts get the empty list; repeated rows are each encoded;
    an empty table gives no rows; other columns are not read. Embarrassingly
    parallel: no shuffle. The model is broadcast, its size being that of the
    vocabulary file (about 1 MB).
    """
    model = df.sparkSession.sparkContext.broadcast(sentencepiece_model(read_ranks(vocabulary)))
    src = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = src.schema["k"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = enc.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_name, "ids"])

    return src.mapInArrow(run, f"`{id_name}` {kind.simpleString()}, ids array<int>")
