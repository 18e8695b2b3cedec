"""Byte-level BPE with the tiktoken library and a local rank file: whole texts to ids and ids back to raw bytes."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import small_batches, text_column

# Characters that one call of the library gets at most where a safe boundary allows it.
CHUNK = 1 << 16
# Between a letter and a non-letter after it, or a number and a non-number, a pre-token always ends: no alternative of the
# pattern goes on from one to the other, and none looks behind itself.
SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})")
# White space has no such boundary. A run of it is one pre-token but for its last character, which stays with what follows;
# at the end of the text all of it is one. Pre-tokens of this length are encoded without the pattern, which cannot take them.
SPACES = regex.compile(r"\p{White_Space}{%d,}" % CHUNK)


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 token, rank), without special tokens. A task loads it once."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = CHUNK):
    """Cut a long text at safe boundaries: pieces are encoded one by one as the whole would be. A run without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None or cut.start() >= len(text):
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(codec: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a whole text as little-endian 32-bit numbers."""
    ids, at = [], 0
    for run in SPACES.finditer(text) if len(text) >= CHUNK else ():
        end = run.end() - (run.end() < len(text))
        ids += [codec.encode_to_numpy(piece) for piece in pieces(text[at:run.start()])]
        ids.append(np.array(codec._encode_single_piece(text[run.start():end]), dtype=np.uint32))
        at = end
    return np.concatenate([*ids, *[codec.encode_to_numpy(piece) for piece in pieces(text[at:])]]).astype("<u4")


def encode_texts(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add ``ids`` (little-endian unsigned 32-bit numbers as bytes) to the columns ``doc_id`` and ``keep`` for the whole ``text`` (null: empty).

    The rank file must lie at ``path`` on every executor (it comes with the Python environment). The pattern is one of those
    whose pre-tokens mix neither letters nor numbers with anything after them and take white space as described at ``SPACES``.
    Repeated rows are rows of their own, an empty table gives none, and further columns travel along when ``keep`` names them.
    """
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))

    def run(batches):
        codec = encoding(path, pattern)
        for batch in batches:
            ids = pa.array([encode(codec, str(text)).tobytes() for text in text_column(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in ("doc_id", *keep)], ids], ["doc_id", *keep, "ids"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in ("doc_id", *keep)) + ", ids binary")


def decode_ids(encoded: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """Replace ``ids`` by the raw bytes that they stand for (``decoded``, never re-read as text).

    With ``digests``: n_tokens, ids_sha256 and decoded_sha256 in place of the bytes.
    """
    others = [c for c in encoded.columns if c != "ids"]
    kinds = dict(encoded.dtypes)
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "decoded binary"

    def run(batches):
        codec = encoding(path, pattern)
        for batch in batches:
            ids = [x.as_buffer() if x.is_valid else b"" for x in batch.column("ids")]
            texts = [codec.decode_bytes(np.frombuffer(x, dtype="<u4").tolist()) for x in ids]
            out = [pa.array(texts, pa.binary())]
            if digests:
                sha = lambda values: pa.array([hashlib.sha256(x).hexdigest() for x in values])
                out = [pa.array([len(x) // 4 for x in ids], pa.int64()), sha(ids), sha(texts)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in others], *out], [*others, *[x.split()[0] for x in added.split(", ")]])

    return encoded.mapInArrow(run, "".join(f"`{k}` {kinds[k]}, " for k in others) + added)
