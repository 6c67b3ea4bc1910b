"""Token ids and counts, with overlap resynchronisation for huge texts.

A huge text is encoded in overlapping chunks. Neighbouring chunks are spliced where
both have a token boundary that holds in every encoding of the text: a white-space
byte after a visible ASCII byte. No pretoken of a byte-level BPE has white space
after anything else, so a new pretoken begins there wherever the scan began, and
pretokens are encoded independently. If the overlap holds no such place, it is
doubled, in the end up to the rest of the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voltstream.llm.common import identified, record_batch

CHUNK = 1 << 16
OVERLAP = 1 << 10

# Fixed value: the pretoken pattern of the byte-level BPE.
PRETOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Beyond these letters the Unicode tables of the two libraries may differ.
UNUSUAL = re.compile("[^\t\n\r -~¡-ɏ‐-‧€]")


class Encoder:
    """The ids that the ``tokenizers`` library gives for a .json file.

    For a plain byte-level BPE, texts of ordinary Latin letters are encoded by
    ``tiktoken`` from the same vocabulary, four times as fast with the same ids;
    all other texts, and all other .json files, by ``tokenizers``. A .model file is
    read by ``sentencepiece``.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.chunk, self.overlap = chunk, overlap
        self.pieces = self.fast = self.lengths = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self._read_vocabulary(json.load(file))

    def ids(self, text: str) -> np.ndarray:
        """All ids of a text, without added special tokens.

        Long texts are resynchronised where the vocabulary is one of bytes, whose tokens
        have known lengths. With other files, as ``.model`` ones, a text is encoded whole.
        """
        if self.pieces is not None:
            return np.array(self.pieces.encode(text), np.uint32)
        ordinary = self.fast is not None and not UNUSUAL.search(text)
        encode = self._encode_fast if ordinary else self._encode_exact
        if self.lengths is None or len(text) <= self.chunk:
            return encode(text)
        return self._spliced(text.encode("utf-8", "replace"), encode)

    def _spliced(self, data: bytes, encode) -> np.ndarray:
        done, parts, overlap = 0, [], self.overlap
        end = _character(data, self.chunk)
        left, bounds = self._located(data, done, end, encode)  # always data[done:end]
        while end < len(data):
            start = _character(data, end - overlap)
            if start <= done:
                # No splice in the whole chunk: put one twice as long in its place.
                end, overlap = _character(data, 2 * end - done), self.overlap
                left, bounds = self._located(data, done, end, encode)
                continue
            right_end = _character(data, start + self.chunk + overlap)
            right, right_bounds = self._located(data, start, right_end, encode)
            place = _common(data, bounds, right_bounds, start, end)
            if place is None:
                overlap *= 2
                continue
            parts.append(left[: np.searchsorted(bounds, place)])
            kept = np.searchsorted(right_bounds, place)
            left, bounds = right[kept:], right_bounds[kept:]
            done, end, overlap = place, right_end, self.overlap
        return np.concatenate([*parts, left])

    def _located(self, data: bytes, start: int, end: int, encode):
        """The ids of data[start:end] and the place in ``data`` where each begins."""
        ids = encode(data[start:end].decode("utf-8"))
        return ids, start + np.cumsum(self.lengths[ids]) - self.lengths[ids]

    def _encode_fast(self, text: str) -> np.ndarray:
        return np.array(self.fast.encode(text, allowed_special="all"), np.uint32)

    def _encode_exact(self, text: str) -> np.ndarray:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def _read_vocabulary(self, parts: dict) -> None:
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        plain = (
            model["type"] == "BPE"
            and parts["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback"))
        )
        if not plain:
            return
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        byte = _byte_letters()
        ranks = {
            bytes(byte[c] for c in token): number
            for token, number in model["vocab"].items()
            if token not in special
        }
        self.lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, number in [*ranks.items(), *((s.encode(), n) for s, n in special.items())]:
            self.lengths[number] = len(token)
        self.fast = tiktoken.Encoding(
            "same", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens=special
        )


@lru_cache(maxsize=4)
def encoder(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, chunk, overlap)


def count_tokens(
    frame: DataFrame,
    path: str,
    limit: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Bytes and tokens of every whole text: key, n_bytes, n_tokens, over_limit.

    No shuffle; a task holds one Arrow batch. Null text counts as empty (0 bytes, 0
    tokens); a null key and repeated rows come out as they are; other columns are
    ignored. ``path`` must exist on the executors.
    """
    types = {"id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, chunk, overlap)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield record_batch(
                {
                    "id": batch.column("id"),
                    "n_bytes": [len(t.encode("utf-8", "replace")) for t in texts],
                    "n_tokens": [len(tokenizer.ids(t)) for t in texts],
                },
                types,
            )

    counted = identified(frame, key, text).mapInArrow(
        count, "id BIGINT, n_bytes BIGINT, n_tokens BIGINT"
    )
    return counted.select(
        F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _common(data: bytes, left, right, start: int, end: int) -> int | None:
    """The first place where both begin a token for certain."""
    inside = left[(left > start) & (left < end)]
    for place in np.intersect1d(inside, right, assume_unique=True):
        if data[place] in b" \t\n\r" and 0x21 <= data[place - 1] <= 0x7E:
            return int(place)
    return None


def _character(data: bytes, place: int) -> int:
    """``place``, moved back to the first byte of a character."""
    place = min(max(place, 0), len(data))
    while 0 < place < len(data) and data[place] & 0xC0 == 0x80:
        place -= 1
    return place


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 bytes stand for themselves, the rest for the letters from U+0100.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(rest)}
