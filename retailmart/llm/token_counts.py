"""Token counts by offset-mapped attribution.

The fields of a document are joined by line breaks and encoded once as a whole, so no
token depends on where a count is wanted.  A byte-level vocabulary gives every token's
bytes, so running lengths are exact offsets; token character spans are then joined to the
sections by binary search in the section starts.  Sections are the fields other than the
text, each with the line break after it, and the lines of the text with theirs.

A token that crosses a section boundary is allocated by ``rule``: ``"start"`` gives it to
the section of its first character, ``"end"`` to that of its last.

Defined results: null fields count as empty; an empty line is a section of one character;
the text's last section is there only if it is not empty, but at least one section stands
for the text; rows keep their order of arrival and repeats are counted each.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to this public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, n_tokens long, n_sections int, n_crossing long, section_tokens array<long>"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if b}


def char_starts(raw: np.ndarray) -> np.ndarray:
    """For each byte, the index of the character it belongs to."""
    return np.cumsum((raw & 0xC0) != 0x80) - 1


def section_starts(fields: list[str], raw: np.ndarray) -> np.ndarray:
    """First character of every section of the joined fields, the last of which is split into lines."""
    heads = np.cumsum([0] + [len(x) + 1 for x in fields[:-1]])
    chars = char_starts(raw)
    total = int(chars[-1]) + 1 if len(chars) else 0
    after = chars[np.flatnonzero(raw == 10)] + 1
    return np.r_[heads, after[(after > heads[-1]) & (after < total)]].astype(np.int64)


def attribute(starts: np.ndarray, lengths: np.ndarray, raw: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """(tokens per section, tokens that cross a boundary) for tokens of these byte lengths."""
    ends = np.cumsum(lengths)
    chars = char_starts(raw)
    first = np.searchsorted(starts, chars[ends - lengths], "right") - 1
    last = np.searchsorted(starts, chars[ends - 1], "right") - 1
    return np.bincount(first if rule == "start" else last, minlength=len(starts)), int((first != last).sum())


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("source", "lang", "text"), vocabulary: str = VOCABULARY,
                 pattern: str = PATTERN, rule: str = "start") -> DataFrame:
    """(doc_id, n_tokens, n_sections, n_crossing, section_tokens) of every row.

    The vocabulary is read on the driver and broadcast; its size does not depend on the data.
    """
    if rule not in ("start", "end"):
        raise ValueError(f"no such rule: {rule}")
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = shared.value
        encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            length[i] = len(token)
        for batch in batches:
            out = []
            for values in zip(*(batch.column(i + 1) for i in range(len(fields)))):
                texts = [v.as_py() or "" for v in values]
                whole = "\n".join(texts)
                raw = np.frombuffer(whole.encode(), np.uint8)
                tokens = np.asarray(encoding.encode_ordinary(whole), np.int64)
                starts = section_starts(texts, raw)
                sections, crossing = attribute(starts, length[tokens], raw, rule) if len(tokens) else (np.zeros(len(starts), np.int64), 0)
                out.append((len(tokens), len(starts), crossing, sections))
            yield pa.record_batch([batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                                   pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.list_(pa.int64()))],
                                  names=["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])

    return docs.select("doc_id", *[F.col(c).cast("string") for c in fields]).mapInArrow(count, SCHEMA)
