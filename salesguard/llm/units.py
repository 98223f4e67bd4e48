"""Texts as words that are encoded once for a group of texts.

Where a vocabulary never joins characters across a blank or a line feed, a
text's ids are those of its words in a row. A group's texts are split in Arrow,
each distinct word is encoded once, and the ids are gathered in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of about so many characters are a group.
GROUP = 3 << 20


def groups(texts: list[str], size: int | None = None) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive groups of texts."""
    first = held = 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= (size or GROUP):
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, each text's words as their numbers, and where each text ends
    among these. A line feed begins the word after it, blanks are left out."""
    lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n"), " ")
    return (*distinct(lists.flatten()), lists.offsets.to_numpy()[1:].astype(np.int64))


def distinct(words: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = pc.dictionary_encode(words)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def gather(ids: np.ndarray, start: np.ndarray, count: np.ndarray, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and where each text ends among them; word k
    has the ``count[k]`` ids from ``start[k]`` on."""
    n = count[words]
    upto = np.cumsum(n)
    total = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at -= np.repeat((upto - n - start[words]).astype(kind), n)
    return ids[at], np.r_[0, upto][ends]
