"""Shortest unique prefixes from every place of a text, by a suffix array.

Suffixes are ranked by prefix doubling: ranks of 1, 2, 4, ... characters, each from two of the level before, until all differ. The ranks of
all levels tell how long two neighbouring suffixes agree (longest levels first), and a suffix's shortest unique prefix is one character longer than what it
shares with either neighbour. A text of n characters takes O(n log n) numbers and sorts, whatever it repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranks(codes: np.ndarray) -> list[np.ndarray]:
    """Ranks of every suffix by its first 1, 2, 4, ... codes (fewer at the end); the last level has no ties."""
    n = len(codes)
    out = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    k = 1
    while n and int(out[-1].max()) + 1 < n:
        first = out[-1]
        second = np.zeros(n, np.int64)
        second[: n - k] = first[k:] + 1  # 0: the text ends before
        out.append(np.unique(first * (n + 1) + second, return_inverse=True)[1].astype(np.int64))
        k *= 2
    return out


def shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes the suffixes at places a and b have in common, pair by pair."""
    n = len(levels[0])
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # Equal ranks at a level are equal stretches of 2**k codes, unless the text ends in both, which it can't at two places.
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = np.where(same, 1 << k, 0)
        a, b, out = a + step, b + step, out + step
    return out


def unique_lengths(codes: np.ndarray) -> np.ndarray:
    """For every place, the length of the shortest prefix of its suffix that begins at no other place; one more than is left if there is none."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    levels = ranks(codes)
    order = np.argsort(levels[-1], kind="stable")
    both = shared(levels, order[:-1], order[1:])
    most = np.maximum(np.append(0, both), np.append(both, 0))
    out = np.empty(n, np.int64)
    out[order] = most + 1
    return out


def anchors(texts: DataFrame, key: str, text: str, least: int = 45, most: int = 200) -> DataFrame:
    """(key, at, length, anchor) for every sentence start (from 0) of every text: the shortest prefix, `least` to `most` characters, that occurs once.

    length and anchor are null where there is none so short, also as the text ends. Characters are code points; a null or empty text has no row; rows that
    repeat are repeated; other columns are ignored. A row's text is its only bound. No shuffle.
    """
    kind = texts.schema[key].dataType.simpleString()
    src = texts.select(F.col(key), F.col(text).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                said = b.column(1)[row].as_py()
                if not said:
                    continue
                codes = np.frombuffer(said.encode("utf-32-le", "surrogatepass"), np.uint32)
                at = starts(codes)
                need = np.maximum(unique_lengths(codes)[at], least)
                ok = (need <= most) & (at + need <= len(codes))
                keys = b.column(0).take(pa.array(np.full(len(at), row)))
                cut = [said[i : i + n] if k else None for i, n, k in zip(at.tolist(), need.tolist(), ok.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys, pa.array(at.astype(np.int32)), pa.array(need.astype(np.int32), mask=~ok), pa.array(cut, pa.string())], names=[key, "at", "length", "anchor"])

    return src.mapInArrow(run, f"`{key}` {kind}, at int, length int, anchor string")


def starts(codes: np.ndarray) -> np.ndarray:
    """Places at which a sentence may begin: the first character, and each after a stop, a question or exclamation mark and one blank."""
    stop = np.isin(codes, [ord(c) for c in ".?!"])
    after = np.flatnonzero(stop[:-2] & (codes[1:-1] == 32)) + 2 if len(codes) > 2 else np.zeros(0, np.int64)
    return np.append(0, after)
