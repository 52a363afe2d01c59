"""Maximal runs of marked bytes, with the fingerprints of ``words``."""

from __future__ import annotations

import numpy as np

from tablesync.llm.words import Words


class Spans(Words):
    """As ``Words``, for runs of the bytes that ``inside`` (256 booleans, no line end) marks."""

    def __init__(self, texts: list[bytes | None], inside: np.ndarray):
        parts = [x or b"" for x in texts]
        self.data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        own = np.zeros(len(self.data) + 2, bool)
        own[1:-1] = inside[self.data]
        edge = np.flatnonzero(own[1:] != own[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        over = np.cumsum([len(x) + 1 for x in parts])
        self.first = np.concatenate(([0], np.searchsorted(self.start, over))).astype(np.int64)
        self.n = len(self.start)
