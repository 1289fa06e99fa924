"""Benchmark overlaps by every offset and every run, without seeds."""

import re
from collections import Counter, defaultdict

import numpy as np

from millrace.llm import decontam


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def brute(docs, items):
    """(doc position, item position) pairs of texts: a run of 13 aligned tokens or
    more, or a whole item of 5 to 12, with four fifths of its tokens equal."""
    items = [words(t) for t in items]
    out = set()
    for d, text in enumerate(docs):
        doc = words(text)
        where = defaultdict(list)
        for k, w in enumerate(doc):
            where[w].append(k)
        for i, item in enumerate(items):
            need = min(decontam.OVERLAP, len(item))
            if need < decontam.SHORTEST:
                continue
            # A run that counts has at least 4/5 of ``need`` equal tokens at its offset.
            equal_at = Counter(k - j for j, w in enumerate(item) for k in where[w])
            for offset, equal in equal_at.items():
                if 5 * equal < 4 * need or (d, i) in out:
                    continue
                low, high = max(0, -offset), min(len(item), len(doc) - offset)
                if high - low < need:
                    continue
                e = np.array([doc[offset + k] == item[k] for k in range(low, high)])
                s = np.r_[0, np.cumsum(5 * e.astype(int) - 4)]
                if any((s[a + need:] >= s[a]).any() for a in range(len(e) - need + 1)):
                    out.add((d, i))
    return out
