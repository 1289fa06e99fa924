"""Words of whole Arrow columns of texts as numpy arrays.

Texts are handled as UTF-8 bytes, a few megabytes at a time. A longer text is
cut after a word; its next piece begins with the last ``overlap`` words again,
so that runs of ``overlap + 1`` words come once each and memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
# Separators of the word rule [^\x20\x09-\x0D]+.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
# Bytes of letters, digits and all that is not ASCII.
WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``inside`` is true."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    steps = np.diff(flags)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def pieces(texts: pa.Array, inside: np.ndarray, overlap: int, limit: int = PIECE, lower: bool = True) -> Iterator[tuple]:
    """Yields (bytes, starts, ends, rows): the words of some texts, and the row
    of the column each belongs to. Rows come in order; null texts have no words.
    A-Z are lower-cased unless told otherwise.
    """
    fold = lower_bytes if lower else np.asarray
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    row, count = 0, len(texts)
    while row < count:
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        low, high = int(offsets[row]), int(offsets[stop])
        if high - low <= limit:
            part = fold(data[low:high])
            starts, ends = word_spans(part, inside)
            # A word must not reach over the end of its text.
            starts, ends = _cut(starts, ends, offsets[row:stop + 1] - low)
            rows = row + np.searchsorted(offsets[row + 1:stop + 1] - low, starts, "right")
            keep = valid[rows]
            yield part, starts[keep], ends[keep], rows[keep]
        elif valid[row]:
            yield from _long(data[low:high], row, inside, overlap, limit, fold)
        row = stop


def _cut(starts, ends, bounds):
    """Spans cut wherever one text ends and the next begins."""
    inner = bounds[1:-1]
    at = np.searchsorted(starts, inner, "left") - 1
    hit = np.zeros(len(inner), dtype=bool)
    good = at >= 0
    hit[good] = (starts[at[good]] < inner[good]) & (ends[at[good]] > inner[good])
    cuts = np.unique(inner[hit])
    if not len(cuts):
        return starts, ends
    return np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))


def _long(data, row, inside, overlap, limit, fold):
    """Pieces of one long text; a word longer than the limit stays whole."""
    low, size = 0, len(data)
    while low < size:
        high = min(low + limit, size)
        while True:
            part = fold(data[low:high])
            starts, ends = word_spans(part, inside)
            if high < size and len(ends) and ends[-1] == high - low:
                starts, ends = starts[:-1], ends[:-1]  # may go on in the next piece
            if high == size or len(starts) > overlap:
                break
            high = min(high + 2 * (high - low), size)
        yield part, starts, ends, np.full(len(starts), row)
        if high == size:
            return
        low += int(starts[len(starts) - overlap]) if overlap else int(ends[-1])


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """The words laid out anew with one blank after each."""
    sizes = ends - starts + 1
    stops = np.cumsum(sizes)
    begins = stops - sizes
    index = np.repeat(starts - begins, sizes) + np.arange(stops[-1])
    out = data[np.minimum(index, len(data) - 1)]
    out[stops - 1] = 32
    return out, begins, stops - 1
