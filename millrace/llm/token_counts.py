"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton yields, for each place in a text, the vocabulary pieces
that end there. Dynamic programming keeps for each place the best score of a
segmentation so far and its number of pieces; no path is stored. Ties go as in the
exact tokenizer: of equal scores the piece that begins first stays, a character
without a piece of its own costs ten less than the lowest score, and neighbouring
unknown characters are one piece, or one for each UTF-8 byte if the vocabulary has
all byte pieces.

Blanks become the vocabulary's word mark, and one is put in front of a text. Where
the vocabulary has the mark itself, whole-number scores, and no piece with a mark after
another character, no piece crosses into a next word and sums are exact, so the
count of a text is the sum of its words' counts, of which the last ``CACHE`` are
remembered. Other vocabularies go through the whole text.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
PENALTY = 10.0
CACHE = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores, in order of id. Byte pieces look like ``<0x0A>``."""
    pieces: tuple[str, ...]
    scores: tuple[float, ...]


def sentencepiece_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return Vocabulary(tuple(map(model.id_to_piece, ids)), tuple(map(model.get_score, ids)))


class Counter:
    """Counts the pieces of texts; holds the automaton and the remembered words."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        best = dict(zip(vocabulary.pieces, vocabulary.scores))
        best.pop("", None)
        for piece, score in best.items():
            self.automaton.add_word(piece, (len(piece), score))
        if best:
            self.automaton.make_automaton()
        self.single = {p for p in best if len(p) == 1}
        self.unknown = min(vocabulary.scores, default=0.0) - PENALTY
        self.bytes = all(f"<0x{b:02X}>" in best for b in range(256))
        crossing = any(MARK in p[1:] and re.search(f"[^{MARK}]{MARK}", p) for p in best)
        self.by_word = MARK in self.single and not crossing and all(float(s).is_integer() for s in best.values())
        self.any = bool(best)
        self.words: OrderedDict[str, int] = OrderedDict()

    def path(self, text: str) -> int:
        """Pieces of the best segmentation of a text as it stands."""
        size = len(text)
        if not size:
            return 0
        score = np.empty(size + 1).tolist()
        count, unknown = [0] * (size + 1), [False] * (size + 1)
        score[0] = 0.0
        single, cost = self.single, self.unknown
        done = 0

        def loose(at: int) -> tuple:
            """The character before ``at`` as an unknown one."""
            if self.bytes:
                more = len(text[at - 1].encode("utf-8", "surrogatepass"))
            else:
                more = 0 if unknown[at - 1] else 1
            return score[at - 1] + cost, count[at - 1] + more, True

        for end, (length, gain) in self.automaton.iter(text) if self.any else ():
            at = end + 1
            while done < end:  # places where no piece ends
                done += 1
                if count[done] == 0:
                    score[done], count[done], unknown[done] = loose(done)
                elif text[done - 1] not in single:
                    self._offer(score, count, unknown, done, loose(done))
            total = score[at - length] + gain
            if count[at] == 0 or total > score[at]:
                score[at], count[at], unknown[at] = total, count[at - length] + 1, False
        while done < size:
            done += 1
            if count[done] == 0:
                score[done], count[done], unknown[done] = loose(done)
            elif text[done - 1] not in single:
                self._offer(score, count, unknown, done, loose(done))
        return count[size]

    @staticmethod
    def _offer(score, count, unknown, at, found):
        if found[0] > score[at]:
            score[at], count[at], unknown[at] = found

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.path(text)
        words, total = self.words, 0
        head, *rest = text.split(MARK)
        run = ""  # marks without a word after them join the next
        for word in rest:
            if not word:
                run += MARK
                continue
            key = run + word
            run = ""
            known = words.get(key)
            if known is None:
                known = words[key] = self.path(key and MARK + key)
                if len(words) > CACHE:
                    words.popitem(last=False)
            total += known
        return total + (self.path(run) if run else 0)


def _counted(vocabulary: Vocabulary):
    def batches(source):
        counter = Counter(vocabulary)
        for batch in source:
            counts = pa.array([None if t is None else counter.count(t) for t in _each(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["doc_id", "tokens"])
    return batches


def _each(column):
    for value in column:
        yield value.as_py()


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, tokens) of each row of ``docs(doc_id, text)``.

    An empty text has 0 tokens, a null text null. Repeated rows are repeated.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_counted(vocabulary), "doc_id long, tokens long")
