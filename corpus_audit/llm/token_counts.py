"""Token counts by unigram dynamic programming over a trie of distinct pre-tokens.

A pre-token is a white-space word with the space mark before it.  Its tokens are the segmentation into vocabulary
pieces of the best total score, and characters without a piece fall back to their UTF-8 bytes.  The distinct
pre-tokens of a batch are walked in sorted order, which is the depth-first order of their trie: a node is a prefix, the
scores on the way to it are computed once for all pre-tokens below it, and each terminal's count is stored.

Scores: the vocabulary is a ranked list, and the log probability of rank r is taken by Zipf's law, -ln(r + 2), in
whole millionths, so that sums are exact; of equal scores the one with fewer tokens counts.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from corpus_audit.llm.common import keyed_texts, sliced, text_bytes

MARK = "▁"
BYTE_SCORE = -25_000_000
MAX_WORDS = 500_000

COUNTS = "doc_id long, n_pretokens long, n_tokens long"


def ranked_scores(model: str) -> dict[str, int]:
    """Piece -> score in millionths, from a sentencepiece file; control, unknown and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    every = range(sp.get_piece_size())
    plain = [sp.id_to_piece(i) for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {piece: -round(1e6 * math.log(rank + 2)) for rank, piece in enumerate(plain)}


class TrieCounter:
    """Best token count of pre-tokens, with one forward pass per trie node."""

    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        # a piece can only end here if its last character ends some piece, and not be longer than those
        self.reach: dict[str, int] = {}
        for piece in scores:
            self.reach[piece[-1]] = max(self.reach.get(piece[-1], 1), len(piece))

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        scores, reach, out = self.scores, self.reach, {}
        best, tokens = [0], [0]  # by depth along the path to the current node
        before = ""
        for word in sorted(words):
            depth = len(os.path.commonprefix((before, word)))
            del best[depth + 1 :], tokens[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                last = word[end - 1]
                n = len(last.encode("utf-8", "surrogatepass"))
                top, count = best[end - 1] + n * BYTE_SCORE, tokens[end - 1] + n
                for start in range(max(0, end - reach.get(last, 1)), end):
                    score = scores.get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or score == top and tokens[start] + 1 < count:
                            top, count = score, tokens[start] + 1
                best.append(top)
                tokens.append(count)
            out[word] = tokens[-1]
            before = word
        return out


def token_counts(docs: DataFrame, scores: dict[str, int], limit: int = MAX_WORDS, rows: int = 1024) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every whole text.

    Null, empty and blank texts have none of either.  Repeated rows are counted each, null ids stay, other columns
    are ignored.  ``limit`` bounds the terminals a task remembers between batches; results do not depend on it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # a vocabulary: some ten thousand entries

    def run(batches):
        counter, known = TrieCounter(shared.value), {}
        for batch in sliced(batches, rows):
            texts = [t.split() for t in text_bytes(batch.column(1))]
            fresh = set().union(*texts).difference(known)
            if len(known) + len(fresh) > limit:
                known.clear()
                fresh = set().union(*texts)
            named = {MARK + w.decode("utf-8", "surrogatepass"): w for w in fresh}
            known.update((named[w], n) for w, n in counter.counts(named).items())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sum(map(known.__getitem__, t)) for t in texts], pa.int64()),
                ],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    return keyed_texts(docs).mapInArrow(run, COUNTS)
