"""Token counts under a unigram model by trie-shared dynamic programming.

A text's pre-tokens are its white-space separated words behind a word mark.
The distinct words of a batch go into a trie; the unigram forward score of a
prefix (the best sum of piece scores over its segmentations, with the number
of pieces) is computed once for all words that share it, and the counts of
whole words are kept at their terminals.  A text's count is the sum over its
words, gathered with numpy.  Each worker keeps the counts of up to
``CACHE_WORDS`` words between batches and then starts anew.

Piece scores come from a sentencepiece vocabulary file, whose path is a
parameter; nothing is trained.  A character that no piece covers counts as
its UTF-8 bytes (byte fallback), each at ``BYTE_SCORE``.  Of segmentations
with equal scores the one with fewer pieces counts.

Defined results: null, empty and blank texts have no words and no tokens;
rows are independent; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, row_groups, text_buffers
from .kernels import SEGMENT, WordTable, span_hashes, word_spans

MARK = "▁"
BYTE_SCORE = -20.0
CACHE_WORDS = 600_000


class Pieces:
    """Scores of the ordinary pieces, as a trie of nested dictionaries walked
    backwards, so that one walk from a position finds all pieces ending there."""

    def __init__(self, scores: dict[str, float]):
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[None] = score

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        # a merge vocabulary ranks its pieces; the rank gives a Zipf log-probability
        harmonic = float(np.log(n) + 0.5772156649)
        usable = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): -float(np.log(rank)) - float(np.log(harmonic)) for rank, i in enumerate(usable, 1)})


def count_words(words: list[str], pieces: Pieces) -> list[int]:
    """Tokens of each (distinct) word.  Words are taken in sorted order, which is
    a walk of their trie: what a word shares with the one before it keeps its
    forward scores."""
    order = sorted(range(len(words)), key=words.__getitem__)
    out, before = [0] * len(words), ""
    best: list[tuple[float, int]] = [(0.0, 0)]  # by prefix length: (-score, pieces)
    root = pieces.root
    for k in order:
        word = MARK + words[k]
        shared, limit = 0, min(len(word), len(before))
        while shared < limit and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            fallback = len(word[end - 1].encode())
            cost, n = best[end - 1]
            least = (cost - BYTE_SCORE * fallback, n + fallback)
            node, at = root, end
            while at:
                at -= 1
                node = node.get(word[at])
                if node is None:
                    break
                score = node.get(None)
                if score is not None:
                    cost, n = best[at]
                    if (cost - score, n + 1) < least:
                        least = (cost - score, n + 1)
            best.append(least)
        out[k], before = best[-1][1], word
    return out


_loaded: dict[str, tuple[Pieces, list[WordTable]]] = {}


def _count_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]):
        if path not in _loaded:
            _loaded[path] = (Pieces.from_file(path), [WordTable(1)])
        pieces, known = _loaded[path]
        for batch in batches:
            data, off = text_buffers(batch.column("text"))
            n_words, n_tokens = [], []
            for a, b in row_groups(off, SEGMENT):
                part, po = data[off[a]:off[b]], off[a:b + 1] - off[a]
                starts, ends, rows = word_spans(part, po)
                keys, first, inverse = np.unique(span_hashes(part, starts, ends), return_index=True, return_inverse=True)
                if len(known[0]) > CACHE_WORDS:
                    known[0] = WordTable(1)
                new = known[0].missing(keys)
                if len(new):
                    raw, at = part.tobytes(), first[new]
                    words = [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())]
                    known[0].add(keys[new], np.array(count_words(words, pieces), np.int64))
                counts = known[0].get(keys)[0][inverse].astype(np.int64)
                at = np.searchsorted(rows, np.arange(len(po)))
                n_words.append(np.diff(at))
                n_tokens.append(np.diff(np.concatenate(([0], np.cumsum(counts)))[at]))
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(n_words or empty)), pa.array(np.concatenate(n_tokens or empty))],
                ["doc_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _count_task(vocabulary), "doc_id long, n_words long, n_tokens long")
