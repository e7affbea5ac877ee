"""Token ids of many texts by a tokenizers file, with a bounded word cache.

The word-level vocabulary lower-cases, drops white space and never joins what
white space separates, so a text's ids are its words' ids one after another.
Each worker encodes a distinct word once (until the cache is full and starts
anew) and puts texts together with numpy.  A file with any other normalizer
or pre-tokenizer is applied to whole texts instead.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import regex

from .common import row_groups
from .kernels import SEGMENT, WordTable, span_hashes, word_spans

CACHE_WORDS = 900_000

# FIXED VALUES: the normalizer steps and the pre-token pattern for which a text is the sum of its words.
_STEPS = ["NFC", "Replace", "Lowercase"]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PIECES = regex.compile(_PATTERN)
#: Characters that NFC leaves alone and that are lower-cased one by one.
_LATIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+\\Z")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTER = _byte_letters()


class Encoder:
    """Ids (uint32) of texts; use ``encoder(path)`` to share one in a worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        steps, pre = form.get("normalizer") or {}, form.get("pre_tokenizer") or {}
        split = (pre.get("pretokenizers") or [{}])[0]
        self.word_wise = (
            [s.get("type") for s in steps.get("normalizers", [])] == _STEPS
            and split.get("pattern") == {"Regex": _PATTERN} and split.get("behavior") == "Removed" and split.get("invert") is True)
        self.special = [t["content"] for t in form.get("added_tokens", [])]
        self.vocabulary = max(self.tokenizer.get_vocab().values()) + 1
        self._clear()

    def _clear(self) -> None:
        self.table = WordTable(2)  # where a word's ids start, how many there are
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _ids_of_word(self, word: bytes) -> bytes:
        """The ids as native uint32."""
        text = word.decode()
        if not _LATIN.match(text) or ("<" in text and any(t in text for t in self.special)):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text, ids = text.lower(), array("I")
        for part in (text,) if text.isalpha() else _PIECES.findall(text):
            letters = part if part.isascii() else "".join(map(_LETTER.__getitem__, part.encode()))
            ids.extend([t.id for t in self.tokenizer.model.tokenize(letters)])
        return ids.tobytes()

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """Add words to the cache, in one piece."""
        ids = list(map(self._ids_of_word, words))
        count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        total = int(count.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat[:self.used], np.zeros(max(total, self.used // 2), np.uint32)))
        self.flat[self.used:self.used + total] = np.frombuffer(b"".join(ids), np.uint32)
        self.table.add(keys, self.used + np.cumsum(count) - count, count)
        self.used += total

    def _group(self, data: np.ndarray, off: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        extra = 0 if end_id is None else 1
        rows_n = len(off) - 1
        starts, ends, rows = word_spans(data, off)
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.table) > CACHE_WORDS:
            self._clear()
        new = self.table.missing(keys)
        if len(new):
            raw, at = data.tobytes(), first[new]
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        begins, counts = (x[inverse].astype(np.int64) for x in self.table.get(keys))
        before = np.concatenate(([0], np.cumsum(counts)))
        at = np.searchsorted(rows, np.arange(rows_n + 1))
        lengths = np.diff(before[at]) + extra
        out = np.empty(int(before[-1]) + extra * rows_n, np.uint32)
        pick = np.repeat(begins - before[:-1], counts)
        pick += np.arange(len(pick))
        if extra:
            place = np.arange(len(pick)) + np.repeat(rows, counts)
            out[place] = self.flat[pick]
            out[np.cumsum(lengths) - 1] = end_id
        else:
            out[:] = self.flat[pick]
        return out, lengths

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int | None = None):
        """For runs of rows: (ids one after another, number of ids by row)."""
        for a, b in row_groups(off, 2 * SEGMENT):
            part, po = data[off[a]:off[b]], off[a:b + 1] - off[a]
            if self.word_wise:
                yield self._group(part, po, end_id)
            else:
                raw = part.tobytes()
                texts = [raw[po[i]:po[i + 1]].decode() for i in range(len(po) - 1)]
                tail = [] if end_id is None else [end_id]
                ids = [e.ids + tail for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
                yield np.array([x for i in ids for x in i], np.uint32), np.array([len(i) for i in ids], np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
