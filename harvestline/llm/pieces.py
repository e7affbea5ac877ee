"""SentencePiece ids of whole texts by an agenda of adjacent symbol pairs, and back.

The model is a merge-type (BPE) vocabulary file, whose path is a parameter.  A
normalized text starts as one symbol a character.  Every adjacent pair whose
union is a piece stands on an agenda ordered by the piece's score, then by
place; the best is merged, the pairs that it makes with its neighbours join
the agenda, and entries whose symbols were merged meanwhile are passed over.
Symbols that are no piece are spelled as byte pieces.

Two neighbouring characters that stand side by side in no piece can never be
merged, so a text is first cut at such places: before runs of blanks, and where
letters meet other characters, as far as no piece of the vocabulary stands in
the way.  The cuts change no result.  A worker keeps the ids of a bounded
number of short parts between batches, and every part that it learns it also
encodes with the sentencepiece library, a batch of new parts at a time:
``agrees`` says whether the ids are the library's.  ``decode`` is the library's.

Defined results: a null or empty text has no ids and decodes to an empty
text; a text of blanks only is encoded like any other; very long texts are
encoded whole (the agenda of a part takes n log n steps, also where a text
has no blank); rows are independent, so repeated rows and ids give repeated
results, and a null doc_id stays null; pairs of equal score are taken from
left to right; an empty table gives an empty result; columns beyond doc_id
and text are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Parts that a worker remembers, twice over, and the longest such part.
CACHE_PARTS = 450_000
CACHE_CHARS = 48
#: Symbols up to which an agenda is searched rather than kept in a heap; the merges are the same.
FEW_SYMBOLS = 32
#: Characters that are taken apart at once, and tokens decoded at once (one text at least).
SLICE_CHARS = 1 << 20
DECODE_TOKENS = 1 << 19

# FIXED VALUES of the model file format: field numbers, piece types, model type
_PIECE, _TRAINER, _TYPE, _MODEL_TYPE = 1, 2, 3, 3
_NORMAL, _UNUSED, _USER, _BPE = 1, 5, 4, 2
BLANK = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    def number(at):
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class PieceModel:
    """A merge vocabulary; use ``piece_model(path)`` to share one in a worker."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        model_type, kinds = 1, []
        for field, value in _fields(library.serialized_model_proto()):
            if field == _PIECE:
                kinds.append(dict(_fields(value)).get(_TYPE, _NORMAL))
            elif field == _TRAINER:
                model_type = dict(_fields(value)).get(_MODEL_TYPE, model_type)
        if model_type != _BPE or _UNUSED in kinds or _USER in kinds:
            raise ValueError(f"{path} is no plain merge-type vocabulary")
        normal = [i for i, kind in enumerate(kinds) if kind == _NORMAL]
        self.ids = {library.id_to_piece(i): i for i in normal}
        self.cost = {piece: -library.get_score(i) for piece, i in self.ids.items()}
        self.unknown = library.unk_id()
        spelled = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = None if self.unknown in spelled else spelled
        self.parts, self.letter, self.alone = self._pattern()
        # what may stand before a part, where the library would put a blank
        self.before = {"": b""} | {text: array("i", library.encode(text)).tobytes() for text in "a."}
        self.checked = self.alone and library.normalize("a") == BLANK + "a"
        self.known = Known()
        self.differ: set[str] = set()

    def _pattern(self) -> tuple[re.Pattern, re.Pattern, bool]:
        """What a text is cut into, what counts as a letter there, and whether every run of blanks starts a part."""
        joins = {piece[i:i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        if any(pair[0] != BLANK and pair[1] == BLANK for pair in joins):  # a piece goes on over a blank
            return re.compile(r"(?s:.+)"), re.compile(r"(?!)"), False
        letter = re.compile(r"[^\W\d_]")
        mixed = [pair for pair in joins if BLANK not in pair and bool(letter.match(pair[0])) != bool(letter.match(pair[1]))]
        # letters that a piece joins to something else do not count as letters
        odd = {c for pair in mixed for c in pair if letter.match(c)}
        letters = f"[^\\W\\d_{''.join(map(re.escape, sorted(odd)))}]"
        if any(BLANK not in pair and (pair[0] in odd) != (pair[1] in odd) and letter.match(pair[0]) and letter.match(pair[1]) for pair in joins):
            letters = "(?!)"  # nor then may the others be cut off
        others = f"(?!{letters})[^{BLANK}]"
        return re.compile(f"{BLANK}*(?:{letters}+|(?:{others})+)|{BLANK}+"), re.compile(letters), True

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge adjacent symbols until no pair is a piece."""
        return self._merge_few(symbols) if len(symbols) <= FEW_SYMBOLS else self._merge_many(symbols)

    def _merge_few(self, symbols: list[str]) -> list[str]:
        """With the agenda in the order of place, as it is short enough to be searched."""
        cost = self.cost.get
        agenda = [cost(a + b, math.inf) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == math.inf:
                break
            i = agenda.index(best)  # of equal ones the leftmost
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], math.inf)
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], math.inf)
        return symbols

    def _merge_many(self, symbols: list[str]) -> list[str]:
        """With the agenda in a heap."""
        cost, n = self.cost, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in cost:
                agenda.append((cost[pair], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                wider = pair + symbols[k]
                if wider in cost:
                    heapq.heappush(agenda, (cost[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in cost:
                    heapq.heappush(agenda, (cost[wider], h, wider))
        return [s for s in symbols if s]

    def part_ids(self, part: str) -> bytes:
        """The ids of a part, as native int32."""
        symbols = self.merge(list(part))
        try:
            return array("i", map(self.ids.__getitem__, symbols)).tobytes()
        except KeyError:
            out = array("i")
        for symbol in symbols:
            if symbol in self.ids:
                out.append(self.ids[symbol])
            elif self.bytes is None:
                out.append(self.unknown)
            else:
                out.extend([self.bytes[b] for b in symbol.encode()])
        return out.tobytes()

    def learn(self, parts: set[str]) -> None:
        """Make the ids of parts known, checking the new ones against the library."""
        known = self.known
        fresh = [p for p in parts if p not in known.older]
        known.now.update({p: known.older[p] for p in parts if p in known.older})
        known.now.update({p: self.part_ids(p) for p in fresh})
        if not self.checked:
            return
        # the library puts a blank before a text: a part that starts with one goes without it, another one behind a part it is cut from
        lead = ["" if p[0] == BLANK else "." if self.letter.match(p) else "a" for p in fresh]
        texts = [p[1:] if p[0] == BLANK else x + p for x, p in zip(lead, fresh)]
        theirs = self.library.encode(texts, num_threads=1)
        now, before = self.known.now, self.before
        if array("i", chain.from_iterable(theirs)).tobytes() != b"".join([before[x] + now[p] for x, p in zip(lead, fresh)]):
            self.differ.update(p for p, x, ids in zip(fresh, lead, theirs) if array("i", ids).tobytes() != before[x] + now[p])

    def slices(self, text: str) -> Iterator[str]:
        """A normalized text in runs of whole parts."""
        start = 0
        while self.alone and len(text) - start > SLICE_CHARS:
            end = start + SLICE_CHARS
            while end < len(text) and (text[end] != BLANK or text[end - 1] == BLANK):
                end += 1
            yield text[start:end]
            start = end
        yield text[start:]

    def encode(self, text: str) -> tuple[np.ndarray, bool]:
        """The ids of a text, and whether they are the library's."""
        found, agrees = [], self.checked
        for run in self.slices(self.library.normalize(text)) if text else ():
            parts = self.parts.findall(run)
            missing = set(parts).difference(self.known.now)
            self.learn(missing)
            found.append(b"".join(map(self.known.now.__getitem__, parts)))
            agrees = agrees and not (self.differ and self.differ.intersection(parts))
            if self.known.settle(missing):
                self.differ &= self.known.older.keys()
        ids = np.frombuffer(b"".join(found), np.int32)
        if self.bytes is None and len(ids):  # the library reports a run of unknown symbols as one
            again = np.concatenate(([False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)))
            ids = ids[~again]
        return ids, agrees or np.array_equal(ids, np.array(self.library.encode(text), np.int32))


class Known:
    """Ids by part, of a bounded number of short parts: those not asked for while
    as many others came are forgotten."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def settle(self, latest) -> bool:
        """Drop long parts among the latest; make room where there is none."""
        for part in latest:
            if len(part) > CACHE_CHARS:
                del self.now[part]
        full = len(self.now) > CACHE_PARTS
        if full:
            self.older, self.now = self.now, {}
        return full


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _runs(sizes: list[int], limit: int):
    """Runs of neighbouring rows of at most ``limit`` together, one row at least."""
    a = total = 0
    for i, size in enumerate(sizes):
        if i > a and total + size > limit:
            yield a, i
            a, total = i, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)


def _id_lists(texts_ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in texts_ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *texts_ids])))


def _decoded(model: PieceModel, ids: list[np.ndarray]) -> pa.Array:
    texts = []
    for a, b in _runs([len(x) for x in ids], DECODE_TOKENS):
        texts += model.library.decode([x.tolist() for x in ids[a:b]], num_threads=1)
    return pa.array(texts, pa.string())


def _encode_task(path: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        model = piece_model(path)
        for batch in batches:
            own, agrees = [], []
            for text in batch.column("text"):
                ids, same = model.encode(text.as_py() or "")
                own.append(ids)
                agrees.append(same)
            out = {"doc_id": batch.column("doc_id"), "ids": _id_lists(own), "agrees": pa.array(agrees, pa.bool_())}
            yield pa.RecordBatch.from_pydict(out | ({"text": _decoded(model, own)} if back else {}))
    return run


def _decode_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]):
        model = piece_model(path)
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0] + [n or 0 for n in ids.value_lengths().to_pylist()])
            lists = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(model, lists)], [*batch.schema.names, "text"])
    return run


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array<int>, agrees) for every row of ``docs`` (doc_id, text)."""
    return _encoded(docs, vocabulary, False)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass, the ids decoded where they are made."""
    return _encoded(docs, vocabulary, True)


def _encoded(docs: DataFrame, vocabulary: str, back: bool) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _encode_task(vocabulary, back), "doc_id long, ids array<int>, agrees boolean" + (", text string" if back else ""))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encode``'s rows with the text that their ids stand for; null ids give an empty text."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids", "agrees").mapInArrow(
        _decode_task(vocabulary), "doc_id long, ids array<int>, agrees boolean, text string")
