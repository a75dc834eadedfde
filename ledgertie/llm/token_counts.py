"""Token counts by a transducer compiled from a BPE vocabulary.

The encoding of a text's every beginning ends in one token, and two tokens can stand side
by side if and only if they come back when their joint text is encoded. So the tokenizer
is a deterministic transducer over characters: a state holds the vocabulary prefixes that
the last characters may still complete, each with the token before it and the tokens
counted since, and a transition is annotated with the change of the count. States and
transitions are compiled when a text first takes them and kept for the next texts.

No piece of the vocabulary has a blank after another character (this is checked), so a
blank after one resets the transducer. Texts are cut there into chunks. A chunk then maps
every state it can begin in to the same state and count; equal chunks have one map, and
the maps of a text compose by a prefix scan of sums. With another vocabulary the text is
one chunk.

Defined results: null counts as empty; empty has no tokens; ids may be null or repeat;
texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgertie.llm.tables import id_and_text
from ledgertie.llm.text import BASE, BYTE_VALUES, chunks, span_hashes

LIMIT = 4096
BLANK = "▁"
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
# Compiled transitions and chunk counts that a worker keeps before it starts anew.
KEPT = 400_000


class Transducer:
    """The compiled vocabulary of a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        special = [i for i in ids if model.is_control(i) or model.is_unknown(i)]
        bytes_of = [i for i in ids if model.is_byte(i)]
        plain = set(ids) - set(special) - set(bytes_of)
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.byte_fallback = len(bytes_of) == 256
        self.resets = not any(BLANK in piece.lstrip(BLANK) for piece in self.scores)
        self.children: list[dict[str, int]] = [{}]
        self.pieces: list[str | None] = [None]
        for piece in self.scores:
            node = 0
            for char in piece:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.pieces.append(None)
                node = self.children[node][char]
            self.pieces[node] = piece
        self.pairs: dict[tuple[str, str], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {((0, None, 0),): 0}
        self.entries: list[tuple] = [((0, None, 0),)]
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.compiled = 0

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text: the best scored neighbours join first, the left of equals."""
        held = list(text)
        while True:
            best, at = None, -1
            for i in range(len(held) - 1):
                score = self.scores.get(held[i] + held[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return held
            held[at : at + 2] = [held[at] + held[at + 1]]

    def beside(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merge(left + right) == [left, right]
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition from ``state`` over ``char``: next state and emitted tokens."""
        self.compiled += 1
        if char not in self.children[0]:
            alone = len(char.encode()) if self.byte_fallback else 1
            self.steps[state][char] = (0, alone)
            return 0, alone
        alive, token, emitted = [], None, 0
        for node, before, since in self.entries[state]:
            child = self.children[node].get(char)
            if child is None:
                continue
            alive.append((child, before, since))
            piece = self.pieces[child]
            if piece is not None and token is None and self.beside(before, piece):
                token, emitted = piece, 1 - since
        if token is None:  # a character that is no piece of its own
            token, emitted = char, 1
        entry = (
            *((node, before, since + emitted) for node, before, since in alive),
            (0, token, 0),
        )
        number = self.states.get(entry)
        if number is None:
            number = self.states[entry] = len(self.entries)
            self.entries.append(entry)
            self.steps.append({})
        self.steps[state][char] = (number, emitted)
        return number, emitted

    def count(self, text: str) -> int:
        """Tokens of a chunk that begins after a reset."""
        if self.compiled > KEPT:
            self.clear()
        state, total = 0, 0
        steps = self.steps
        for char in text:
            step = steps[state].get(char) or self._compile(state, char)
            state, emitted = step
            total += emitted
        return total


@lru_cache(maxsize=2)
def transducer(path: str) -> tuple[Transducer, dict[int, int]]:
    """The vocabulary of a file and the counts of chunks met so far, one per worker."""
    return Transducer(path), {}


def _prepared(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with a blank before each text that is not empty, and blanks for their sign."""
    sizes = np.diff(offsets)
    full = sizes > 0
    blanks = np.repeat(np.uint8(0x20), full.sum())
    held = np.insert(data, offsets[:-1][full], blanks)
    starts = np.concatenate([[0], np.cumsum(sizes + full)])
    sign = BLANK.encode()
    if len(held) >= 3:
        found = (held[:-2] == sign[0]) & (held[1:-1] == sign[1]) & (held[2:] == sign[2])
        at = np.flatnonzero(found)
        if len(at):
            held = held.copy()
            held[at] = 0x20
            gone = np.concatenate([at + 1, at + 2])
            starts = starts - np.searchsorted(np.sort(gone), starts)
            held = np.delete(held, gone)
    return held, starts


def chunk_starts(held: np.ndarray, starts: np.ndarray, resets: bool) -> np.ndarray:
    """Where texts begin, and blanks that follow another character."""
    begins = np.zeros(len(held) + 1, dtype=bool)
    if resets:
        blank = held == 0x20
        begins[1:-1] = blank[1:] & ~blank[:-1]
    begins[starts] = True
    return np.flatnonzero(begins[:-1])


def counts_of(data: np.ndarray, offsets: np.ndarray, path: str) -> np.ndarray:
    """Tokens of each text: chunk counts, looked up or computed once, and their sums."""
    compiled, known = transducer(path)
    held, starts = _prepared(data, offsets)
    first = chunk_starts(held, starts, compiled.resets)
    if not len(first):
        return np.zeros(len(offsets) - 1, np.int64)
    ends = np.append(first[1:], len(held))
    hashes = span_hashes(BYTE_VALUES[held], first, ends, BASE)
    distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    text = held.tobytes()
    counts = np.empty(len(distinct), np.int64)
    for i, key in enumerate(distinct.tolist()):
        found = known.get(key)
        if found is None:
            at = example[i]
            chunk = text[first[at] : ends[at]].decode().replace(" ", BLANK)
            found = compiled.count(chunk)
            if len(known) >= KEPT:
                known.clear()
            known[key] = found
        counts[i] = found
    scanned = np.concatenate([[0], np.cumsum(counts[inverse])])
    return np.diff(scanned[np.searchsorted(first, starts)])


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of each document (doc_id, text) for the sentencepiece BPE at ``path``.

    The file has to be at the same path on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch):
                tokens = counts_of(data, offsets, path)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id")[row:end],
                        "n_bytes": pa.array(np.diff(offsets)),
                        "n_tokens": pa.array(tokens),
                        "over_limit": pa.array(tokens > limit),
                    }
                )

    return id_and_text(docs).mapInArrow(run, RESULT)
