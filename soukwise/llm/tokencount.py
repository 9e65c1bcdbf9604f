"""Token counts of a sentencepiece BPE model by a deterministic transducer.

The segmentation of a text by merges has a last token at every position, and a
sequence of tokens is the segmentation of its text exactly if every two
neighbours are that of theirs. So reading left to right, the last token at a
position is the one vocabulary entry ending there that agrees with the last
token at the place where it begins. What the future can depend on is bounded:
the longest suffix that begins a vocabulary entry, with the last tokens at the
positions inside it and the counts there relative to the present one. These are
the states; a transition carries the change of the number of tokens, and the
changes along a text add up to its count. States are compiled as they are met.

No entry reaches from another character across a space, none from letters and
digits to other characters, and characters outside the vocabulary stand alone. There the machine is in one known state whatever
came before, so the map of a chunk between such places takes every state to the
same one and adds its count: composing the maps of a text is a prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.memory import Remembered

#: Letters, marks and decimal digits.
INNER = r"[\p{L}\p{M}\p{Nd}]"
SPACE = "\N{LOWER ONE EIGHTH BLOCK}"
#: Chunk counts that a worker remembers, in each of two generations, and the states it compiles before it starts anew.
REMEMBERED, STATES = 1 << 18, 1 << 17
#: Chunks of a long text that are held at a time.
HELD = 1 << 16
LIMIT = 4096


class Model:
    """The scores of the ordinary entries of a model; runs of spaces, which merge after all others, by themselves."""

    def __init__(self, scores: dict[str, float]) -> None:
        runs = {p: s for p, s in scores.items() if not p.strip(SPACE)}
        words = {p: s for p, s in scores.items() if p == SPACE or p not in runs}
        if any(SPACE in p[1:] for p in words):
            raise ValueError("an entry reaches across a space")
        if any("\n" in p or len({regex.match(INNER, c) is None for c in p.lstrip(SPACE)}) > 1 for p in words):
            raise ValueError("an entry reaches from a letter or digit to another character, or across a line end")
        if max(runs.values()) > min((s for p, s in words.items() if len(p) > 1), default=0):
            raise ValueError("space runs have to merge last")
        self.runs = runs
        self.scores = words
        self._counter = None

    @classmethod
    def load(cls, path: str) -> Model:
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        ordinary = (i for i in range(lib.get_piece_size())
                    if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)))
        return cls({lib.id_to_piece(i): lib.get_score(i) for i in ordinary})

    def counter(self) -> Counter:
        """The one counter of this process; a worker's next task finds it as the last one left it."""
        if self._counter is None:
            self._counter = Counter(self)
        return self._counter


def segmented(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces of a text of known characters: the best neighbours merge first, of equal ones the leftmost."""
    parts: list[str] = list(text)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-scores[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
    heapify(heap)
    while heap:
        _, i, joined = heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j], after[i] = joined, "", after[j]
        if (k := after[i]) < n:
            before[k] = i
            if (p := joined + parts[k]) in scores:
                heappush(heap, (-scores[p], i, p))
        if (h := before[i]) >= 0 and (p := parts[h] + joined) in scores:
            heappush(heap, (-scores[p], h, p))
    return [p for p in parts if p]


class Transducer:
    """Compiles states and transitions as texts need them."""

    def __init__(self, model: Model) -> None:
        self.scores = model.scores
        self.prefixes = {p[:i] for p in self.scores for i in range(1, len(p) + 1)}
        self.agree = Remembered(lambda pair: segmented(pair[0] + pair[1], self.scores) == list(pair), REMEMBERED)
        self.entry = Remembered(lambda p: segmented(p, self.scores) == [p], REMEMBERED)
        self._reset()

    def _reset(self) -> None:
        # A state: the suffix, the last tokens at its positions ("" where the chunk began), their counts.
        self.states: list[tuple] = [("", ("",), (0,))]
        self.numbers = {self.states[0]: 0}
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]

    def arc(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the change of the count for one character of the vocabulary."""
        suffix, lasts, counts = self.states[state]
        suffix += char
        while suffix not in self.prefixes:
            suffix, lasts, counts = suffix[1:], lasts[1:], counts[1:]
        for at in range(len(suffix)):
            token = suffix[at:]
            if token in self.scores and self.entry[token] and (not lasts[at] or self.agree[lasts[at], token]):
                break
        else:
            raise ValueError(f"no entry ends at {char!r}")
        change = counts[at] + 1
        # Only where the rest of the suffix begins an entry can a later token begin.
        opens = [suffix[i:] in self.prefixes for i in range(len(suffix))]
        key = (suffix, (*(t if o else None for t, o in zip(lasts, opens)), token),
               (*(c - change if o else 0 for c, o in zip(counts, opens)), 0))
        if (number := self.numbers.get(key)) is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.arcs.append({})
        self.arcs[state][char] = number, change
        return number, change

    def count(self, word: str) -> int:
        """Tokens of a chunk of known characters."""
        if len(self.states) > STATES:
            self._reset()
        state = total = 0
        for char in word:
            state, change = self.arcs[state].get(char) or self.arc(state, char)
            total += change
        return total


class Counter:
    """Counts whole texts: chunks through the transducer, then the sum over the chunks."""

    #: A run of spaces with the letters and digits, or with the other characters, after it; spaces alone; a line end.
    CHUNKS = regex.compile(rf" *[{INNER[1:-1]}]+| *[^{INNER[1:-1]} \n]+| +|\n")

    def __init__(self, model: Model) -> None:
        self.model, self.machine = model, Transducer(model)
        self.counts = Remembered(self._chunk, REMEMBERED)
        self.known_chars = {p for p in model.scores if len(p) == 1}
        self.foreign = regex.compile(f"[^{''.join(map(regex.escape, sorted(self.known_chars)))}]+")

    def _spaces(self, n: int) -> int:
        return len(segmented(SPACE * n, self.model.runs))

    def _chunk(self, chunk: str) -> int:
        """Tokens of one chunk; characters outside the vocabulary count their bytes."""
        word = chunk.lstrip(" ")
        spaces, total = len(chunk) - len(word), 0
        word = SPACE + word if spaces and word else word
        if not word:
            return self._spaces(spaces)
        at, first = 0, True
        for foreign in [*self.foreign.finditer(word), None]:
            stop = len(word) if foreign is None else foreign.start()
            if stop > at:
                total += self.machine.count(word[at:stop])
                if first and spaces > 1:
                    # A space that no letter took belongs to the run before it.
                    alone = segmented(word[at:stop], self.model.scores)[0] == SPACE
                    total += self._spaces(spaces - 1 + alone) - alone
            first = False
            if foreign is not None:
                total += len(foreign.group().encode())
                at = foreign.end()
        return total

    def count(self, text: str) -> int:
        """The tokens of a text; a text that is not empty gets one space in front."""
        if not text:
            return 0
        text = " " + text.replace(SPACE, " ")
        if len(text) <= 1 << 20:
            return sum(map(self.counts.__getitem__, self.CHUNKS.findall(text)))
        chunks, total = (m.group() for m in self.CHUNKS.finditer(text)), 0
        while held := list(islice(chunks, HELD)):
            # The last entry of the prefix sums is the map of the held chunks together.
            total += int(np.cumsum(list(map(self.counts.__getitem__, held)))[-1])
        return total


def token_counts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row of ``docs``.

    A null text counts as empty and has no token. Every row gives a row, also
    repeated ones and those without an id; other columns are not looked at; an
    empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value.counter()
        for batch in batches:
            counts = [counter.count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                                             ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return (docs.select(F.col(id_col).alias("id"), text.alias("text"), size.alias("n_bytes"))
            .mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint"))
