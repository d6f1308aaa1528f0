"""Licence scans: matching statistics over a generalised suffix automaton of licence words, chained to covered spans.

All phrases and templates are words in one automaton. A text streams through it a megabyte at a time; at every word the
automaton holds the longest run ending there that some template contains. Phrases are read off the state. Runs that
cannot grow and have ``RUN`` words or more are anchors, at every place of every template where they stand; anchors are
chained in order of text and template, at most ``GAP`` words apart in either, and a chain that covers ``COVER`` of its template is a
span with that template's label. Edited licences are found as long as such runs of words are left.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and empty texts have no words and no
labels; of a very long text only the words of one megabyte and the anchors are held. Every row gets a row, repeated
rows and null ids too; other columns are ignored. Spans count words from 0, the end is exclusive.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import binaries, word_blocks
from geopulse.llm.licence_texts import PHRASES, TEMPLATES

RUN = 5
GAP = 64
COVER = 0.75
SPANS = "array<struct<label: string, start: long, end: long>>"
FOUND = "array<struct<label: string, start: long, end: long, covered: long, share: double>>"
_CODES = np.arange(256, dtype=np.uint8)
_LETTER = (_CODES >= 0x80) | (_CODES >= 0x30) & (_CODES <= 0x39) | (_CODES >= 0x61) & (_CODES <= 0x7A)
_LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 0x20, _CODES).astype(np.uint8)
#: Every byte that is in no word becomes a space.
TABLE = np.where(_LETTER[_LOWER], _LOWER, 0x20).astype(np.uint8).tobytes()


def words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Automaton:
    """A generalised suffix automaton over word numbers (from 1; 0 is no word of it)."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: dict[bytes, int] = {}
        self.labels = [label for label, _ in templates]
        self.sizes: list[int] = []
        ends: list[tuple[int, int, int]] = []
        for number, (_, text) in enumerate(templates):
            states = self._insert(self._ids(text))
            self.sizes.append(len(states))
            ends += [(state, number, i + 1) for i, state in enumerate(states)]
        tails = []
        for label, text in phrases:
            ids = self._ids(text)
            self._insert(ids)
            tails.append((ids, label))
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        # Where the longest string of a state ends: its own places and those of the states it is a suffix of.
        self.places: list[set[tuple[int, int]]] = [set() for _ in self.link]
        for state, number, end in ends:
            # A later insertion may have split the class that held this prefix; the state of the whole prefix stays.
            self.places[state].add((number, end))
        for state in reversed(order):
            self.places[self.link[state]] |= self.places[state]
        #: Phrases that end wherever the state is held with at least that many words.
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for ids, label in tails:
            self.phrases[self._walk(ids)].append((len(ids), label))
        for state in order:
            self.phrases[state] = self.phrases[state] + self.phrases[self.link[state]]

    def _ids(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text.encode())]

    def _walk(self, ids: Iterable[int]) -> int:
        return functools.reduce(lambda state, w: self.next[state][w], ids, 0)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, above: int, w: int, length: int) -> int:
        """The state reached from ``above`` by ``w`` for strings of ``length``; cut off from a longer one where needed."""
        old = self.next[above][w]
        if self.length[old] == length:
            return old
        new = self._state(length, dict(self.next[old]), self.link[old])
        self.link[old] = new
        while above >= 0 and self.next[above].get(w) == old:
            self.next[above][w] = new
            above = self.link[above]
        return new

    def _insert(self, ids: list[int]) -> list[int]:
        """Add a sequence; the states of its prefixes."""
        last, out = 0, []
        for w in ids:
            if w in self.next[last]:
                last = self._split(last, w, self.length[last] + 1)
            else:
                new, above = self._state(self.length[last] + 1, {}, 0), last
                while above >= 0 and w not in self.next[above]:
                    self.next[above][w] = new
                    above = self.link[above]
                if above >= 0:
                    self.link[new] = self._split(above, w, self.length[above] + 1)
                last = new
            out.append(last)
        return out


@functools.lru_cache(maxsize=4)
def automaton(phrases: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton(phrases, templates)


def statistics(own: Automaton, text: bytes, run: int = RUN):
    """``(n_words, phrase spans, anchors)``; an anchor is ``(start, end, state)`` of a run that cannot grow."""
    get, edges, link, length, phrases = own.vocabulary.get, own.next, own.link, own.length, own.phrases
    hits: list[tuple[str, int, int]] = []
    anchors: list[tuple[int, int, int]] = []
    base, state, held, before = 0, 0, 0, -1  # ``before``: place of the last word of the run
    for block in word_blocks(text.translate(TABLE)):
        ids = np.fromiter(map(get, block, [0] * len(block)), np.int32, len(block))
        known = np.flatnonzero(ids)
        for i, w in zip((known + base).tolist(), ids[known].tolist(), strict=True):
            if i != before + 1:
                if held >= run:
                    anchors.append((before + 1 - held, before + 1, state))
                state = held = 0
            elif w not in edges[state] and held:
                if held >= run:
                    anchors.append((i - held, i, state))
                while state and w not in edges[state]:
                    state = link[state]
                held = length[state]
            state = edges[state][w]  # every known word starts some run
            held += 1
            before = i
            for size, label in phrases[state]:
                if size <= held:
                    hits.append((label, i + 1 - size, i + 1))
        base += len(block)
    if held >= run:
        anchors.append((before + 1 - held, before + 1, state))
    return base, sorted(hits, key=lambda x: (x[1], x[2], x[0])), anchors


def chains(own: Automaton, anchors: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int, int]]:
    """``(template, start, end, covered)``: the best chains of anchors for each template, none sharing an anchor."""
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for start, end, state in anchors:
        for number, place in own.places[state]:
            by_template.setdefault(number, []).append((start, end, place))
    out = []
    for number, met in by_template.items():
        met.sort(key=lambda x: (x[1], x[2]))
        ends = [m[1] for m in met]
        best = [end - start for start, end, _ in met]
        back = [-1] * len(met)
        for j, (start, end, place) in enumerate(met):
            for i in range(bisect.bisect_left(ends, start - gap), j):
                _, end0, place0 = met[i]
                if end0 >= end or place0 >= place or place - (end - start) - place0 > gap:
                    continue
                overlap = max(0, end0 - start, place0 - (place - (end - start)))
                # Of equal chains the later anchor, so that copies of a licence keep to themselves.
                if overlap < end - start and best[i] + end - start - overlap >= best[j]:
                    best[j], back[j] = best[i] + end - start - overlap, i
        used = [False] * len(met)
        for j in sorted(range(len(met)), key=lambda j: (-best[j], j)):
            path, i = [], j
            while i >= 0 and not used[i]:
                path.append(i)
                i = back[i]
            if path:
                for k in path:
                    used[k] = True
                out.append((number, met[path[-1]][0], met[j][1], best[j] - (best[i] if i >= 0 else 0)))
    return out


def find(own: Automaton, text: bytes, *, run: int = RUN, gap: int = GAP, cover: float = COVER):
    """``(n_words, phrase spans, template spans, score)`` of a text; the score is the largest share of a template covered."""
    n, hits, anchors = statistics(own, text, run)
    found, score = [], 0.0
    for number, start, end, covered in chains(own, anchors, gap) if anchors else []:
        share = covered / own.sizes[number]
        score = max(score, share)
        if share >= cover:
            found.append((own.labels[number], start, end, covered, share))
    return n, hits, sorted(found, key=lambda x: (x[1], x[2], x[0])), score


def scan(
    docs: DataFrame, *, phrases: dict[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES,
    run: int = RUN, gap: int = GAP, cover: float = COVER, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, phrases, spans, score``: places of phrases, and spans that cover a template."""
    if not 0 < cover <= 1 or run < 1:
        raise ValueError("run is one word or more, cover above 0 and at most 1")
    wanted, known = tuple((label, text) for text, label in phrases.items()), tuple(templates)

    def task(batches):
        own = automaton(wanted, known)
        kinds = (
            pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
            pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])),
        )
        for batch in batches:
            found = [find(own, x, run=run, gap=gap, cover=cover) for x in binaries(batch.column(1))]
            spans = [pa.array([[dict(zip(names, s, strict=True)) for s in f[at]] for f in found], kind) for at, kind, names in (
                (1, kinds[0], ("label", "start", "end")), (2, kinds[1], ("label", "start", "end", "covered", "share")),
            )]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), *spans, pa.array([f[3] for f in found], pa.float64())],
                ["doc_id", "n_words", "phrases", "spans", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, f"doc_id long, n_words long, phrases {SPANS}, spans {FOUND}, score double")
