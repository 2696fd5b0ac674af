"""All terms that texts hold, found in one pass over the bytes of the texts (Aho-Corasick).

The terms form a trie over bytes; each of its states has a full row of next states, so a step is two
lookups, and many pieces of texts step side by side in numpy.  Bytes that no term has share one column.
What a text holds is marked in one row of cells per text, so a term counts once, however often it occurs.
"""

from __future__ import annotations

import numpy as np

CUT = 64            # bytes of a term in the trie; what longer terms have beyond is looked up where these were found
ENTRIES = 1 << 25   # of the table of next states, four bytes each
CELLS = 1 << 24     # marks of the texts looked at together, one byte each
PIECE = 1024        # bytes of a text that one lane goes through, besides the CUT - 1 before
LANES = 4096        # pieces that step side by side


class Scanner:
    """``hits`` of a fixed set of terms.  It is made once, sent to the tasks and not changed there."""

    @classmethod
    def of(cls, terms: list[bytes], ids: list[int]) -> Scanner | None:
        """A scanner for distinct terms that are not empty, or None if its table would have over ENTRIES entries."""
        made = cls.__new__(cls)
        return made if made._build(terms, ids) else None

    def _build(self, terms: list[bytes], ids: list[int]) -> bool:
        strings = sorted({t[:CUT] for t in terms})
        column = {s: i for i, s in enumerate(strings)}
        n, lengths = len(strings), np.array([len(s) for s in strings])
        self.reach, alphabet = int(lengths.max()) - 1, np.unique(np.frombuffer(b"".join(strings), dtype=np.uint8))
        self.classes = np.zeros(256, dtype=np.uint8 if len(alphabet) < 256 else np.uint16)
        self.classes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.n_classes = len(alphabet) + 1
        padded = np.frombuffer(b"".join(s.ljust(self.reach + 1, b"\0") for s in strings), dtype=np.uint8).reshape(n, -1)

        nodes, states, levels = np.zeros(n, dtype=np.int64), 1, []  # the root is state 0
        for depth in range(self.reach + 1):
            live = lengths > depth
            edges, at = np.unique(nodes[live] * self.n_classes + self.classes[padded[live, depth]], return_inverse=True)
            nodes[live] = states + at
            levels.append((edges, states, states + len(edges)))
            states += len(edges)
            if states * self.n_classes > ENTRIES:
                return False
        # a level's states start as copies of the state of their longest other suffix, which is of a level before
        own, suffix = np.full(states, -1), np.zeros(states, dtype=np.int64)
        own[nodes] = np.arange(n)
        table, longest = np.zeros((states, self.n_classes), dtype=np.int32), own.copy()
        for edges, first, last in levels:
            suffix[first:last] = table.ravel()[edges]
            table.ravel()[edges] = np.arange(first, last)
            table[first:last] = table[suffix[first:last]]
            longest[first:last] = np.where(own[first:last] < 0, longest[suffix[first:last]], own[first:last])

        # columns: the strings, the longer terms, and one for nothing found
        self.longer: dict[int, list[tuple[int, bytes]]] = {}
        numbers, told = [0] * n, np.zeros(n, dtype=bool)
        for term, number in zip(terms, ids, strict=True):
            at = column[term[:CUT]]
            if len(term) <= CUT:
                numbers[at], told[at] = number, True
            else:
                self.longer.setdefault(at, []).append((len(numbers), term))
                numbers.append(number)
        self.numbers, self.width = np.array(numbers, dtype=np.int64), len(numbers) + 1
        self.prefixes = np.flatnonzero(~told)  # strings that are no terms
        self.table = table.ravel()
        self.longest = np.where(longest < 0, self.width - 1, longest)  # string that ends at a state
        self.link = np.full(self.width, self.width - 1)  # the longest other string that ends where one ends
        self.link[:n] = self.longest[suffix[nodes]]
        return True

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the terms that each text holds; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""
        classes, rows = self.classes[data], max(1, CELLS // self.width)
        counts, found = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(offsets) - 1, rows):
            marks = self._marks(data, classes, offsets[at:at + rows + 1])
            per_text, _, columns = self._marked(marks)
            counts.append(per_text)
            found.append(self.numbers[columns])
        return np.cumsum(np.concatenate(counts)), np.concatenate(found)

    def _marks(self, data: np.ndarray, classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row for each text and in it a mark for each term that it holds."""
        n, none = len(offsets) - 1, self.width - 1
        marks = np.zeros((n, self.width), dtype=bool)
        cells = marks.ravel()
        lengths = np.diff(offsets)
        pieces = -(-lengths // PIECE)
        text = np.repeat(np.arange(n), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        sizes = np.minimum(lengths[text] - nth * PIECE, PIECE)
        order = np.argsort(-sizes, kind="stable")  # the lanes that still go on are always the first
        for at in range(0, len(order), LANES):
            lane = order[at:at + LANES]
            self._walk(classes, offsets[text[lane]] + nth[lane] * PIECE, sizes[lane], np.minimum(nth[lane] * PIECE, self.reach),
                       text[lane] * self.width, cells)
        marks[:, none] = False
        _, first, strings = self._marked(marks)
        while len(strings):  # strings that end where a found one ends
            strings = self.link[strings]
            new = ~cells[first + strings] & (strings != none)
            first, strings = first[new], strings[new]
            cells[first + strings] = True
        if self.longer:
            self._look_up(data, offsets, marks)
        marks[:, self.prefixes] = False
        return marks

    def _marked(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marks per row, and for each mark the first cell of its row and its column."""
        cells, starts = _set_cells(marks.ravel()), np.arange(len(marks) + 1) * self.width
        counts = np.diff(np.searchsorted(cells, starts))
        first = np.repeat(starts[:-1], counts)
        return counts, first, cells - first

    def _walk(self, classes: np.ndarray, start: np.ndarray, sizes: np.ndarray, before: np.ndarray, row: np.ndarray, cells: np.ndarray) -> None:
        """Marks the longest string that ends at each byte of the pieces.

        A lane starts ``before`` bytes ahead of its piece, as strings that end in the piece may start there.
        """
        lanes, most = len(start), int(before.max(initial=0))
        state, at = np.zeros(lanes, dtype=np.int32), np.empty(lanes, dtype=np.int64)
        byte, place = np.empty(lanes, dtype=classes.dtype), start - most
        going = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
        for step in range(-most, len(going)):
            if step < 0:
                np.take(classes, place, out=byte, mode="clip")
                byte[before < -step] = 0  # of another text, or not wanted yet: back to the root
            else:
                n = going[step]
                if n < len(state):
                    state, at, byte, place, row = state[:n], at[:n], byte[:n], place[:n], row[:n]
                np.take(classes, place, out=byte, mode="clip")
            np.multiply(state, self.n_classes, out=at, dtype=np.int64)
            at += byte
            np.take(self.table, at, out=state, mode="clip")
            if step >= 0:
                np.take(self.longest, state, out=at, mode="clip")
                at += row
                cells[at] = True
            place += 1

    def _look_up(self, data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> None:
        texts: dict[int, bytes] = {}
        for string, terms in self.longer.items():
            for row in np.flatnonzero(marks[:, string]).tolist():
                if row not in texts:
                    texts[row] = data[offsets[row]:offsets[row + 1]].tobytes()
                for cell, term in terms:
                    marks[row, cell] = term in texts[row]


def _set_cells(cells: np.ndarray) -> np.ndarray:
    """Where cells are marked; most are not, so eight are looked at at once."""
    whole = len(cells) >> 3 << 3
    eights = np.flatnonzero(cells[:whole].view(np.uint64))
    within = np.flatnonzero(cells[:whole].reshape(-1, 8)[eights])
    return np.concatenate([(eights << 3)[within >> 3] + (within & 7), whole + np.flatnonzero(cells[whole:])])
