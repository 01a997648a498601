"""Results of an encoder for pieces of text, remembered per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable

#: Pieces of each of the two generations that a worker remembers.
PIECES = 300_000
#: Longer pieces are encoded for each batch, so that the memory stays small.
PIECE_CHARS = 64


class Remembered:
    """``encode`` (a list of pieces to a list of results) called once for a piece while it is remembered.

    A full generation becomes the old one; what is still asked for moves on, so frequent pieces stay.
    """

    def __init__(self, encode: Callable[[list[str]], list], pieces: int = PIECES):
        self.encode, self.pieces, self.young, self.old = encode, pieces, {}, {}

    def _turn(self) -> None:
        if len(self.young) > self.pieces:
            self.old, self.young = {p: x for p, x in self.young.items() if len(p) <= PIECE_CHARS}, {}

    def results(self, pieces: list[str]) -> list:
        """The results of distinct ``pieces``, in their order; none may be ``None``."""
        self._turn()
        out = list(map(self.young.get, pieces))
        new = []
        for i in [i for i, x in enumerate(out) if x is None]:
            out[i] = known = self.old.get(pieces[i])
            if known is None:
                new.append(i)
            else:
                self.young[pieces[i]] = known
        names = [pieces[i] for i in new]
        made = self.encode(names)
        self.young.update(zip(names, made))
        for i, x in zip(new, made):
            out[i] = x
        return out

    def table(self, pieces: Iterable[str]) -> dict:
        """A table that holds all of ``pieces``, to be read before the next call."""
        self._turn()
        missing = list(set(pieces).difference(self.young))
        new = []
        for p in missing:
            known = self.old.get(p)
            if known is None:
                new.append(p)
            else:
                self.young[p] = known
        self.young.update(zip(new, self.encode(new)))
        return self.young
