"""Suffix automata over sequences of small integers, grown sequence by sequence, and the matching statistics that they give."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of the sequences added so far; grows linearly with their length."""

    __slots__ = ("link", "next", "size")

    def __init__(self) -> None:
        self.next, self.link, self.size = [{}], [-1], [0]

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of its own for the substrings of q that p's longest one makes with c."""
        twin = len(self.size)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def add(self, symbols: list[int]) -> None:
        step, link, size, last = self.next, self.link, self.size, 0
        for c in symbols:
            q = step[last].get(c)
            if q is not None:  # the sequences before hold this substring
                last = q if size[q] == size[last] + 1 else self._split(last, c, q)
                continue
            new, p = len(size), last
            step.append({})
            link.append(0)
            size.append(size[last] + 1)
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
            last = new

    def statistics(self, symbols: list[int], most: int) -> list[int]:
        """For each place the length, up to `most`, of the longest substring that ends there and occurs in a sequence added before."""
        step, link, size, out, at, length = self.next, self.link, self.size, [], 0, 0
        for c in symbols:
            while at and c not in step[at]:
                at = link[at]
                length = size[at]
            if c in step[at]:
                at = step[at][c]
                length += 1
                while size[link[at]] >= most:  # the longer suffix matters no more
                    at = link[at]
                    length = size[at]
            out.append(min(length, most))
        return out
