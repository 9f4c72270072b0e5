"""Order statistics over sliding day ranges, for entities of any size that follow each other."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Sequence

Found = tuple[list[int | None], list[int | None], list[int | None]]


class SlidingExtremes:
    """Largest, smallest and lower median of the values of the days ``d - span`` to ``d``, for each row.

    The values of the range are kept in order while it moves: a row enters and leaves once, at the
    cost of a search each, where a list of the whole range would be gathered and sorted for every
    row. Null values are left out; a range without values has none.
    """

    def __init__(self, span: int) -> None:
        self.span = span
        self._held: list[int] = []
        self._inside: deque[tuple[int, int]] = deque()

    def take(self, opens: Sequence[bool], days: Sequence[int], values: Sequence[int | None]) -> Found:
        """The statistics of the next rows, which come by entity and day and end with a whole day;
        ``opens`` marks the first row of an entity. What came before counts for those of its entity."""
        held, inside = self._held, self._inside
        n = len(days)
        top, low, middle = [None] * n, [None] * n, [None] * n
        at = 0
        while at < n:
            if opens[at]:
                held.clear()
                inside.clear()
            day, first = days[at], at
            while inside and inside[0][0] < day - self.span:
                del held[bisect_left(held, inside.popleft()[1])]
            while True:
                value = values[at]
                if value is not None:
                    insort(held, value)
                    inside.append((day, value))
                at += 1
                if at == n or opens[at] or days[at] != day:
                    break
            if held:
                found = held[-1], held[0], held[(len(held) - 1) // 2]
                for i in range(first, at):
                    top[i], low[i], middle[i] = found
        return top, low, middle


def open_rows(opens: Sequence[bool], days: Sequence[int]) -> int:
    """How many rows at the end may have further rows of their entity and day after them."""
    at = len(days) - 1
    while at > 0 and not opens[at] and days[at - 1] == days[at]:
        at -= 1
    return len(days) - max(at, 0)
