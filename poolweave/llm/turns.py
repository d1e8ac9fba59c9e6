"""Cheapest edits of a chat's turns that make its roles alternate.

Roles of a repaired conversation read ``(s?(ua)+)?`` by initials: nothing, or pairs of
user and assistant behind at most one system turn. The turns are aligned with that
string at each length it can have (Wagner and Fischer). All lengths share one table,
counted from the end of the string, since shorter strings are ends of longer ones; cells
whose least cost is above the best known one are left out (Ukkonen's band). Lengths of
equal cost are compared by their backtraced audits.

Long conversations are aligned in chunks. A chunk is aligned for every state of the
grammar it can start and stop in; the states of neighbouring chunks are then matched.
Equal costs of one pair of states never have one audit as the start of the other, so the
least audit of a whole is made of least audits of its chunks.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States: nothing so far, behind the system turn, behind a user turn, behind an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_LAST = {"u": USER, "a": ASSISTANT}
_OTHER = {"u": "a", "a": "u"}
_NAMES = {"u": "user", "a": "assistant"}


class Edit(NamedTuple):
    """The cheapest edits between two states; ``first`` is the first initial they give."""

    entry: int
    exit: int
    cost: int
    audit: str
    first: str


@lru_cache(maxsize=1 << 15)
def edits(turns: str, entries: tuple[int, ...], exits: tuple[int, ...]) -> tuple[Edit, ...]:
    """The cheapest edits for each pair of states, the ASCII-least where costs tie.

    ``turns`` has two characters for a turn: its role's initial (``x``: any other), then
    ``d`` if it must be deleted, ``t`` if it is truncated, ``k`` otherwise.
    """
    found: dict[tuple[int, int], Edit] = {}

    def offer(edit: Edit) -> None:
        best = found.get(edit[:2])
        if best is None or (edit.cost, edit.audit) < (best.cost, best.audit):
            found[edit[:2]] = edit

    rows = [(turns[i], turns[i + 1]) for i in range(0, len(turns), 2)]
    n = len(rows)
    everything = DELETE * n
    for state in set(entries) & set(exits):  # a string of length nothing
        offer(Edit(state, state, everything, "D" * n, ""))
    system = [i for i, (role, fault) in enumerate(rows) if role == "s" and fault != "d"] if EMPTY in entries else []
    if SYSTEM in exits:
        for i in system:
            cost = everything - DELETE + (TRUNCATED if rows[i][1] == "t" else 0)
            offer(Edit(EMPTY, SYSTEM, cost, "D" * i + "K" + "D" * (n - i - 1), "s"))
    for last, exit_ in _LAST.items():
        if exit_ not in exits:
            continue
        starts = {"a" if entry == USER else "u" for entry in entries}
        table = _Table(rows, last, max(_incumbent(rows, start, last) for start in starts))
        for length in range(1, table.width + 1):
            first = table.symbol(length)
            for entry in entries:
                if (first == "a") != (entry == USER):
                    continue
                cost = table.cost(0, length)
                best = found.get((entry, exit_))
                if cost is not None and (best is None or cost <= best.cost):
                    offer(Edit(entry, exit_, cost, table.audit(0, length), first))
            if first == "u":
                for i in system:
                    rest = table.cost(i + 1, length)
                    if rest is None:
                        continue
                    cost = DELETE * i + (TRUNCATED if rows[i][1] == "t" else 0) + rest
                    best = found.get((EMPTY, exit_))
                    if best is None or cost <= best.cost:
                        audit = "D" * i + "K" + table.audit(i + 1, length)
                        offer(Edit(EMPTY, exit_, cost, audit, "s"))
    return tuple(found.values())


def _incumbent(rows: list[tuple[str, str]], start: str, last: str) -> int:
    """A cost that can be had: nothing inserted before the end, or everything deleted."""
    cost, symbol = 0, start
    for role, fault in rows:
        if fault == "d":
            cost += DELETE
        else:
            cost += (KEEP if role == symbol else REROLE) + (TRUNCATED if fault == "t" else 0)
            symbol = _OTHER[symbol]
    # Two insertions at most reach the last initial.
    return min(cost, DELETE * len(rows)) + INSERT * 2


class _Table:
    """Costs of aligning the turns from ``i`` on with the last ``t`` initials of the string."""

    def __init__(self, rows: list[tuple[str, str]], last: str, incumbent: int) -> None:
        self.rows, self.last = rows, last
        n = len(rows)
        self.bound = incumbent
        self.width = n + incumbent // INSERT
        self.cells = self._filled()

    def symbol(self, t: int) -> str:
        return self.last if t % 2 else _OTHER[self.last]

    def _filled(self) -> list[dict[int, int]]:
        n = len(self.rows)
        # More than `over` insertions, or `under` deletions, cost more than the incumbent.
        over, under = self.bound // INSERT, self.bound // DELETE
        below: dict[int, int] = {}
        cells: list[dict[int, int]] = [below] * (n + 1)
        for t in range(over + 1):
            below[t] = INSERT * t
        cells[n] = below
        for i in range(n - 1, -1, -1):
            role, fault = self.rows[i]
            left = n - i
            extra = TRUNCATED if fault == "t" else 0
            row: dict[int, int] = {}
            before = None
            for t in range(max(0, left - under), left + over + 1):
                options = []
                cost = below.get(t)
                if cost is not None:
                    options.append(cost + DELETE)
                if before is not None:
                    options.append(before + INSERT)
                if t and fault != "d":
                    cost = below.get(t - 1)
                    if cost is not None:
                        options.append(cost + extra + (KEEP if role == self.symbol(t) else REROLE))
                before = min(options) if options else None
                if before is not None and before <= self.bound:
                    row[t] = before
                else:
                    before = None
            cells[i] = below = row
        return cells

    def cost(self, i: int, t: int) -> int | None:
        return self.cells[i].get(t)

    def audit(self, i: int, t: int) -> str:
        """The letters of the cheapest way from a cell, at each step the ASCII-least."""
        letters = []
        n = len(self.rows)
        while i < n or t:
            cost = self.cells[i][t]
            if i < n and self.cells[i + 1].get(t, cost) + DELETE == cost:
                letters.append("D")
                i += 1
            elif t and self.cells[i].get(t - 1, cost) + INSERT == cost:
                letters.append("I")
                t -= 1
            else:
                letters.append("K" if self.rows[i][0] == self.symbol(t) else "R")
                i, t = i + 1, t - 1
        return "".join(letters)


def repaired(roles: list[str], texts: list[str], audit: str, first: str) -> list[str]:
    """The turns ``role:text`` that an audit leaves of the given ones."""
    out = []
    turn, target = 0, first
    for letter in audit:
        if letter == "D":
            turn += 1
            continue
        if letter == "I":
            out.append(f"{_NAMES[target]}:")
        else:
            role = roles[turn] if letter == "K" else _NAMES[target]
            out.append(f"{role}:{texts[turn]}")
            turn += 1
        target = "u" if target == "s" else _OTHER[target]
    return out
