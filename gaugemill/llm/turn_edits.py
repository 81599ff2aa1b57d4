"""The cheapest edits that give a conversation's turns a legal order of roles.

Role initials must read ``(s?(ua)+)?``. Turns are kept (``K``, 0), given the role of user or
assistant (``R``, 2) or deleted (``D``, 3); empty turns of user or assistant are inserted
anywhere (``I``, 2). A truncated turn that is not deleted costs 1 more. Of the cheapest edits
those are taken whose initials, in order, come first in ASCII.

Four states tell what has been read: nothing, a system turn, a user turn, an answer. Costs from
the front and to the end meet in the middle; the crossing on the least audit splits the turns
in two, and both halves are solved the same way (Hirschberg). Only four costs are held per
pass. Fronts carry the order of their four audits: each ends with the edit of the same turn, so
that none is the beginning of another, and their order lasts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# What a turn is to the search: its role's initial, plus 4 if it is truncated; or to be deleted.
INITIALS = "sua"
OTHER = len(INITIALS)
MUST_GO = 8

_READ = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
# The one state that a turn of user or assistant can lead to.
_NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Cost of the inserts that an end in this state needs.
_END = (0, 2 * INSERT, INSERT, 0)

# From any state the end can be reached at this much more than from any other, at most: a turn
# of system to be deleted and an answer to be inserted. Fronts beyond it are on no best path.
# This holds for ends in USER and ASSISTANT; the other two are solved directly.
_SLACK = DELETE + INSERT

_NEVER = float("inf")

Front = tuple[tuple[int, int] | None, ...]  # cost and place in the order of audits, by state


def code_of(role: str, truncated: bool, must_go: bool) -> int:
    if must_go:
        return MUST_GO
    place = INITIALS.find(role[:1]) if role else -1
    return (place if place >= 0 else OTHER) + 4 * truncated


def _options(code: int, state: int) -> dict[int, tuple[int, str]]:
    """Cheapest inserts and edit of one turn that lead to each state."""
    found: dict[int, tuple[int, str]] = {}
    paid, letters = 0, ""
    for _ in range(3):  # two inserts lead around once; more are never needed
        edits = [(DELETE, "D", state)]
        if code != MUST_GO:
            initial, extra = code % 4, TRUNCATED * (code // 4)
            if initial in _READ[state]:
                edits.append((KEEP + extra, "K", _READ[state][initial]))
            edits.append((REROLE + extra, "R", _NEXT[state]))
        for cost, letter, after in edits:
            found[after] = min(
                found.get(after, (_NEVER, "")), (paid + cost, letters + letter)
            )
        paid, letters, state = paid + INSERT, letters + "I", _NEXT[state]
    return found


_TABLE = [[_options(code, state) for state in range(4)] for code in range(MUST_GO + 1)]


def front_at(state: int) -> Front:
    return tuple((0, 0) if state == each else None for each in range(4))


@lru_cache(maxsize=1 << 16)
def _ahead(front: Front, code: int) -> tuple[Front, int]:
    """The front after one more turn, and what all of it has paid."""
    best: dict[int, tuple] = {}
    for state, entry in enumerate(front):
        if entry is not None:
            for after, (cost, letters) in _TABLE[code][state].items():
                path = entry[0] + cost, entry[1], letters
                if after not in best or path < best[after]:
                    best[after] = path
    return ranked(best)


def ranked(best: dict[int, tuple]) -> tuple[Front, int]:
    """Costs over the lowest, and places by what follows the cost."""
    low = min(path[0] for path in best.values())
    kept = {state: path for state, path in best.items() if path[0] - low <= _SLACK}
    order = sorted(kept, key=lambda state: kept[state][1:])
    front = ((kept[x][0] - low, order.index(x)) if x in kept else None for x in range(4))
    return tuple(front), low


@lru_cache(maxsize=1 << 16)
def _back(costs: tuple, code: int) -> tuple:
    """Costs to the end from before one more turn, over the lowest."""
    found = [
        min((cost + costs[after] for after, (cost, _) in options.items()), default=_NEVER)
        for options in _TABLE[code]
    ]
    low = min(found)
    return tuple(cost - low for cost in found)


def advance(front: Front, codes: Sequence[int]) -> tuple[Front, int]:
    total = 0
    for code in codes:
        front, paid = _ahead(front, code)
        total += paid
    return front, total


def last_state(front: Front) -> tuple[int, int, int]:
    """Where the cheapest, least audit ends: its cost with the inserts after it, and the state."""
    cost, _, state = min(
        (entry[0] + _END[state], entry[1], state)
        for state, entry in enumerate(front)
        if entry is not None
    )
    return cost, state, _END[state] // INSERT


def solve(
    codes: Sequence[int], blocks: list[str], low: int, high: int, begin: int, end: int
) -> None:
    """Fill in the inserts and edit of the turns from ``low`` to ``high``, between two states."""
    if end == START or end == SYSTEM == begin:
        blocks[low:high] = ["D"] * (high - low)
    elif end == SYSTEM:  # one system turn is kept; of the best, the last
        blocks[low:high] = ["D"] * (high - low)
        systems = [(-(codes[i] // 4), i) for i in range(low, high) if codes[i] in (0, 4)]
        blocks[max(systems)[1]] = "K"
    elif high - low == 1:
        blocks[low] = _TABLE[codes[low]][begin][end][1]
    elif high > low:
        middle = (low + high) // 2
        front, _ = advance(front_at(begin), codes[low:middle])
        costs = tuple(0 if state == end else _NEVER for state in range(4))
        for code in reversed(codes[middle:high]):
            costs = _back(costs, code)
        *_, crossing = min(
            (entry[0] + costs[state], entry[1], state)
            for state, entry in enumerate(front)
            if entry is not None
        )
        solve(codes, blocks, low, middle, begin, crossing)
        solve(codes, blocks, middle, high, crossing, end)


def edits_of(codes: Sequence[int]) -> tuple[list[str], int, int]:
    """Inserts and edit of each turn, inserts at the end, and the cost of all."""
    blocks = [""] * len(codes)
    front, paid = advance(front_at(START), codes)
    cost, state, after = last_state(front)
    solve(codes, blocks, 0, len(codes), START, state)
    return blocks, after, paid + cost


def applied(state: int, block: str, role: str, text) -> tuple[int, list[tuple[str, object]]]:
    """The state after the edits of one turn, and the roles and texts they make; no text is
    that of an inserted turn."""
    turns = []
    for letter in block:
        if letter == "K":
            turns.append((role, text))
            state = _READ[state][INITIALS.index(role[0])]
        elif letter != "D":
            state = _NEXT[state]
            turns.append((ROLES[state], None if letter == "I" else text))
    return state, turns


# Runs of turns as one step, for conversations that are split over tasks


def crossing_costs(codes: Sequence[int]) -> list[list[int]]:
    """For each state before and after: cost and place of the least audit, -1 for none."""
    found = []
    for state in range(4):
        front, paid = advance(front_at(state), codes)
        for entry in front:
            found.append([-1, -1] if entry is None else [entry[0] + paid, entry[1]])
    return found


def crossings(steps: Sequence[Sequence[Sequence[int]]]) -> tuple[list[int], int, int]:
    """States before and after each step of the least audit, inserts at the end, and the cost."""
    front, total, origins = front_at(START), 0, []
    for step in steps:
        best: dict[int, tuple] = {}
        for state, entry in enumerate(front):
            if entry is not None:
                for after in range(4):
                    cost, place = step[4 * state + after]
                    if cost >= 0:
                        path = entry[0] + cost, entry[1], place, state
                        best[after] = min(best.get(after, path), path)
        origins.append({after: path[-1] for after, path in best.items()})
        front, paid = ranked(best)
        total += paid
    cost, state, after = last_state(front)
    states = [state]
    for origin in reversed(origins):
        states.append(origin[states[-1]])
    return states[::-1], after, total + cost
