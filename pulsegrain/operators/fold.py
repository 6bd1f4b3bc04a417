"""The counter rules for one reading after another, in order of arrival. Small helpers for Python tasks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pulsegrain.operators.counters import MAX_S64, MAX_U32, MAX_U64
from pulsegrain.specs import NormalizeConfig

def step(
    state: tuple[int, int] | None, value: int, ts: int, kind: str, config: NormalizeConfig
) -> tuple[tuple[int, int] | None, int | None]:
    """One reading in order of arrival: the state it leaves and its difference.

    Same rules as ``operators.counters.delta`` plus those for late readings: a reading older than the state has no
    difference and leaves the state alone, unless it is older by more than the cutoff; then the state is wrong (a
    time from the future) and is forgotten.
    """
    if state is None or ts - state[1] > config.cache_age_ms:
        return (value, ts), None
    old, seen = state
    if ts < seen:
        return (None if seen - ts > config.cutoff_ms else state), None
    if value >= old:
        return (value, ts), _signed64(value - old)
    if ts - seen > config.wrap_time_ms:
        return (value, ts), None
    if kind == "u32":
        over, bits, limit = MAX_U32 - old + value, 32, config.u32_limit
    else:
        end = MAX_U64 if old > MAX_S64 else MAX_S64
        over, bits, limit = end - old + value, 64, config.u64_limit
    return (value, ts), (_signed64(over) if over % 2**bits < limit else None)


def _signed64(value: int) -> int:
    low = value % 2**64
    return low - 2**64 if low > MAX_S64 else low


# What a run of readings does to the time held in state, as a step function of the time held before it:
# pieces (upper end, index of the reading held afterwards). The last upper end is None: no bound.
SAME, NOTHING = -1, -2


def effect(times: list[int], cutoff_ms: int) -> tuple[list[tuple[int | None, int]], int]:
    """Step function of a run and the outcome from empty state; outcomes are reading indexes, SAME or NOTHING.

    Built from the last reading backwards. A reading at ``t`` is taken over by every state up to ``t``, empties every
    state beyond ``t + cutoff`` and leaves those between to the readings after it.
    """
    pieces: deque[tuple[int | None, int]] = deque([(None, SAME)])
    empty = NOTHING

    def outcome(held: int, index: int) -> int:
        found = next(result for upper, result in pieces if upper is None or held <= upper)
        return index if found == SAME else found

    for index in range(len(times) - 1, -1, -1):
        time = times[index]
        taken, emptied = outcome(time, index), empty
        while pieces[0][0] is not None and pieces[0][0] <= time:
            pieces.popleft()
        if not (pieces[0][1] == taken and taken != SAME):
            pieces.appendleft((time, taken))
        while len(pieces) > 1 and pieces[-2][0] is not None and pieces[-2][0] >= time + cutoff_ms:
            pieces.pop()
        upper, result = pieces.pop()
        if result != emptied:
            pieces.append((time + cutoff_ms, result))
        pieces.append((None, emptied))
        empty = taken
    return list(pieces), empty


def after(pieces: Iterable[tuple[int | None, int]], empty: int, held: int | None) -> int:
    """Outcome of a run for the time held before it."""
    if held is None:
        return empty
    return next(result for upper, result in pieces if upper is None or held <= upper)
