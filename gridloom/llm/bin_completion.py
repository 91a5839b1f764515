"""Best-fit packing of token pieces into sequences by bin completion over the table of lengths.

What a packing needs to know is how many pieces there are of each length, a table of at most
``capacity`` rows however large the corpus is. On it bin completion builds patterns: it takes
the largest remaining length, enumerates its undominated fillings (sets of remaining lengths
to which nothing can be added and that no other filling dominates), follows them by branch
and bound, and prunes where the waste so far can no longer beat the incumbent. The incumbent
is the best-fit solution. A pattern is used as often as its lengths last, so equal pieces
cost nothing extra. Pieces then get their place by their rank among the pieces of their
length, one join with the patterns' slots.

The search is bounded (these bound the search, not the data: every piece is placed). At most
``nodes`` fillings are followed. The fillings of one largest piece are not all enumerated: at
every step only the ``TRIED`` largest lengths that fit are tried, up to ``ITEMS`` pieces before best fit
completes the set, in at most ``STEPS`` steps, with the pairs that fill the room exactly; of
these the ``BREADTH`` best undominated ones stay. So where a packing does not meet
:func:`bound` it may have more sequences than the best one; one that meets it ends the search.
"""

from __future__ import annotations

from bisect import bisect_right

NODES = 4000      # fillings that the search may try
BREADTH = 8       # fillings that one largest piece may have
ITEMS = 6         # pieces a filling may add before best fit completes it
TRIED = 3         # largest lengths that a filling tries at every step
STEPS = 480       # steps for the fillings of one largest piece

Pattern = tuple[tuple[int, ...], int]  # lengths in falling order, how many sequences


def bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: tokens over capacity, or the pieces that exclude each other."""
    tokens = -(-sum(n * c for n, c in counts.items()) // capacity)
    best = tokens
    for small in {n for n in counts if 2 * n <= capacity} | {0}:
        # pieces above capacity - small share no sequence with one of at least `small`
        huge = sum(c for n, c in counts.items() if n > capacity - small)
        large = {n: c for n, c in counts.items() if capacity - small >= n > capacity // 2}
        room = sum(c * (capacity - n) for n, c in large.items())
        rest = sum(n * c for n, c in counts.items() if small <= n <= capacity // 2 and n > 0)
        best = max(best, huge + sum(large.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def _dominates(one: tuple[int, ...], two: tuple[int, ...]) -> bool:
    """Whether the pieces of ``two`` fit into the pieces of ``one``, each piece a bin."""
    def put(i: int, room: list[int]) -> bool:
        if i == len(two):
            return True
        for j, r in enumerate(room):
            if r >= two[i] and r not in room[:j]:
                room[j] -= two[i]
                if put(i + 1, room):
                    return True
                room[j] += two[i]
        return False
    return sum(one) >= sum(two) and put(0, list(one))


def best_fit(lengths: list[int], counts: dict[int, int], room: int) -> tuple[int, ...]:
    """Fill with the largest length that fits, again and again."""
    out: list[int] = []
    used: dict[int, int] = {}
    at = bisect_right(lengths, room)
    while at:
        n = lengths[at - 1]
        if counts[n] > used.get(n, 0):
            out.append(n)
            used[n] = used.get(n, 0) + 1
            room -= n
            at = min(at, bisect_right(lengths, room))
        else:
            at -= 1
    return tuple(out)


def fillings(lengths: list[int], counts: dict[int, int], room: int, waste: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` that leave at most ``waste``, the fullest first, best fit among them."""
    whole = best_fit(lengths, counts, room)
    if len(whole) <= 1 and sum(whole) == room:
        return [whole]  # one piece that fills the room dominates every set
    found = {whole}
    steps = 0

    def add(chosen: tuple[int, ...], left: int, top: int) -> None:
        nonlocal steps
        if steps > STEPS:
            return
        at = min(bisect_right(lengths, left), top)
        if at == 0 or len(chosen) == ITEMS:
            rest = best_fit(lengths[:top], {n: counts[n] - chosen.count(n) for n in lengths[:top]}, left) if at else ()
            if left - sum(rest) <= waste:
                found.add(chosen + rest)
            return
        # the largest that fit now
        tried = 0
        while at and tried < TRIED:
            n = lengths[at - 1]
            if counts[n] > chosen.count(n):
                steps += 1
                tried += 1
                add((*chosen, n), left - n, at)
            at -= 1

    add((), room, len(lengths))
    for i in range(min(len(lengths), bisect_right(lengths, room)) - 1, -1, -1):  # pairs that fill the room
        n, other = lengths[i], room - lengths[i]
        if other > n or len(found) > 4 * BREADTH:
            break
        if counts.get(other, 0) > (other == n):
            found.add((n, other))
    full = (f for f in found if room - sum(f) <= waste or f == whole)
    ranked = sorted(full, key=lambda f: (-sum(f), len(f), [-x for x in f]))
    kept: list[tuple[int, ...]] = []
    for f in ranked:
        if not any(len(k) <= len(f) and _dominates(k, f) for k in kept):
            kept.append(f)
        if len(kept) == BREADTH:
            break
    return kept


def _apply(counts: dict[int, int], lengths: list[int], pattern: tuple[int, ...]) -> tuple[dict[int, int], list[int], int]:
    """What is left after the pattern is used as often as its lengths last."""
    need = {n: pattern.count(n) for n in set(pattern)}
    times = min(counts[n] // k for n, k in need.items())
    counts = dict(counts)
    for n, k in need.items():
        counts[n] -= k * times
    return counts, [n for n in lengths if counts[n]], times


def _best_fit_packing(counts: dict[int, int], capacity: int) -> list[Pattern]:
    lengths = sorted(n for n, c in counts.items() if c)
    out = []
    while lengths:
        largest = lengths[-1]
        fewer = {**counts, largest: counts[largest] - 1}
        filled = best_fit([n for n in lengths if fewer[n]], fewer, capacity - largest)
        pattern = (largest, *filled)
        counts, lengths, times = _apply(counts, lengths, pattern)
        out.append((pattern, times))
    return out


def pack_lengths(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Patterns that use each length exactly ``counts`` times in as few sequences as the search finds."""
    counts = {n: c for n, c in counts.items() if c}
    least = bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    best = _best_fit_packing(counts, capacity)
    size = sum(t for _, t in best)
    tried = 0
    # depth first with an explicit stack: counts, lengths, patterns so far, sequences so far, tokens so far
    stack = [(counts, sorted(counts), (), 0, 0)]
    while stack and size > least and tried < nodes:
        left, lengths, done, used, packed = stack.pop()
        if not lengths:
            if used < size:
                size, best = used, _listed(done)
            continue
        allowed = (size - 1) * capacity - total  # waste of any better packing
        spent = used * capacity - packed
        if spent > allowed:
            continue
        largest = lengths[-1]
        fewer = {**left, largest: left[largest] - 1}
        options = fillings([n for n in lengths if fewer[n]], fewer, capacity - largest, allowed - spent)
        for filled in reversed(options):
            tried += 1
            pattern = (largest, *filled)
            rest, rest_lengths, times = _apply(left, lengths, pattern)
            now = used + times
            if now * capacity - packed - times * sum(pattern) <= allowed:
                stack.append((rest, rest_lengths, (done, (pattern, times)), now, packed + times * sum(pattern)))
    return best


def _listed(done: tuple) -> list[Pattern]:
    out = []
    while done:
        done, step = done
        out.append(step)
    return out[::-1]
