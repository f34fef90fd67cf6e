"""Suffix arrays by linear grouping of suffixes with equal Lyndon prefixes."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of all suffixes in lexicographic order, an end of text counting as the smallest character.

    First all suffixes are grouped by their longest Lyndon prefix. Groups begin
    as those of one first character and are taken in descending order. A
    member's pointer leads to the nearest place before it whose group is lower
    (the previous smaller one); the prefix there ends where the member begins,
    so places with k members pointing to them take these k prefixes over and
    move to a group of their own above what is left of theirs. No suffix is
    compared and no text renamed.

    Then groups are filled from below: after each suffix in order, the one
    before it and those its pointers lead to come next in their groups.
    """
    n = len(text)
    by_character: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_character.setdefault(c, []).append(i)
    members: list[set[int]] = []
    lower: list[int] = []
    upper: list[int] = []
    group = [0] * n
    for c in sorted(by_character):
        g = len(members)
        members.append(set(by_character[c]))
        lower.append(g - 1)
        upper.append(g + 1)
        for i in by_character[c]:
            group[i] = g
    if not members:
        return []
    upper[-1] = -1
    top = len(members) - 1
    pointer = [-2] * n  # -2: the group is not taken yet
    ordered: list[int] = []
    while top >= 0:
        own = sorted(members[top])
        ordered.append(top)
        counts: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and pointer[j] != -2:
                j = pointer[j]
            pointer[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        moves: dict[int, dict[int, list[int]]] = {}
        for j, k in counts.items():
            moves.setdefault(group[j], {}).setdefault(k, []).append(j)
        for g, by_count in moves.items():
            if len(by_count) == 1 and sum(map(len, by_count.values())) == len(members[g]):
                continue  # the whole group moves
            for k in sorted(by_count):
                new = len(members)
                moved = by_count[k]
                members.append(set(moved))
                members[g].difference_update(moved)
                for j in moved:
                    group[j] = new
                above = g if k == min(by_count) else last
                lower.append(above)
                upper.append(upper[above])
                if upper[above] >= 0:
                    lower[upper[above]] = new
                upper[above] = new
                last = new
        top = lower[top]
    place = [0] * len(members)
    filled = 0
    for g in reversed(ordered):
        place[g] = filled
        filled += len(members[g])
    order = [-1] * n
    done = bytearray(n)
    for at in range(-1, n):
        j = (n if at < 0 else order[at]) - 1
        while j >= 0 and not done[j]:
            done[j] = 1
            order[place[group[j]]] = j
            place[group[j]] += 1
            j = pointer[j]
    return order
