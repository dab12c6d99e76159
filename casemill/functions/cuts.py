"""Cuts of directly-follows graphs. Sets of activities are bits of an integer, so a graph of some ten thousand
activities is a matter of seconds; its size is that of the alphabet and its pairs, never of the log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from casemill.functions.graphs import groups, reach_masks


@dataclass
class Graph:
    """Directly-follows counts of one block."""

    edges: dict[tuple[str, str], int] = field(default_factory=dict)
    starts: dict[str, int] = field(default_factory=dict)
    ends: dict[str, int] = field(default_factory=dict)

    @property
    def activities(self) -> list[str]:
        return sorted({a for e in self.edges for a in e} | set(self.starts) | set(self.ends))

    @property
    def traces(self) -> int:
        return sum(self.starts.values())

    def occurrences(self, activity: str) -> int:
        return self.starts.get(activity, 0) + sum(n for (_, b), n in self.edges.items() if b == activity)

    def without_noise(self, noise: float) -> Graph:
        """Without edges much rarer than the strongest way (another activity or the end) out of their source."""
        best = dict(self.ends)
        for (a, _), n in self.edges.items():
            best[a] = max(best.get(a, 0), n)

        def strong(counts: dict[str, int]) -> dict[str, int]:
            limit = noise * max(counts.values(), default=0)
            return {a: n for a, n in counts.items() if n >= limit}

        edges = {(a, b): n for (a, b), n in self.edges.items() if n >= noise * best[a]}
        return Graph(edges, strong(self.starts), strong(self.ends))

    def without(self, activity: str, gaps: dict[tuple[str | None, str | None], int]) -> Graph:
        """The graph of the same traces without an activity. ``gaps``: how often its runs lie between two others; None
        stands for the start and the end of a trace."""
        edges = {e: n for e, n in self.edges.items() if activity not in e}
        starts = {a: n for a, n in self.starts.items() if a != activity}
        ends = {a: n for a, n in self.ends.items() if a != activity}
        for (a, b), n in gaps.items():
            if a is not None and b is not None:
                edges[a, b] = edges.get((a, b), 0) + n
            elif b is not None:
                starts[b] = starts.get(b, 0) + n
            elif a is not None:
                ends[a] = ends.get(a, 0) + n
        return Graph(edges, starts, ends)


def exclusive_cut(acts: Sequence[str], g: Graph) -> list[frozenset]:
    return groups(acts, g.edges)


def sequence_cut(acts: Sequence[str], g: Graph) -> list[frozenset]:
    """Groups of activities that only lead forward, in order: a border is where all before reach all after."""
    number = {a: i for i, a in enumerate(acts)}
    order, reach = reach_masks(len(acts), [(number[a], number[b]) for a, b in g.edges if a in number and b in number])
    rest, common = (1 << len(acts)) - 1, (1 << len(acts)) - 1
    parts, part = [], []
    for i, then in zip(order, [*order[1:], None]):
        part.append(acts[i])
        rest &= ~(1 << i)
        common &= reach[i]
        if then is not None and common & rest == rest and not reach[then] >> i & 1:  # not within a circle
            parts.append(frozenset(part))
            part = []
    return [*parts, frozenset(part)] if part else parts


def parallel_cut(acts: Sequence[str], g: Graph) -> list[frozenset]:
    """Groups whose activities follow each other in both directions; each one can start and end the block."""
    number = {a: i for i, a in enumerate(acts)}
    mutual = [0] * len(acts)
    for a, b in g.edges:
        if a in number and b in number and (b, a) in g.edges:
            mutual[number[a]] |= 1 << number[b]
    parts, unseen = [], (1 << len(acts)) - 1
    while unseen:  # groups of the complement
        todo = unseen & -unseen
        unseen &= ~todo
        part = 0
        while todo:
            i = (todo & -todo).bit_length() - 1
            todo &= ~(1 << i)
            part |= 1 << i
            apart = unseen & ~mutual[i]
            todo |= apart
            unseen &= ~apart
        parts.append(frozenset(a for a in acts if part >> number[a] & 1))
    whole = [p for p in parts if p & g.starts.keys() and p & g.ends.keys()]
    rest = frozenset().union(*[p for p in parts if p not in whole]) if len(whole) < len(parts) else frozenset()
    if not whole:
        return [frozenset(acts)]
    if rest:
        whole = [whole[0] | rest, *whole[1:]]
    return sorted(whole, key=min)


def loop_cut(acts: Sequence[str], g: Graph) -> list[frozenset]:
    """The body first, then the redo parts: entered from end activities and left to start activities only."""
    body = set(g.starts) | set(g.ends)
    inner = [(a, b) for a, b in g.edges if a not in body and b not in body]
    parts = groups([a for a in acts if a not in body], inner)
    part_of = {a: i for i, part in enumerate(parts) for a in part}
    no_redo = set()
    for a, b in g.edges:
        if part_of.get(a) != part_of.get(b):
            if b in part_of and a not in g.ends:
                no_redo.add(part_of[b])
            if a in part_of and b not in g.starts:
                no_redo.add(part_of[a])
    body = frozenset(body).union(*[parts[i] for i in no_redo])
    return [body, *[part for i, part in enumerate(parts) if i not in no_redo]]


_CUTS = (
    ("exclusive", exclusive_cut),
    ("sequence", sequence_cut),
    ("parallel", parallel_cut),
    ("loop", loop_cut),
)


def find_cut(g: Graph, noise: float) -> tuple[str, list[frozenset], bool] | None:
    """(kind, parts, was noise removed): the first cut of the whole graph, else of the frequent part of it."""
    acts = g.activities
    for graph, filtered in ((g, False), (g.without_noise(noise), True)) if noise > 0 else ((g, False),):
        for kind, cut in _CUTS:
            parts = cut(acts, graph)
            if len(parts) > 1:
                return kind, parts, filtered
    return None
