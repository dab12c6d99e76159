"""A workflow net for a process tree and the replay of one trace on it (runs inside tasks).

A marking is a set of places, kept as the bits of an integer: a second token on a marked place can never help
a fitting trace, so it is set aside and counted as remaining at once. That keeps the number of markings finite.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Net:
    """Transitions as (label or None, input bits, output bits); place 0 is the source, place 1 the sink."""

    places: int = 2
    silent: list[tuple[int, int]] = field(default_factory=list)
    labelled: dict[str, tuple[int, int]] = field(default_factory=dict)

    def place(self) -> int:
        self.places += 1
        return self.places - 1


def net_of(tree) -> Net:
    """The net of a process tree."""
    net = Net()
    _add(net, tree, 0, 1)
    return net


def _add(net: Net, tree, start: int, end: int) -> None:
    if tree.kind == "leaf":
        net.labelled[tree.label] = (1 << start, 1 << end)
    elif tree.kind == "silent":
        net.silent.append((1 << start, 1 << end))
    elif tree.kind == "sequence":
        stops = [start, *[net.place() for _ in tree.children[1:]], end]
        for child, a, b in zip(tree.children, stops, stops[1:]):
            _add(net, child, a, b)
    elif tree.kind == "exclusive":
        for child in tree.children:
            _add(net, child, start, end)
    elif tree.kind == "parallel":
        ends = [(net.place(), net.place()) for _ in tree.children]
        net.silent.append((1 << start, sum(1 << a for a, _ in ends)))
        net.silent.append((sum(1 << b for _, b in ends), 1 << end))
        for child, (a, b) in zip(tree.children, ends):
            _add(net, child, a, b)
    else:  # loop
        body, redo = tree.children
        a, b = net.place(), net.place()
        net.silent.append((1 << start, 1 << a))
        net.silent.append((1 << b, 1 << end))
        _add(net, body, a, b)
        _add(net, redo, b, a)


class Replayer:
    """Replays activities from marking to marking and remembers every step it has worked out.

    Counts are (produced, consumed, missing, remaining).
    """

    START = 1
    SINK = 2

    def __init__(self, net: Net):
        self.net = net
        self._steps: dict = {}
        self._moves: dict = {}
        self._makers: dict[int, list[int]] = {}
        for i, (_, gives) in enumerate(net.silent):
            for place in bits(gives):
                self._makers.setdefault(place, []).append(i)

    def _fire(self, marking: int, takes: int, gives: int) -> tuple[int, tuple[int, int, int, int]]:
        missing = takes & ~marking
        left = marking & ~takes
        surplus = left & gives
        return left | gives, (gives.bit_count(), takes.bit_count(), missing.bit_count(), surplus.bit_count())

    def _path(self, marking: int, place: int, wanted: frozenset = frozenset()) -> tuple[int, ...] | None:
        """The fewest silent transitions, in firing order, that bring a token to ``place``.

        The inputs of a join lie in separate branches of the tree, so the ways to them are looked for one by
        one instead of trying all interleavings.
        """
        if marking >> place & 1:
            return ()
        best = None
        for t in self._makers.get(place, ()):
            order: list[int] | None = []
            for before in bits(self.net.silent[t][0]):
                way = None if before in wanted else self._path(marking, before, wanted | {place})
                if way is None:
                    order = None
                    break
                order += [x for x in way if x not in order]
            if order is not None and (best is None or len(order) + 1 < len(best)):
                best = (*order, t)
        return best

    def _reach(self, marking: int, place: int) -> tuple[int, tuple[int, int, int, int]]:
        """Move silently until ``place`` has a token; without a way there, stay."""
        at, counts = marking, (0, 0, 0, 0)
        for t in self._path(marking, place) or ():
            takes, gives = self.net.silent[t]
            if at & takes != takes:
                return marking, (0, 0, 0, 0)
            at, own = self._fire(at, takes, gives)
            counts = add(counts, own)
        return at, counts

    def step(self, marking: int, activity: str) -> tuple[int, tuple[int, int, int, int]]:
        """Replay one activity; an unknown one misses and leaves a token of its own."""
        known = self._steps.get((marking, activity))
        if known is None:
            arc = self.net.labelled.get(activity)
            if arc is None:
                known = marking, (1, 1, 1, 1)
            else:
                takes, gives = arc
                at, counts = self._reach(marking, takes.bit_length() - 1)
                then, own = self._fire(at, takes, gives)
                known = then, add(counts, own)
            self._steps[marking, activity] = known
        return known

    def run(self, marking: int, activities) -> tuple[int, tuple[int, int, int, int]]:
        counts = (0, 0, 0, 0)
        for activity in activities:
            marking, own = self.step(marking, activity)
            counts = add(counts, own)
        return marking, counts

    def _closure(self, markings: frozenset[int]) -> frozenset[int]:
        """All markings that silent transitions with all their tokens lead to."""
        seen, todo = set(markings), list(markings)
        while todo:
            at = todo.pop()
            for takes, gives in self.net.silent:
                if at & takes == takes and (then := at & ~takes | gives) not in seen:
                    seen.add(then)
                    todo.append(then)
        return frozenset(seen)

    def first(self) -> frozenset[int]:
        """The markings before any activity."""
        return self._closure(frozenset([self.START]))

    def follow(self, at: frozenset[int], activities) -> frozenset[int]:
        """The markings that a trace in the language can be in after more activities, with all silent ways; none is a
        trace that left the language."""
        for activity in activities:
            then = self._moves.get((at, activity))
            if then is None:
                takes, gives = self.net.labelled.get(activity, (0, 0))
                then = self._closure(frozenset(m & ~takes | gives for m in at if takes and m & takes == takes))
                if len(self._moves) > 100_000:
                    self._moves.clear()
                self._moves[at, activity] = then
            if not then:
                return then
            at = then
        return at

    def accepts(self, activities) -> bool:
        """Is the trace in the language of the net?"""
        return self.SINK in self.follow(self.first(), activities)

    def judge(self, activities) -> tuple[int, int, int, int]:
        """Counts of a whole trace. Replay takes the shortest silent way, which may be the wrong one of several; a
        trace that it finds at fault but that is in the language has nothing missing or remaining."""
        marking, counts = self.run(self.START, activities)
        counts = add(counts, self.finish(marking))
        if any(counts[2:]) and self.accepts(activities):
            return (*counts[:2], 0, 0)
        return counts

    def finish(self, marking: int) -> tuple[int, int, int, int]:
        """Reach the sink if silent steps lead there, and take its token; the first token counts as produced."""
        sink = self.SINK
        at, counts = self._reach(marking, 1)
        rest = at & ~sink
        return add(counts, (1, 1, 0 if at & sink else 1, rest.bit_count()))


def bits(marking: int) -> list[int]:
    """The places of a marking."""
    return [i for i in range(marking.bit_length()) if marking >> i & 1]


def add(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))
