"""Small graph helpers for activity graphs; their size is that of the alphabet, never of the log."""

from __future__ import annotations

from collections.abc import Iterable


def groups(nodes: Iterable, pairs: Iterable[tuple]) -> list[frozenset]:
    """Connected groups of nodes, ordered by their smallest member."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        if a in parent and b in parent:
            parent[root(a)] = root(b)
    found: dict = {}
    for n in parent:
        found.setdefault(root(n), set()).add(n)
    return sorted((frozenset(g) for g in found.values()), key=min)


def reach_masks(n: int, edges: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(nodes in topological order, for every node the set of nodes it leads to over one or more edges, as bits).

    Nodes on a common circle stand next to each other in the order. Components are found by one depth-first walk, which
    closes them in reverse order, so each set is the union of sets that are there already.
    """
    direct: list[list[int]] = [[] for _ in range(n)]
    for a, b in edges:
        direct[a].append(b)
    reach, order = [0] * n, []
    index, low, on_stack = [-1] * n, [0] * n, [False] * n
    stack: list[int] = []
    count = 0
    for root in range(n):
        if index[root] >= 0:
            continue
        walk = [(root, 0)]
        while walk:
            node, at = walk.pop()
            if at == 0:
                index[node] = low[node] = count
                count += 1
                stack.append(node)
                on_stack[node] = True
            down = False
            for k in range(at, len(direct[node])):
                to = direct[node][k]
                if index[to] < 0:
                    walk += [(node, k + 1), (to, 0)]
                    down = True
                    break
                if on_stack[to]:
                    low[node] = min(low[node], index[to])
            if down:
                continue
            if low[node] == index[node]:
                members = []
                while not members or members[-1] != node:
                    members.append(stack.pop())
                    on_stack[members[-1]] = False
                mask = 0
                for m in members:
                    for to in direct[m]:
                        mask |= reach[to] | 1 << to
                if len(members) > 1:
                    for m in members:
                        mask |= 1 << m
                for m in members:
                    reach[m] = mask
                order += members
            if walk:
                above = walk[-1][0]
                low[above] = min(low[above], low[node])
    return order[::-1], reach
