"""Shortest paths by auction on small lattices with integer costs.

Every node has a price, never above the cost of an arc plus the price of its
head.  A path grows from the origin: its last node takes the arc with the least
cost plus price; where that equals the node's own price the path is extended by
it, where it is higher the price is raised to it and the path is contracted by
one node.  When the path meets the target, the origin's price is its distance,
and the prices are an optimal solution of the dual: the shortest paths are
exactly the paths of tight arcs, those whose cost plus price of the head is the
price of the tail.  Prices stay valid, so further origins start from them.
"""

from __future__ import annotations

INF = float("inf")

#: A node's arcs: (label, cost, head).  The target is node -1.
Arcs = list[list[tuple[str, int, int]]]
TARGET = -1


def start_prices(arcs: Arcs) -> list[float]:
    """Valid prices to begin with: infinite where no path leads to the target,
    elsewhere the least cost of an arc into it."""
    into: list[list[int]] = [[] for _ in arcs]
    ends, least = [], INF
    for i, out in enumerate(arcs):
        for _, cost, head in out:
            if head == TARGET:
                ends.append(i)
                least = min(least, cost)
            else:
                into[head].append(i)
    price: list[float] = [INF] * len(arcs)
    while ends:
        i = ends.pop()
        if price[i] == INF:
            price[i] = least
            ends += into[i]
    return price


def auction(arcs: Arcs, price: list[float], origin: int) -> None:
    """Raise ``price`` until the origin's is its distance to the target."""
    if price[origin] == INF:
        return
    path = [origin]
    while True:
        i = path[-1]
        best, to = INF, TARGET
        for _, cost, head in arcs[i]:
            reach = cost if head == TARGET else cost + price[head]
            if reach < best:
                best, to = reach, head
        if price[i] < best:
            price[i] = best
            if len(path) > 1:
                path.pop()
        elif to == TARGET:
            return
        else:
            path.append(to)


def least_trace(arcs: Arcs, price: list[float], origin: int) -> tuple[str, int]:
    """(labels, last node) of the tight path from the origin whose labels come
    first in byte order.  Labels of a node's arcs differ, but for the arc into
    the target, which has none."""
    tight = [[(label, head) for label, cost, head in sorted(out) if price[i] == cost + (0 if head == TARGET else price[head])] for i, out in enumerate(arcs)]
    into: list[list[int]] = [[] for _ in arcs]
    ends = []
    for i, out in enumerate(tight):
        for _, head in out:
            (ends if head == TARGET else into[head]).append(i)
    reaches = [False] * len(arcs)
    while ends:
        i = ends.pop()
        if not reaches[i]:
            reaches[i] = True
            ends += into[i]
    labels, i = [], origin
    while True:
        label, head = next((x for x in tight[i] if x[1] == TARGET or reaches[x[1]]))
        if head == TARGET:
            return "".join(labels), i
        labels.append(label)
        i = head
