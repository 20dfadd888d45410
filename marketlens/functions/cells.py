"""Cells of space, from nested cuts of a sample of points."""

from __future__ import annotations

import heapq

import numpy as np


def plan_cells(points: np.ndarray, cells: int, first: int = 0) -> tuple[tuple, int]:
    """Nested halves (axis, cut, low, high) of some points down to cell numbers, and the next free number."""
    spread = points.max(0) - points.min(0) if len(points) else np.zeros(1)
    if cells < 2 or not spread.max() > 0:
        return (first,), first + 1
    axis = int(np.where(spread > 0, points.var(0), -1).argmax())
    cut = float(np.median(points[:, axis]))
    if not (points[:, axis] > cut).any():  # more than half are at the top
        cut = float(points[points[:, axis] < cut, axis].max())
    below = points[:, axis] <= cut
    low, first = plan_cells(points[below], cells // 2, first)
    high, first = plan_cells(points[~below], cells - cells // 2, first)
    return (axis, cut, low, high), first


def plan_tight_cells(points: np.ndarray, cells: int) -> tuple:
    """Cells that leave little squared distance to their means: always the one with most is cut, at its mean."""
    def waste(rows: np.ndarray) -> float:
        return float(points[rows].var(0).sum() * len(rows)) if len(rows) else 0.0

    every = np.arange(len(points))
    cuts: dict[int, tuple[int, float, int, int]] = {}  # node: (axis, cut, low node, high node)
    queue, nodes, leaves = [(-waste(every), 0, every)], 1, 1
    while queue and leaves < cells:
        less, node, rows = heapq.heappop(queue)
        if less >= 0:
            break
        axis = int(points[rows].var(0).argmax())
        cut = float(points[rows, axis].mean())
        below = points[rows, axis] <= cut
        if below.all() or not below.any():  # equal but for rounding
            continue
        cuts[node] = (axis, cut, nodes, nodes + 1)
        for i, part in enumerate((rows[below], rows[~below])):
            heapq.heappush(queue, (-waste(part), nodes + i, part))
        nodes, leaves = nodes + 2, leaves + 1
    built: dict[int, tuple] = {}
    for node in range(nodes - 1, -1, -1):  # children have larger numbers
        if node in cuts:
            axis, cut, low, high = cuts[node]
            built[node] = (axis, cut, built.pop(low), built.pop(high))
        else:
            built[node] = (node,)
    return built[0]


def cells_of(plan: tuple, points: np.ndarray) -> np.ndarray:
    """Cell number of each point."""
    out = np.zeros(len(points), np.int32)
    stack = [(plan, np.arange(len(points)))]
    while stack:
        node, rows = stack.pop()
        if len(node) == 1:
            out[rows] = node[0]
            continue
        axis, cut, low, high = node
        below = points[rows, axis] <= cut
        stack += [(low, rows[below]), (high, rows[~below])]
    return out
