"""Metric trees of points, built from the middle out by anchors, for exact nearest entries.

A set of n points gets about the square root of n anchors: the next one is the
point furthest from its own anchor, and takes the points nearer to it than to
theirs; those nearer to their anchor than half the way between the two anchors
cannot change and are not looked at. Anchors are then joined two by two, the
pair with the smallest common ball first, up to one root, and each anchor's own
points are divided in the same way, down to leaves. A ball caches the count and
the sums of its points.

Entries of a codebook are found from the root down. A ball inherits the entries
that can be nearest to a point of its parent and strikes those that are on the
far side of the plane halfway to the entry nearest its centre for all of the
ball. A ball with one entry left is wholly owned, its points are not looked at;
leaves compare their points with what is left, in whole numbers.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

LEAF = 64
SLACK = 1e-9  # of rounding in the distances that strike entries


@dataclass
class Tree:
    """Points in leaf order and balls, the root first; a leaf has no children (-1)."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    centre: np.ndarray
    radius: np.ndarray

    def dumps(self) -> bytes:
        file = io.BytesIO()
        for array in vars(self).values():
            np.save(file, array)
        return file.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Tree:
        file = io.BytesIO(data)
        return cls(*(np.load(file) for _ in cls.__dataclass_fields__))


def _anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor each point belongs to, numbered from 0; one alone if all points are equal."""
    owner = np.zeros(len(points), np.int32)
    pivots = [points[0]]
    far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(pivots) < wanted:
        furthest = int(far.argmax())
        if far[furthest] == 0:
            break
        pivot = points[furthest]
        half = np.sqrt(((np.array(pivots) - pivot) ** 2).sum(axis=1)) / 2
        open_ = np.flatnonzero(far >= half[owner])
        own = np.sqrt(((points[open_] - pivot) ** 2).sum(axis=1))
        nearer = own < far[open_]
        taken = open_[nearer]
        owner[taken], far[taken] = len(pivots), own[nearer]
        pivots.append(pivot)
    return owner


def _joined(points: np.ndarray, groups: list[np.ndarray]):
    """Groups joined two by two into nested pairs of group numbers, compact pairs first."""
    centres = np.array([points[g].mean(axis=0) for g in groups])
    radii = np.array([np.sqrt(((points[g] - c) ** 2).sum(axis=1)).max() for g, c in zip(groups, centres)])
    counts = np.array([len(g) for g in groups], np.float64)
    nested: list = list(range(len(groups)))
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    cost = (apart + radii[:, None] + radii[None]) / 2
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(groups) - 1):
        i, j = divmod(int(cost.argmin()), len(groups))
        nested[i] = (nested[i], nested[j])
        centre = (centres[i] * counts[i] + centres[j] * counts[j]) / (counts[i] + counts[j])
        radii[i] = max(np.linalg.norm(centre - centres[k]) + radii[k] for k in (i, j))
        centres[i], counts[i] = centre, counts[i] + counts[j]
        cost[j], cost[:, j] = np.inf, np.inf
        open_ = np.isfinite(cost[i])
        own = np.sqrt(((centres[open_] - centre) ** 2).sum(axis=1))
        cost[i, open_] = cost[open_, i] = (own + radii[open_] + radii[i]) / 2
        last = i
    return nested[last] if len(groups) > 1 else nested[0]


def build(points: np.ndarray) -> Tree:
    """The tree of a matrix of whole numbers, a point a row."""
    floats = points.astype(np.float64)
    order: list[np.ndarray] = []
    balls: list[list[int]] = []  # start, end, left, right
    placed = 0

    # What is left to place, last first: points to divide, or the ball to be closed.
    todo: list[tuple] = [("divide", np.arange(len(points)), None)]
    while todo:
        what, held, parent = todo.pop()
        if what == "close":
            balls[held][1] = placed
            continue
        number = len(balls)
        if parent is not None:
            balls[parent][2 if balls[parent][2] < 0 else 3] = number
        balls.append([placed, 0, -1, -1])
        if what == "divide":
            owner = _anchors(floats[held], int(len(held) ** 0.5)) if len(held) > LEAF else None
            if owner is None or not owner.any():
                order.append(held)
                placed += len(held)
                balls[number][1] = placed
                continue
            sort = np.argsort(owner, kind="stable")
            groups = np.split(held[sort], np.flatnonzero(np.diff(owner[sort])) + 1)
            pair = _joined(floats, groups)
        else:
            groups, pair = held
        todo.append(("close", number, None))
        for child in reversed(pair):
            if isinstance(child, tuple):
                todo.append(("join", (groups, child), number))
            else:
                todo.append(("divide", groups[child], number))

    placed_points = np.concatenate(order) if order else np.zeros(0, np.int64)
    start, end, left, right = (np.array(x, np.int32) for x in zip(*balls))
    inner = floats[placed_points]
    summed = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points[placed_points].cumsum(axis=0)])
    sums = summed[end] - summed[start]
    centre = sums / np.maximum(end - start, 1)[:, None]
    radius = np.array(
        [((inner[s:e] - c) ** 2).sum(axis=1).max(initial=0) for s, e, c in zip(start, end, centre)]
    )
    return Tree(placed_points.astype(np.int32), start, end, left, right, sums, centre, np.sqrt(radius))


def owners(tree: Tree, points: np.ndarray, entries: np.ndarray):
    """Which entry is nearest, ties to the lower number: for whole balls, and for single points.

    Gives (balls, their entries) and (places in leaf order, their entries).
    """
    floats = entries.astype(np.float64)
    apart = np.sqrt(((floats[:, None] - floats[None]) ** 2).sum(axis=2))
    first = np.array([not (apart[:i, i] == 0).any() for i in range(len(entries))])
    nodes, listed = np.zeros(1, np.int64), first[None]
    owned, own_entry, places, place_entry = [], [], [], []
    while len(nodes):
        square = ((tree.centre[nodes][:, None] - floats[None]) ** 2).sum(axis=2)
        square[~listed] = np.inf
        near = square.argmin(axis=1)
        least = square[np.arange(len(nodes)), near][:, None]
        rounding = SLACK * (square + least) + SLACK
        beyond = square - least > 2 * tree.radius[nodes][:, None] * apart[near] + rounding
        listed = listed & ~beyond
        alone = listed.sum(axis=1) == 1
        owned.append(nodes[alone])
        own_entry.append(near[alone])
        leaf = ~alone & (tree.left[nodes] < 0)
        for node, mine in zip(nodes[leaf], listed[leaf]):
            s, e, some = tree.start[node], tree.end[node], np.flatnonzero(mine)
            away = points[tree.order[s:e]][:, None] - entries[some][None]
            places.append(np.arange(s, e))
            place_entry.append(some[(away * away).sum(axis=2).argmin(axis=1)])
        split = ~alone & ~leaf
        nodes = np.concatenate([tree.left[nodes[split]], tree.right[nodes[split]]]).astype(np.int64)
        listed = np.concatenate([listed[split]] * 2)
    empty = np.zeros(0, np.int64)
    return (
        (np.concatenate([empty, *owned]), np.concatenate([empty, *own_entry])),
        (np.concatenate([empty, *places]), np.concatenate([empty, *place_entry])),
    )


def totals(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """By entry: the count of its points, then their sums."""
    (balls, ball_entry), (places, place_entry) = owners(tree, points, entries)
    out = np.zeros((len(entries), 1 + points.shape[1]), np.int64)
    np.add.at(out[:, 0], ball_entry, (tree.end - tree.start)[balls])
    np.add.at(out[:, 1:], ball_entry, tree.sums[balls])
    np.add.at(out[:, 0], place_entry, 1)
    np.add.at(out[:, 1:], place_entry, points[tree.order[places]])
    return out


def nearest(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The number of the nearest entry of each point."""
    (balls, ball_entry), (places, place_entry) = owners(tree, points, entries)
    found = np.zeros(len(points), np.int64)
    for ball, entry in zip(balls, ball_entry):
        found[tree.order[tree.start[ball] : tree.end[ball]]] = entry
    found[tree.order[places]] = place_entry
    return found
