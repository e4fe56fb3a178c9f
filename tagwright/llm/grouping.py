"""A grouping genetic algorithm for packing: whole groups of items are inherited, not places of single items."""

from __future__ import annotations

from collections.abc import Iterable
from random import Random

import numpy as np

WELL_FILLED = 0.99  # share of the capacity from which a group is passed on
DISSOLVED = 4  # emptiest groups that a child gives up besides those that clash


def least_groups(sizes: np.ndarray, capacity: int) -> int:
    """A number of groups that no packing of ``sizes`` (at most ``capacity`` each) can go below.

    For each threshold t, items over half the capacity need a group each, those over capacity - t leave no room for
    items of t or more, and the items from t to half the capacity must fit what room the other large ones leave.
    """
    if not len(sizes):
        return 0
    ordered = np.sort(sizes.astype(np.int64))
    sums = np.concatenate([[0], np.cumsum(ordered)])
    half = np.searchsorted(ordered, capacity // 2, side="right")
    thresholds = np.concatenate([[0], np.unique(ordered[:half])])
    lowest = np.searchsorted(ordered, thresholds, side="left")
    alone = np.maximum(np.searchsorted(ordered, capacity - thresholds, side="right"), half)
    room = (alone - half) * capacity - (sums[alone] - sums[half])
    rest = sums[half] - sums[lowest]
    more = -(-np.maximum(rest - room, 0) // capacity)
    return int((len(ordered) - half + more).max())


class Packing:
    """Groups of items, by their places in ``sizes``, and how full each is."""

    def __init__(self, sizes: list[int], capacity: int, groups: list[list[int]] | None = None):
        self.sizes = sizes
        self.capacity = capacity
        self.groups = groups if groups is not None else []
        self.fills = [sum(map(sizes.__getitem__, group)) for group in self.groups]

    @classmethod
    def from_bytes(cls, sizes: list[int], capacity: int, data: bytes) -> "Packing":
        places = np.frombuffer(data, "<u4")
        order = np.argsort(places, kind="stable")
        edges = np.flatnonzero(np.diff(places[order])) + 1
        return cls(sizes, capacity, [group.tolist() for group in np.split(order, edges)] if len(places) else [])

    def to_bytes(self) -> bytes:
        places = np.zeros(len(self.sizes), "<u4")
        for number, group in enumerate(self.groups):
            places[group] = number
        return places.tobytes()

    @property
    def fitness(self) -> tuple[int, int]:
        """Fewer groups are better; of as many, those that are filled less evenly."""
        return -len(self.groups), sum(fill * fill for fill in self.fills)

    def best_fit(self, items: Iterable[int]) -> None:
        """Put each of ``items``, in this order, into the fullest group that has room for it, else into a new one."""
        by_room: dict[int, list[int]] = {}
        for number, fill in enumerate(self.fills):
            if fill < self.capacity:
                by_room.setdefault(self.capacity - fill, []).append(number)
        rooms = sum(1 << room for room in by_room)  # a bit for each room that some group has
        for item in items:
            size = self.sizes[item]
            enough = rooms >> size
            if enough:
                room = size + (enough & -enough).bit_length() - 1
                number = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
                self.groups[number].append(item)
                self.fills[number] += size
            else:
                room, number = self.capacity, len(self.groups)
                self.groups.append([item])
                self.fills.append(size)
            left = room - size
            if left:
                at = by_room.setdefault(left, [])
                if not at:
                    rooms |= 1 << left
                at.append(number)

    def falling(self, items: Iterable[int]) -> list[int]:
        return sorted(items, key=self.sizes.__getitem__, reverse=True)

    def crossed(self, other: "Packing", source: Random) -> "Packing":
        """A child: some well-filled groups of ``other`` as they are, the groups of this one that share no item with them,
        less the emptiest, and the displaced items by best fit, largest first."""
        full = [number for number, fill in enumerate(other.fills) if fill >= WELL_FILLED * self.capacity]
        chosen = source.sample(full, source.randint(1, max(1, len(full) // 8))) if full else []
        injected = [list(other.groups[number]) for number in chosen]
        inside = set().union(*injected)
        emptiest = set(sorted(range(len(self.fills)), key=lambda at: self.fills[at] + source.random())[:DISSOLVED])
        kept, displaced = [], []
        for number, group in enumerate(self.groups):
            if number not in emptiest and inside.isdisjoint(group):
                kept.append(list(group))
            else:
                displaced += [item for item in group if item not in inside]
        child = Packing(self.sizes, self.capacity, injected + kept)
        child.best_fit(child.falling(displaced))
        return child


def first_packings(sizes: list[int], capacity: int, n: int, source: Random, plain: bool) -> list[Packing]:
    """Best-fit packings of all items in falling order of size, ``plain`` once, else blurred."""
    found = []
    for at in range(n):
        blur = 0 if plain and not at else 0.5 * source.random()
        keys = [size * (1 + blur * (source.random() - 0.5)) for size in sizes]
        one = Packing(sizes, capacity)
        one.best_fit(sorted(range(len(sizes)), key=keys.__getitem__, reverse=True))
        found.append(one)
    return found


def evolve(population: list[Packing], least: int, generations: int, source: Random) -> list[Packing]:
    """Some generations: a child of two parents takes the place of the worst one if it is better. The best comes first.

    It ends early once a packing has the ``least`` number of groups.
    """
    ranked = sorted(population, key=lambda one: one.fitness, reverse=True)
    for _ in range(generations * len(ranked)):
        if len(ranked[0].groups) <= least or len(ranked) < 2:
            break
        first, second = sorted(source.sample(range(len(ranked)), 2))
        child = ranked[first].crossed(ranked[second], source)
        if child.fitness > ranked[-1].fitness:
            ranked[-1] = child
            ranked.sort(key=lambda one: one.fitness, reverse=True)
    return ranked
