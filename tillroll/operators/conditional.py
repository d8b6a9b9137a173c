"""Frequent sets of one conditional database, as bits over its items."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: A set of items (their ranks) with its trip type and weight.
FOUND = "trip_type int, items array<int>, freq bigint"

#: Sets that share all items but the last: (shared, last items, weights).
Sets = tuple[tuple[int, ...], np.ndarray, np.ndarray]


def _merged(held: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # Baskets with fewer than two items extend nothing; equal ones count as one.
    used = held.sum(axis=1) > 1
    held, weights = held[used], weights[used]
    if len(held) < 16 or held.shape[1] > 64:
        return held, weights
    bits = np.zeros((len(held), 8), np.uint8)
    packed = np.packbits(held, axis=1)
    bits[:, : packed.shape[1]] = packed
    _, first, group = np.unique(bits.view(np.uint64).ravel(), return_index=True, return_inverse=True)
    return held[first], np.bincount(group, weights)


def _grow(shared: tuple[int, ...], held: np.ndarray, weights: np.ndarray, items: np.ndarray, least: int) -> list[Sets]:
    # One product gives the weights of all pairs, so what extends a set is known before it is visited.
    dense = held.astype(float)
    pairs = (dense * weights[:, None]).T @ dense
    found = []
    for i in range(len(items) - 1):
        more = i + 1 + np.flatnonzero(pairs[i, i + 1 :] >= least)
        if len(more):
            found.append(((*shared, int(items[i])), items[more], pairs[i, more]))
        if len(more) > 1:
            part, scaled = _merged(held[held[:, i]][:, more], weights[held[:, i]])
            found += _grow((*shared, int(items[i])), part, scaled, items[more], least)
    return found


def frequent(prefix: tuple[int, ...], baskets: list[np.ndarray] | pa.ListArray, weights: np.ndarray, least: int) -> list[Sets]:
    """All sets of ``prefix`` and at least one item that weigh ``least`` or more.

    ``baskets`` holds what follows the prefix in each distinct basket. Items become the columns of
    a bit matrix; a set's conditional database is the rows that hold it, with equal rows merged,
    over the items that are frequent with it. Weights are whole and exact up to 2 ** 53.
    """
    flat = np.asarray(baskets.flatten()) if isinstance(baskets, pa.Array) else np.concatenate(baskets)
    sizes = np.diff(baskets.offsets) if isinstance(baskets, pa.Array) else np.array([len(b) for b in baskets])
    items, columns = np.unique(flat, return_inverse=True)
    held = np.zeros((len(sizes), len(items)), bool)
    held[np.repeat(np.arange(len(sizes)), sizes), columns] = True
    alone = weights.astype(float) @ held
    often = alone >= least
    if not often.any():
        return []
    part, scaled = _merged(held[:, often], weights.astype(float))
    return [(prefix, items[often], alone[often]), *_grow(prefix, part, scaled, items[often], least)]


def mined(least: int) -> Callable[[pa.Table], pa.Table]:
    """For applyInArrow: the frequent sets of a group (trip_type, items) of rows (rest, n)."""

    def run(table: pa.Table) -> pa.Table:
        prefix = tuple(table.column("items")[0].as_py())
        rest = table.column("rest").combine_chunks()
        weights = table.column("n").to_numpy()
        sets = frequent(prefix, rest, weights, least)
        ends = [np.concatenate([np.tile(shared, (len(last), 1)), last[:, None]], axis=1) for shared, last, _ in sets]
        sizes = np.concatenate([[0], *(np.full(len(e), e.shape[1]) for e in ends)]).cumsum()
        items = pa.array(np.concatenate([np.zeros(0), *(e.ravel() for e in ends)]).astype(np.int32))
        freq = np.concatenate([np.zeros(0), *(weight for _, _, weight in sets)]).astype(np.int64)
        trip = pa.array(np.full(len(freq), table.column("trip_type")[0].as_py()), pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items)
        return pa.table([trip, lists, pa.array(freq)], ["trip_type", "items", "freq"])

    return run
