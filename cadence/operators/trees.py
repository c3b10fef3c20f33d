"""Histogram regression trees on binned columns, for the tasks of ``batchfit``.

A column's bins are numbered through all columns, so a row is one code per column and a
level's histogram is one count over (node, code). Split search, growth level by level and
prediction are vectorised over a level's nodes and all rows.

Columns of few joint codes (those derived from one another, mostly) are a *bundle*: their
joint codes are numbered, a row is counted once by that number, and the columns' histograms
are sums over it. Which columns go together is proposed by some rows; the joint codes are
those of all rows, and a bundle that has too many of them is taken apart.

Splits maximise GL^2 / (HL + p) + GR^2 / (HR + p) - G^2 / (H + p), with G and H the sums
of gradients and Hessians (rows or bootstrap weights for squared error) and p the leaf
penalty; a leaf's value is G / (H + p). Without penalty that is the variance criterion.
Ties, up to the rounding of sums, go to the first column, then the lowest bin. A missing
value is larger than all.

Draws depend on the seed, the tree and a row's or node's number alone, so trees don't
depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Cells of a histogram that are counted at once.
CELLS = 1 << 22
LEAST_GAIN = 1e-10
#: Joint codes that a bundle may have in the rows that propose it, those rows, and the joint
#: codes beyond which it is taken apart.
WIDE, PROPOSE, APART = 256, 5000, 1024
SMALL_TREE = 512                           # nodes


@dataclass(frozen=True)
class Settings:
    """What a tree ensemble is grown with."""

    rounds: int
    learning_rate: float = 1.0
    max_depth: int | None = None
    row_share: float = 1.0                 # of the rows, for each tree
    bootstrap: bool = False                # rows drawn with replacement, trees averaged
    tree_columns: float = 1.0              # share of the columns, for each tree
    node_columns: float | str = 1.0        # share, or "sqrt", for each node
    min_rows: int = 1
    min_weight: float = 0.0
    leaf_penalty: float = 0.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of growth; ``column`` -1 is a leaf, children stand at left, left + 1.
    ``cut`` is the largest code that goes left."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray


class Layout:
    """Bins of columns, numbered end to end."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes = np.asarray(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.total = int(self.ends[-1]) if len(self.sizes) else 0
        self.column = np.repeat(np.arange(len(self.sizes)), self.sizes)


def proposed(codes: np.ndarray, layout: Layout) -> list[list[int]]:
    """Columns that may be counted together, by the joint codes of some rows."""
    codes = codes[:: max(1, len(codes) // PROPOSE)]
    sizes = layout.sizes.tolist()
    groups: list[list[int]] = []
    held: list[tuple[np.ndarray, int, int]] = []          # joint number of every row, numbers, product of sizes
    for c in sorted(range(len(sizes)), key=lambda c: -sizes[c]):
        for k, (joint, most, product) in enumerate(held):
            if most and product * sizes[c] < 1 << 62:
                seen = np.bincount(joint * sizes[c] + codes[:, c], minlength=most * sizes[c]) > 0
                n = int(np.count_nonzero(seen))
                if n <= WIDE:
                    groups[k].append(c)
                    held[k] = ((np.cumsum(seen) - 1)[joint * sizes[c] + codes[:, c]], n, product * sizes[c])
                    break
        else:
            groups.append([c])
            held.append((codes[:, c].astype(np.int64), sizes[c], sizes[c]))
    return groups


def joint_codes(codes: np.ndarray, group: Sequence[int], layout: Layout) -> np.ndarray:
    """One number of a bundle's codes (not numbered through the columns)."""
    out = codes[:, group[0]].astype(np.int64)
    for c in group[1:]:
        out = out * layout.sizes[c] + codes[:, c]
    return out


class Bundles:
    """Groups of columns and the joint codes that occur in each, ascending."""

    def __init__(self, layout: Layout, groups: Sequence[Sequence[int]], known: Sequence[np.ndarray]):
        self.layout, self.groups, self.known = layout, [], []
        for group, joint in zip(groups, known):
            if len(group) > 1 and len(joint) > APART:
                self.groups += [[c] for c in group]
                self.known += [np.arange(layout.sizes[c]) for c in group]
            else:
                self.groups.append(list(group))
                self.known.append(joint)
        self.sizes = [len(k) for k in self.known]
        self.home = {c: b for b, group in enumerate(self.groups) for c in group}
        self.codes: dict[int, np.ndarray] = {}                # a column's code, numbered, by the bundle's number
        place, cell, before = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for group, joint in zip(self.groups, self.known):
            rest = joint
            for c in reversed(group):
                self.codes[c] = layout.starts[c] + rest % layout.sizes[c]
                rest = rest // layout.sizes[c]
                place.append(before + np.arange(len(joint)))
                cell.append(self.codes[c])
            before += len(joint)
        places, cells = np.concatenate(place), np.concatenate(cell)
        order = np.argsort(cells, kind="stable")
        self.place, cells = places[order], cells[order]
        self.heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
        self.cells = cells[self.heads]

    @staticmethod
    def of(codes: np.ndarray, layout: Layout) -> Bundles:
        groups = proposed(codes, layout)
        return Bundles(layout, groups, [_used(joint_codes(codes, g, layout)) for g in groups])

    def packed(self, codes: np.ndarray, kind: type | None = None) -> np.ndarray:
        """The number of every row in every bundle, a bundle's numbers together, in the
        least bytes that hold them if no kind is given."""
        kind = kind or (np.uint16 if max(self.sizes, default=0) <= 1 << 16 else np.int64)
        out = np.empty((len(codes), len(self.groups)), kind, order="F")
        for b, (group, known) in enumerate(zip(self.groups, self.known)):
            out[:, b] = np.searchsorted(known, joint_codes(codes, group, self.layout))
        return out

    def right(self, column: int, cut: int) -> tuple[int, np.ndarray]:
        """A column's bundle, and which of its numbers lie right of a cut (a code of the
        column's own)."""
        return self.home[column], self.codes[column] - self.layout.starts[column] > cut

    def counts(self, packed: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, w: np.ndarray | None) -> np.ndarray:
        """Sums as those of ``histogram``, by the bundles' numbers, end to end."""
        out = np.empty((2 if w is None else 3, nodes, sum(self.sizes)))
        wide, a = max(self.sizes, default=0), 0
        before = node * wide if nodes > 1 else None
        for b, size in enumerate(self.sizes):
            key = packed[:, b] if before is None else packed[:, b] + before
            for k, weight in enumerate((None, g, w)[:len(out)]):
                out[k, :, a:a + size] = np.bincount(key, weight, nodes * wide).reshape(nodes, wide)[:, :size]
            a += size
        return out

    def by_columns(self, counts: np.ndarray) -> np.ndarray:
        """The columns' histogram of ``counts``."""
        out = np.zeros((*counts.shape[:2], self.layout.total))
        if len(self.cells):
            out[:, :, self.cells] = np.add.reduceat(counts[:, :, self.place], self.heads, axis=2)
        return out

    def histogram(self, packed: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, w: np.ndarray | None) -> np.ndarray:
        """``histogram`` of the columns, from the bundles' numbers."""
        return self.by_columns(self.counts(packed, node, nodes, g, w))


def _used(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending."""
    if len(numbers) and 0 <= numbers.min() and numbers.max() < CELLS:
        return np.flatnonzero(np.bincount(numbers))
    return np.unique(numbers)


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) of 64-bit keys and a salt."""
    x = keys.astype(np.uint64)
    for s in salt:
        x = x + np.uint64((s + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1), initial=1.0) for k in range(20)])


def weights(keys: np.ndarray, s: Settings, tree: int) -> np.ndarray:
    """How often each row counts in a tree."""
    if s.bootstrap:
        return np.searchsorted(_POISSON, uniform(keys, s.seed, tree), "right").astype(np.float64)
    if s.row_share >= 1:
        return np.ones(len(keys))
    return (uniform(keys, s.seed, tree) < s.row_share).astype(np.float64)


def _share(of: float | str | None, columns: int) -> int:
    if of is None:
        return columns
    return max(1, int(np.sqrt(columns)) if of == "sqrt" else int(round(float(of) * columns, 9)))


def allowed(s: Settings, tree: int, depth: int, nodes: int, columns: int) -> np.ndarray | None:
    """Columns that each node of a level may split on; None: all."""
    kept = _share(s.tree_columns, columns)
    k = _share(s.node_columns, kept)
    if k == columns:
        return None
    place = np.random.default_rng([s.seed, tree]).permutation(columns) if kept < columns else np.zeros(columns)
    order = place >= kept                        # columns that the tree leaves out come last
    if k == kept:
        return np.broadcast_to(~order, (nodes, columns))
    order = order + np.random.default_rng([s.seed, tree, depth, 1]).random((nodes, columns))
    mask = np.zeros((nodes, columns), bool)
    np.put_along_axis(mask, np.argsort(order, axis=1, kind="stable")[:, :k], True, axis=1)
    return mask


def histogram(codes: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, w: np.ndarray | None, layout: Layout) -> np.ndarray:
    """Sums of rows, gradients and, with weights, Hessians by (node, code): (2 or 3,
    nodes, total). ``g`` is the weighted gradient. A column at a time, so that its cells
    and keys stay in the cache; quickest where a column's codes lie together."""
    out = np.empty((2 if w is None else 3, nodes, layout.total))
    wide = int(layout.sizes.max(initial=1))
    before = node * wide if nodes > 1 else None
    own = nodes * wide > len(codes)              # few rows: cells of a column's own size cost less than its keys
    for c, (a, size) in enumerate(zip(layout.starts.tolist(), layout.sizes.tolist())):
        if own:
            key = node * size + (codes[:, c] - a)
            for k, weight in enumerate((None, g, w)[:len(out)]):
                out[k, :, a:a + size] = np.bincount(key, weight, nodes * size).reshape(nodes, size)
            continue
        key = codes[:, c] if before is None else codes[:, c] + before
        end = a + nodes * wide
        for k, weight in enumerate((None, g, w)[:len(out)]):
            out[k, :, a:a + size] = np.bincount(key, weight, end)[a:end].reshape(nodes, wide)[:, :size]
    return out


@dataclass
class Picked:
    """Per node: column (-1: none), cut code, gain, and sums of rows, gradients, weights."""

    column: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    g: np.ndarray
    h: np.ndarray


def _gain(left: list[np.ndarray], whole: list[np.ndarray], s: Settings, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Gains of cuts with these sums (rows, gradients, Hessians) on their left, -inf where
    a cut isn't allowed, and the scores of the uncut nodes."""
    n, g, h = left
    n_all, g_all, h_all = whole
    right_n, right_h = n_all - n, h_all - h
    fits = (n >= s.min_rows) & (right_n >= max(s.min_rows, 0.5))
    if s.min_weight > 0:
        fits &= (h >= s.min_weight) & (right_h >= s.min_weight)
    if mask is not None:
        fits &= mask
    p = s.leaf_penalty
    with np.errstate(divide="ignore", invalid="ignore"):
        parent = g_all * g_all / (h_all + p)
        right_g = g_all - g
        gain = g * g / (h + p) + right_g * right_g / (right_h + p) - parent
    gain[~fits] = -np.inf
    return gain, parent


def _near(best: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """What counts as the best gain: sums of another order differ in their last digits,
    and ties must not."""
    return best - 1e-9 * np.abs(best) - 1e-12 * parent


def _gains(hist: np.ndarray, layout: Layout, s: Settings, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gains of all cuts of a histogram, the scores of the uncut nodes and their sums."""
    run = hist.cumsum(axis=2)
    before = run[:, :, layout.starts] - hist[:, :, layout.starts]
    left = run - np.repeat(before, layout.sizes, axis=2)
    sums = run[:, :, layout.ends[0] - 1]
    three = (0, 1, -1) if len(hist) == 3 else (0, 1, 0)
    gain, parent = _gain([left[k] for k in three], [sums[k][:, None] for k in three], s,
                         None if mask is None else np.repeat(mask, layout.sizes, axis=1))
    return gain, parent, sums


def _pick_dense(hist: np.ndarray, layout: Layout, s: Settings, mask: np.ndarray | None) -> Picked:
    """``pick`` on the whole histogram. A code without rows ties with the one before it,
    so the first of the best is a code that occurs."""
    gain, parent, sums = _gains(hist, layout, s, mask)
    three = (0, 1, -1) if len(hist) == 3 else (0, 1, 0)
    best = gain.max(axis=1)
    where = (gain >= _near(best, parent[:, 0])[:, None]).argmax(axis=1)
    good = best > LEAST_GAIN
    return Picked(np.where(good, layout.column[where], -1), np.where(good, where, 0), np.where(good, best, 0.0), sums[0], sums[1], sums[three[2]])


def likely(hist: np.ndarray, layout: Layout, s: Settings, mask: np.ndarray | None, most: int) -> list[tuple[int, int]]:
    """Columns and cut codes of the best splits of a single node, the picked one first,
    then by gain."""
    if not layout.total:
        return []
    gain, _, _ = _gains(hist, layout, s, mask)
    first = _pick_dense(hist, layout, s, mask)
    gain = np.where(hist[0, 0] > 0, gain[0], -np.inf)
    gain[first.cut[0]] = np.inf
    order = np.argsort(-gain, kind="stable")[:most]
    return [(int(layout.column[k]), int(k)) for k in order.tolist() if gain[k] > LEAST_GAIN] if first.column[0] >= 0 else []


def pick(hist: np.ndarray, layout: Layout, s: Settings, mask: np.ndarray | None = None) -> Picked:
    """The best split of every node of a histogram. Sparse histograms are searched on
    their used codes alone, so a cut is always a code that occurs in the node."""
    flat = hist.reshape(len(hist), -1)
    some = flat[0] != 0
    if layout.total and 3 * np.count_nonzero(some) > some.size:
        return _pick_dense(hist, layout, s, mask)
    used = np.flatnonzero(some)
    return _pick_used(used, np.stack([f.take(used) for f in flat]), hist.shape[1], layout, s, mask)


def _cells(codes: np.ndarray, node: np.ndarray, g: np.ndarray, w: np.ndarray | None, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells (node * total + code) of a histogram that hold rows, ascending, and their
    sums, by sorting: for levels whose nodes have few rows against their codes. A cell's
    rows keep their order, so the sums are those of ``histogram``."""
    bits = max(1, int(len(node) - 1).bit_length())
    rows, before = np.arange(len(node)), node * total
    packed = np.empty((codes.shape[1], len(node)), np.int64)
    for c, key in enumerate(packed):
        np.add(codes[:, c], before, out=key)
        key <<= bits
        key |= rows
    packed = packed.ravel()
    packed.sort()
    row = packed & ((1 << bits) - 1)
    packed >>= bits
    first = np.ones(len(packed), bool)
    first[1:] = packed[1:] != packed[:-1]
    cell = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    used = packed.take(at)
    sums = [np.diff(at, append=len(packed)).astype(np.float64), np.bincount(cell, g.take(row), len(used))]
    if w is not None:
        sums.append(np.bincount(cell, w.take(row), len(used)))
    return used, np.stack(sums)


def _pick_used(used: np.ndarray, part: np.ndarray, nodes: int, layout: Layout, s: Settings, mask: np.ndarray | None) -> Picked:
    """``pick`` on a histogram's used cells and their sums. Rows are counted first: only
    cuts that leave enough of them on either side are scored."""
    total = layout.total
    heads = np.searchsorted(used, np.arange(nodes + 1) * total)
    node = np.repeat(np.arange(nodes), np.diff(heads))
    code = used - node * total
    column = layout.column.take(code)
    new = np.ones(len(used), bool)
    new[1:] = (column[1:] != column[:-1]) | (node[1:] != node[:-1])
    head, segment = np.flatnonzero(new), np.cumsum(new) - 1
    run = [np.cumsum(p) for p in part]
    before = [(r.take(head) - p.take(head)) for r, p in zip(run, part)]
    first = np.flatnonzero(column == 0)          # every row has a code of the first column
    sums = np.stack([np.bincount(node.take(first), p.take(first), nodes) for p in part])
    three = (0, 1, -1) if len(part) == 3 else (0, 1, 0)
    h = three[2]
    n = run[0] - before[0].take(segment)
    ok = n >= s.min_rows
    ok &= sums[0].take(node) - n >= max(s.min_rows, 0.5)
    if mask is not None:
        ok &= mask[node, column]
    ok = np.flatnonzero(ok)
    node, segment = node.take(ok), segment.take(ok)
    left = [r.take(ok) - x.take(segment) for r, x in zip(run, before)]
    whole = sums.take(node, axis=1)
    gain, _ = _gain([left[k] for k in three], [whole[k] for k in three], s, None)
    with np.errstate(divide="ignore", invalid="ignore"):
        parent = sums[1] ** 2 / (sums[h] + s.leaf_penalty)
    best = np.full(nodes, -np.inf)
    at = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(ok) else ok
    if len(ok):
        best[node.take(at)] = np.maximum.reduceat(gain, at)
    hit = np.flatnonzero(gain >= _near(best, parent).take(node))
    of = node.take(hit)
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else of
    where = np.zeros(nodes, np.int64)
    where[of.take(at)] = ok.take(hit.take(at))
    good = best > LEAST_GAIN
    where[~good] = 0
    return Picked(np.where(good, column.take(where) if len(used) else 0, -1), np.where(good, code.take(where) if len(used) else 0, 0),
                  np.where(good, best, 0.0), sums[0], sums[1], sums[h])


class Sides:
    """A level's histograms in one or two arrays, a node's at its slot."""

    def __init__(self, sides: Sequence[np.ndarray], slot: np.ndarray):
        self.sides, self.slot = sides, slot

    def of(self, nodes: np.ndarray) -> np.ndarray:
        """The histograms of some nodes, in their order."""
        slot, a = self.slot[nodes], 0
        out = np.empty((len(self.sides[0]), len(slot), self.sides[0].shape[2]))
        for side in self.sides:
            own = np.flatnonzero((slot >= a) & (slot < a + side.shape[1]))
            for k in range(len(out)):
                out[k, own] = side[k].take(slot[own] - a, axis=0)
            a += side.shape[1]
        return out


def _pick_sides(sides: Sequence[np.ndarray], slot: np.ndarray, layout: Layout, s: Settings, mask: np.ndarray | None) -> Picked:
    """``pick`` on histograms that stand in two arrays, without putting sparse ones together."""
    nodes, total = len(slot), layout.total
    some = np.concatenate([side[0] != 0 for side in sides]).take(slot, axis=0).ravel()
    if 3 * np.count_nonzero(some) > some.size:
        return _pick_dense(Sides(sides, slot).of(np.arange(nodes)), layout, s, mask)
    used = np.flatnonzero(some)
    node = np.repeat(np.arange(nodes), np.diff(np.searchsorted(used, np.arange(nodes + 1) * total)))
    at = (slot - np.arange(nodes)).take(node) * total + used
    cut = sides[0].shape[1] * total
    low = at < cut
    own = (np.flatnonzero(low), np.flatnonzero(~low))
    part = np.empty((len(sides[0]), len(used)))
    for side, here, base in zip(sides, own, (0, cut)):
        where = at.take(here) - base
        for k in range(len(part)):
            part[k, here] = side[k].ravel().take(where)
    return _pick_used(used, part, nodes, layout, s, mask)


def _count(codes, rows, packed, node, nodes, g, w, layout, bundles) -> np.ndarray:
    """A level's histogram by bundles, or by columns where the bundles' cells are many
    against the rows, and for forests, whose levels it would help little."""
    if w is not None or 2 * nodes * len(bundles.place) > len(rows) * len(layout.sizes):
        return histogram(rows_of(codes, rows), node, nodes, g, w, layout)
    return bundles.histogram(packed, node, nodes, g, w)


def _level(codes, rows, packed, node, nodes, g, w, layout, bundles, s, mask, above=None) -> tuple[Picked, Sides | None]:
    """``pick`` of a level, in stretches of nodes that bound the histogram, and the
    histogram if it was dense. ``rows`` of ``codes`` are counted; ``packed``, ``node``,
    ``g`` and ``w`` are theirs. ``above``: histograms of the nodes' parents in pairs'
    order, overwritten; then only the smaller of two siblings is counted, the other is the
    rest."""
    step = max(1, CELLS // max(1, layout.total))
    few = nodes * layout.total >= 2 * len(rows) * codes.shape[1]      # rows against cells
    if nodes <= step and (above is not None or not few):
        if above is None:
            hist = _count(codes, rows, packed, node, nodes, g, w, layout, bundles)
        else:
            count = np.bincount(node, minlength=nodes)
            small = np.arange(0, nodes, 2) + (count[1::2] < count[::2])
            pair = np.full(nodes, -1)
            pair[small] = np.arange(len(small))
            to = pair[node]
            own = np.flatnonzero(to >= 0)
            part = _count(codes, rows.take(own), rows_of(packed, own), to.take(own), len(small), g.take(own), None if w is None else w.take(own), layout, bundles)
            np.subtract(above, part, out=above)
            sides, slot = (part, above), np.empty(nodes, np.int64)
            slot[small] = np.arange(len(small))
            slot[small ^ 1] = slot[small] + len(small)
            return _pick_sides(sides, slot, layout, s, mask), None if few else Sides(sides, slot)
        return pick(hist, layout, s, mask), None if few else Sides((hist,), np.arange(nodes))
    # at most CELLS // 4 codes at once, whole nodes
    order = np.argsort(node, kind="stable")
    starts = np.searchsorted(node[order], np.arange(nodes + 1))
    most = max(1, CELLS // 4 // max(1, codes.shape[1]))
    parts, lo = [], 0
    while lo < nodes:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + most, "right")) - 1)
        if not few:
            hi = min(hi, lo + step)
        own = order[starts[lo]:starts[hi]]
        at, sums = node[own] - lo, (g[own], None if w is None else w[own])
        part_mask = None if mask is None else mask[lo:hi]
        if few:
            parts.append(_pick_used(*_cells(rows_of(codes, rows[own]), at, *sums, layout.total), hi - lo, layout, s, part_mask))
        else:
            parts.append(pick(_count(codes, rows[own], rows_of(packed, own), at, hi - lo, *sums, layout, bundles), layout, s, part_mask))
        lo = hi
    return Picked(*(np.concatenate([getattr(p, f) for p in parts]) for f in Picked.__dataclass_fields__)), None


def rows_of(codes: np.ndarray | None, rows: np.ndarray) -> np.ndarray | None:
    """Rows of codes whose columns lie together, as such."""
    return None if codes is None else np.take(codes.T, rows, axis=1).T


class Growth:
    """A tree that grows level by level from its nodes' picks."""

    def __init__(self):
        self.column, self.cut, self.left, self.value, self.gain = ([] for _ in range(5))
        self.live = 1                              # nodes of the open level
        self.size = 0                              # nodes of the levels before it

    def close_level(self, p: Picked, s: Settings, split: bool = True) -> np.ndarray:
        """Takes a level's picks; returns per node the level's number of its left child
        (-1: leaf)."""
        column = p.column if split else np.full(self.live, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(p.h + s.leaf_penalty > 0, p.g / (p.h + s.leaf_penalty), 0.0)
        grows = column >= 0
        child = np.where(grows, 2 * (np.cumsum(grows) - 1), -1)
        self.column.append(column)
        self.cut.append(np.where(grows, p.cut, 0))
        self.left.append(np.where(grows, self.size + self.live + child, 0))
        self.value.append(value * (1.0 if s.bootstrap else s.learning_rate))
        self.gain.append(np.where(grows, p.gain, 0.0))
        self.size += self.live
        self.live = 2 * int(grows.sum())
        return child

    def tree(self) -> Tree:
        cat = np.concatenate
        return Tree(cat(self.column).astype(np.int32), cat(self.cut).astype(np.int32), cat(self.left).astype(np.int32),
                    cat(self.value).astype(np.float64), cat(self.gain).astype(np.float64))


def grow(codes: np.ndarray, g: np.ndarray, w: np.ndarray, layout: Layout, s: Settings, tree: int,
         depth: int = 0, bundles: Bundles | None = None, packed: np.ndarray | None = None) -> tuple[Tree, np.ndarray]:
    """A tree and the leaf of every row. Rows of weight 0 are only led to their leaves."""
    growth = Growth()
    plain = not s.bootstrap
    codes = np.asfortranarray(codes)
    if bundles is None and plain:
        bundles = Bundles.of(codes - layout.starts, layout)
        packed = bundles.packed(codes - layout.starts)
    flat = codes.ravel(order="F")
    n = len(codes)
    rows = np.flatnonzero(w > 0)                    # rows of the open level that count
    if len(rows) < n:
        packed = rows_of(packed, rows)
    wg, ww = (g * w)[rows], None if plain else w[rows]
    node = np.zeros(len(rows), np.int64)
    move, at = np.arange(n), np.zeros(n, np.int64)   # all rows of the open level
    leaf = np.zeros(n, np.int64)
    above = None
    while growth.live:
        live = growth.live
        if s.max_depth is not None and depth >= s.max_depth:
            count = np.bincount(node, minlength=live).astype(np.float64)
            none = np.full(live, -1)
            p = Picked(none, none, none, count, np.bincount(node, wg, live), count if plain else np.bincount(node, ww, live))
            hist = None
        else:
            p, hist = _level(codes, rows, packed, node, live, wg, ww, layout, bundles, s, allowed(s, tree, depth, live, len(layout.sizes)), above)
        base = growth.size
        child = growth.close_level(p, s)
        above = None if hist is None else hist.of(np.flatnonzero(p.column >= 0))
        depth += 1
        left = child.take(at)
        if not growth.live or child.min() < 0:       # some rows have come to their leaves
            leaf[move] = base + at
            keep = np.flatnonzero(left >= 0)
            move, at, left = move[keep], at[keep], left[keep]
        at = left + (flat.take((p.column * n).take(at) + move) > p.cut.astype(flat.dtype).take(at))
        if len(move) == n:
            node = at if len(rows) == n else at.take(rows)
            continue
        now = np.full(n, -1)
        now[move] = at
        node = now.take(rows)
        keep = np.flatnonzero(node >= 0)
        if len(keep) < len(rows):
            rows, packed, wg, ww, node = rows[keep], rows_of(packed, keep), wg[keep], None if plain else ww[keep], node[keep]
    return growth.tree(), leaf


def fit(codes: np.ndarray, y: np.ndarray, keys: np.ndarray, train: np.ndarray, layout: Layout, s: Settings,
        first: int = 0, last: int | None = None) -> tuple[list[Tree], float, np.ndarray]:
    """Trees ``first`` to ``last`` of an ensemble, its start, and the sum of start and
    trees for every row (for a forest the sum of these trees' values)."""
    base = 0.0 if s.bootstrap else float(y[train].mean()) if train.any() else 0.0
    score = np.full(len(y), base)
    bundles = None if s.bootstrap else Bundles.of(codes, layout)
    packed = None if s.bootstrap else bundles.packed(codes)
    kind = np.int16 if layout.total < 1 << 15 else np.int32
    codes = np.asfortranarray(codes.astype(kind) + layout.starts.astype(kind))
    made = []
    for t in range(first, s.rounds if last is None else last):
        w = np.where(train, weights(keys, s, t), 0.0)
        tree, leaf = grow(codes, y if s.bootstrap else y - score, w, layout, s, t, 0, bundles, packed)
        made.append(tree)
        score += tree.value.take(leaf)
    return made, base, score


def leaves(codes: np.ndarray, tree: Tree) -> np.ndarray:
    """Leaf of every row of numbered codes."""
    n = len(codes)
    at = np.zeros(n, np.int64)
    if len(tree.column) <= SMALL_TREE and n:         # all rows go down together; a leaf leads to itself
        inner = tree.column >= 0
        flat, rows = codes.ravel(order="F"), np.arange(n)
        column = np.where(inner, tree.column, 0).astype(np.int64) * n
        cut = np.where(inner, tree.cut, np.iinfo(np.int32).max)
        left = np.where(inner, tree.left, np.arange(len(inner)))
        while True:
            to = left.take(at) + (flat.take(column.take(at) + rows) > cut.take(at))
            if not inner.take(to).any():
                return to
            at = to
    open_ = np.arange(n)
    while len(open_):
        node = at[open_]
        inner = tree.column[node] >= 0
        open_, node = open_[inner], node[inner]
        at[open_] = tree.left[node] + (codes[open_, tree.column[node]] > tree.cut[node])
    return at


class Steps:
    """A tree's splits by the numbers of bundles. ``columns``: of the bundles' layout, those
    of the tree; ``starts``: the tree's first code of each."""

    def __init__(self, bundles: Bundles, tree: Tree, columns: Sequence[int], starts: np.ndarray):
        inner = tree.column >= 0
        self.value, self.left = tree.value, np.where(inner, tree.left, np.arange(len(inner)))
        self.inner, self.wide = inner, max(bundles.sizes, default=1)
        self.home = np.zeros(len(inner), np.int64)
        self.right = np.zeros((len(inner), self.wide), bool)
        for j in np.flatnonzero(inner).tolist():
            self.home[j], right = bundles.right(columns[tree.column[j]], tree.cut[j] - starts[tree.column[j]])
            self.right[j, :len(right)] = right

    def leaves(self, packed: np.ndarray) -> np.ndarray:
        n = len(packed)
        at = np.zeros(n, np.int64)
        if not n or not self.inner.any():
            return at
        flat, rows, right = packed.ravel(order="F"), np.arange(n), self.right.ravel()
        at = self.left[0] + self.right[0].take(packed[:, self.home[0]])
        home, base = self.home * n, np.arange(len(self.left)) * self.wide
        while self.inner.take(at).any():
            at = self.left.take(at) + right.take(base.take(at) + flat.take(home.take(at) + rows))
        return at


def bin_codes(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value of a matrix: the number of edges below it (a value on an edge
    lies below it). Missing values take the last bin."""
    out = np.empty(values.shape, np.uint8)
    for c, e in enumerate(edges):
        out[:, c] = np.searchsorted(e, values[:, c], "left")
    return out
