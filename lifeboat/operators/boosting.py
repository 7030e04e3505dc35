"""Gradient boosting on binned features: second-order or least-squares splits, several models in step.

Features are binned once and staged with the rows as packed blocks, which the executors hold while they are boosted
(``operators.together``). A level of a tree is one small job: each task adds up gradient, Hessian and row counts by (model, node, feature, bin) for
its blocks, and the sums (models x nodes x columns x bins numbers, whatever the number of rows) decide the splits on
the driver. Rows keep their margins beside them: every ``restage`` rounds they are held anew with the trees since then
added, so round n + 1 starts from round n; a lost executor reads its blocks again and adds the trees.

Gradients are rounded to a fixed point before they are summed, so sums are exact in 64 bits (up to 2^31 rows a sum), and the
same rows give the same trees on any partitioning. Rows of a tree are drawn by a hash of the row's key and the round, columns by the round.

Two kinds of model share the engine:
``newton``: gain and leaf values with an L2 term and a least Hessian sum per child (the regularised booster);
``friedman``: least-squares splits on residuals, one Newton step per leaf, least rows to split a node and per leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.operators.layout import stage
from lifeboat.operators.together import added, held

#: Fixed point of gradients and Hessians.
_POINT = float(1 << 31)
#: Bytes of packed rows per partition of the staged blocks.
BLOCK_BYTES = 8_000_000
#: Rows of a block, so that blocks are dealt evenly.
BLOCK_ROWS = 2_048
#: Rows whose gradients add up exactly in 53 bits.
_EXACT_ROWS = 1 << 22
_U = np.uint64


@dataclass(frozen=True)
class Booster:
    """What one model is fitted with; ``fold``: rows of that fold are its validation rows (-1: none)."""

    rounds: int = 600
    step: float = 0.03
    depth: int = 3
    subsample: float = 0.9
    columns: float = 0.8            # share of the columns drawn per tree, one at least
    kind: str = "newton"
    lam: float = 1.0                # L2 term of gains and leaves (newton)
    min_child: float = 1.0          # least Hessian sum of a child (newton)
    min_split: int = 2              # least rows of a node that is split (friedman)
    min_leaf: int = 1               # least rows of a child (friedman)
    prior: bool = False             # start from the log-odds of the labels, else from 0
    patience: int = 0               # rounds without a lower validation loss before it stops; 0: never
    fold: int = -1
    seed: int = 0


@dataclass
class Boosted:
    """Trees over raw feature values: nodes in heap order, feature -1 at leaves, values below ``cut`` or equal go left."""

    base: float
    trees: list[dict] = field(default_factory=list)         # feature, cut, value: lists over nodes
    history: list[tuple[int, str, float, float]] = field(default_factory=list)   # (round, train or val, log-loss, accuracy in %)
    fitted: int = 0                                         # rounds that were run

    def margins(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees[:rounds]:
            out += tree_values(t, lambda f: x[:, f], len(x), "cut")
        return out


def tree_values(tree: dict, column, n: int, cut: str) -> np.ndarray:
    """The value each of ``n`` rows gets; ``column(f)`` has feature f, compared with ``tree[cut]``."""
    feature, cuts, value = (np.asarray(tree[k]) for k in ("feature", cut, "value"))
    node, at = np.zeros(n, np.int64), np.arange(n)
    while len(at):
        f = feature[node[at]]
        at, f = at[f >= 0], f[f >= 0]
        if not len(at):
            break
        for k in np.unique(f).tolist():
            mine = at[f == k]
            node[mine] = 2 * node[mine] + 1 + (column(k)[mine] > cuts[node[mine]])
    return value[node]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def drawn(key: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """Rows that tree ``number`` sees: the same whatever partition they are in."""
    if share >= 1:
        return np.ones(len(key), bool)
    salt = _mix(np.array([(seed * 0x9E3779B97F4A7C15 + number) % (1 << 64)], np.uint64))[0]
    return _mix(key ^ salt) < _U(int(share * 2.0 ** 64))


def drawn_columns(d: int, seed: int, number: int, share: float) -> list[int]:
    k = max(1, int(share * d))
    return sorted(np.random.default_rng([seed, number]).permutation(d)[:k].tolist()) if k < d else list(range(d))


def feature_cuts(rows: DataFrame, d: int, max_bins: int = 256) -> list[list[float]]:
    """Per feature the values that part bins, ascending: midpoints of the distinct values where they are few, quantiles otherwise."""
    x = rows.select(vector_to_array("features").alias("x"))
    part = x.select([F.get("x", F.lit(j)).alias(f"x{j}") for j in range(d)])
    counts = part.agg(*[F.approx_count_distinct(c).alias(c) for c in part.columns]).first()
    few = [c for c in part.columns if counts[c] <= 1.2 * max_bins]
    known: dict[str, list[float]] = {}
    if few:
        pairs = part.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few])).alias("p")).select("p.c", "p.v").distinct()
        for r in pairs.groupBy("c").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("v")).alias("v")).collect():  # some hundred values each
            if r["n"] <= max_bins:
                known[r["c"]] = [(a + b) / 2 for a, b in zip(r["v"], r["v"][1:])]
    many = [c for c in part.columns if c not in known]
    if many:
        shares = [(i + 1) / max_bins for i in range(max_bins - 1)]
        got = part.agg(*[F.percentile_approx(c, shares, 50_000).alias(c) for c in many]).first()
        known.update({c: sorted(set(got[c] or [])) for c in many})
    return [known[f"x{j}"] for j in range(d)]


def pack(rows: DataFrame, cuts: list[list[float]], models: int, fold: Column | None = None) -> DataFrame:
    """Staged blocks of (n, key, y, fold, bins) of ``rows`` (id, label, features), which ``models`` will keep margins for."""
    d = len(cuts)
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(at, BLOCK_ROWS) for at in range(0, whole.num_rows, BLOCK_ROWS)):
                n = b.num_rows
                x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, d)
                bins = np.stack([np.searchsorted(e, np.where(np.isnan(x[:, j]), -np.inf, x[:, j]), side="left") for j, e in enumerate(edges)], 1)
                cols = [b.column(0).to_numpy().tobytes(), b.column(1).to_numpy().astype(np.float64).tobytes(), b.column(2).to_numpy().astype(np.int32).tobytes(),
                        bins.astype(np.uint16).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *(pa.array([c], pa.binary()) for c in cols)], BLOCK_NAMES)

    size = rows.count()
    parts = max(1, -(-size * (24 + 2 * d + 8 * models) // BLOCK_BYTES))     # by the rows' bytes, not by the cluster
    own = rows.select(F.xxhash64("id").alias("key"), F.col("label").cast("double").alias("y"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
                      vector_to_array("features").alias("x"))
    return stage(own.repartition(parts, "key").sortWithinPartitions("key", "y").mapInArrow(run, BLOCK), "boost-blocks")


BLOCK = "n long, key binary, y binary, fold binary, bins binary"
BLOCK_NAMES = [c.split()[0] for c in BLOCK.split(", ")]


class _Rows:
    """Some blocks' rows with their margins under each model."""

    def __init__(self, blocks: list, d: int, models: int):
        join = lambda c, t: np.concatenate([np.frombuffer(b[c], t) for b in blocks])
        self.key, self.y, self.fold = join("key", np.uint64), join("y", np.float64), join("fold", np.int32)
        self.n, self.bins = len(self.key), join("bins", np.uint16).reshape(-1, d)
        self.margins = np.zeros((models, self.n))

    def add(self, late: list[list[dict]]) -> _Rows:
        """The rows with the values of some more trees of each model."""
        self.margins = self.margins.copy()
        for m, trees in enumerate(late):
            for t in trees:
                self.margins[m] += tree_values(t, lambda f: self.bins[:, f], self.n, "bin")
        return self


def _rows_of(blocks: Iterator, d: int, models: int) -> Iterator[_Rows]:
    """All rows of a task, in pieces whose sums are exact in floating point."""
    got, n = [], 0
    for b in blocks:
        if n + b["n"] > _EXACT_ROWS:
            yield _Rows(got, d, models)
            got, n = [], 0
        got.append(b)
        n += b["n"]
    if got:
        yield _Rows(got, d, models)


def _log_loss(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, margin) - y * margin


def level_sums(rows: RDD, specs: list[Booster], bases: list[float], late: list[list[dict]], open_: dict[int, dict], number: int, level: int,
               columns: dict[int, list[int]], n_bins: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """(sums, losses): per open model an array [node, column, bin, (g, h, rows)]; per model [train or val, (loss, hits, rows)] of the trees so far.

    ``open_`` has the tree that grows of each model; its nodes of ``level`` are summed. ``late``: the trees that margins do not have yet.
    """
    first, width, k = (1 << level) - 1, 1 << level, len(specs)

    def work(rows: _Rows) -> list[np.ndarray]:
        rows.add(late)
        sums, losses = [], np.zeros((k, 2, 3))
        for m, tree in open_.items():
            s, margin = specs[m], rows.margins[m] + bases[m]
            out_of_fold = rows.fold == s.fold
            if level == 0:
                loss, hit = _log_loss(rows.y, margin), (margin > 0) == (rows.y > 0.5)
                for side, own in enumerate((~out_of_fold, out_of_fold)):
                    losses[m, side] = loss[own].sum(), hit[own].sum(), own.sum()
            seen = np.flatnonzero(~out_of_fold & drawn(rows.key, s.seed, number, s.subsample))
            node = np.zeros(len(seen), np.int64)
            feature, cut = np.asarray(tree["feature"]), np.asarray(tree["bin"])
            for _ in range(level):
                f = feature[node]
                if (f < 0).any():
                    seen, node, f = seen[f >= 0], node[f >= 0], f[f >= 0]
                node = 2 * node + 1 + (rows.bins[seen, f] > cut[node])
            p = 1 / (1 + np.exp(-margin[seen]))
            g, h = np.rint((p - rows.y[seen]) * _POINT), np.rint(p * (1 - p) * _POINT)
            own = np.zeros((width, len(columns[m]), n_bins, 3), np.int64)
            for c, f in enumerate(columns[m]):
                at = (node - first) * n_bins + rows.bins[seen, f]
                for q, w in enumerate((g, h, None)):
                    own[:, c, :, q] = np.bincount(at, w, width * n_bins).astype(np.int64).reshape(width, n_bins)
            sums.append(own)
        return [*sums, losses]

    got = added(rows, work)
    if not got:
        return {m: np.zeros((width, len(columns[m]), n_bins, 3), np.int64) for m in open_}, np.zeros((k, 2, 3))
    return dict(zip(open_, got)), got[-1]


def split_gains(sums: np.ndarray, s: Booster, n_cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(gain of each node, column and cut, -inf where it is not allowed; totals of each node). ``n_cuts``: cuts of each column, beyond which bins are empty."""
    left = sums.cumsum(2)
    whole = left[:, :, -1:, :]
    right = whole - left
    gl, hl, nl = (left[..., i] / (_POINT if i < 2 else 1) for i in range(3))
    gr, hr, nr = (right[..., i] / (_POINT if i < 2 else 1) for i in range(3))
    g, h, n = (whole[..., i] / (_POINT if i < 2 else 1) for i in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        if s.kind == "newton":
            gain = gl ** 2 / (hl + s.lam) + gr ** 2 / (hr + s.lam) - g ** 2 / (h + s.lam)
            ok = (hl >= s.min_child) & (hr >= s.min_child)
        else:
            gain = nl * nr / np.maximum(n, 1) * (gl / nl - gr / nr) ** 2
            ok = (nl >= s.min_leaf) & (nr >= s.min_leaf) & (n >= s.min_split)
    ok &= (nl > 0) & (nr > 0) & (np.arange(sums.shape[2])[None, None, :] < np.array(n_cuts)[None, :, None])
    return np.where(ok, np.round(gain, 12), -np.inf), whole[:, 0, 0, :]


def best_splits(sums: np.ndarray, s: Booster, n_cuts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(column, bin, gain, totals) of the best split of each node: gain 0 or less is none; of equal gains the first column and the lowest bin."""
    gain, total = split_gains(sums, s, n_cuts)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1)
    return at // sums.shape[2], at % sums.shape[2], flat[np.arange(len(at)), at], total


def root_splits(rows: DataFrame, s: Booster = Booster(subsample=1.0, columns=1.0), max_bins: int = 1 << 14) -> DataFrame:
    """(feature, cut, gain) of every split that a model's first root may choose from."""
    d = rows.select(F.size(vector_to_array("features"))).first()[0]
    cuts = feature_cuts(rows, d, max_bins)
    packed = held(pack(rows, cuts, 1)).mapPartitions(lambda it: _rows_of(it, d, 1))
    sums, _ = level_sums(packed, [s], [0.0], [[]], {0: _new(1)}, 0, 0, {0: list(range(d))}, max(map(len, cuts)) + 1)
    gain, _ = split_gains(sums[0], s, [len(c) for c in cuts])
    found = [(f, round(c, 6), round(float(gain[0, f, b]), 6)) for f, own in enumerate(cuts) for b, c in enumerate(own) if np.isfinite(gain[0, f, b])]
    return rows.sparkSession.createDataFrame(found, "feature int, cut double, gain double")


def _leaf(total: np.ndarray, s: Booster) -> float:
    g, h = total[0] / _POINT, total[1] / _POINT
    low = h + (s.lam if s.kind == "newton" else 0.0)
    return 0.0 if low < 1e-150 else float(-s.step * g / low)


def boost(blocks: DataFrame, cuts: list[list[float]], specs: list[Booster], restage: int = 10) -> list[Boosted]:
    """Fit all ``specs`` in step over the same blocks; a model that stops early leaves the step."""
    d, n_bins = len(cuts), max(len(c) for c in cuts) + 1
    bases, out = [0.0] * len(specs), []
    if any(s.prior for s in specs):
        counts = _label_counts(blocks, specs)
        bases = [float(np.log(max(pos, 1e-9) / max(n - pos, 1e-9))) if s.prior else 0.0 for s, (pos, n) in zip(specs, counts, strict=True)]
    out = [Boosted(b) for b in bases]
    best = [(float("inf"), 0)] * len(specs)                 # (validation loss, rounds) so far
    running, number = set(range(len(specs))), 0
    packed = held(blocks).mapPartitions(lambda it: _rows_of(it, d, len(specs))).persist(StorageLevel.MEMORY_AND_DISK)
    rows, late = packed, [[] for _ in specs]

    def note(m: int, losses: np.ndarray, rounds: int) -> bool:
        """Record the losses after ``rounds`` rounds; has the model run out of patience?"""
        for side, name in enumerate(("train", "val")):
            loss, hits, n = losses[m, side]
            if n and rounds:
                out[m].history.append((rounds, name, float(loss / n), float(100 * hits / n)))
        loss, _, n = losses[m, 1]
        if rounds and n and loss / n < best[m][0]:
            best[m] = (loss / n, rounds)
        return bool(specs[m].patience) and rounds - best[m][1] >= specs[m].patience

    while running:
        trees = {m: _new(specs[m].depth) for m in sorted(running)}
        columns = {m: drawn_columns(d, specs[m].seed, number, specs[m].columns) for m in trees}
        for level in range(max(specs[m].depth for m in trees)):
            grow = {m: t for m, t in trees.items() if level < specs[m].depth and (not level or t["open"])}
            if not grow:
                break
            sums, losses = level_sums(rows, specs, bases, late, grow, number, level, columns, n_bins)
            if level == 0:
                for m in list(trees):
                    if note(m, losses, number) or number >= specs[m].rounds:
                        running.discard(m)
                        del trees[m], grow[m]
            for m in grow:
                _split(trees[m], sums[m], specs[m], columns[m], cuts, level)
        for m, t in trees.items():
            t.pop("open")
            out[m].trees.append(t)
            late[m].append(t)
            out[m].fitted = number + 1
        number += 1
        if running and number % restage == 0:
            if rows is not packed:
                rows.unpersist()
            rows = packed.map(lambda r, trees=[list(o.trees) for o in out]: r.add(trees)).persist(StorageLevel.MEMORY_AND_DISK)
            late = [[] for _ in specs]
    rows.unpersist()
    packed.unpersist()
    for m, s in enumerate(specs):
        if s.patience:
            out[m].trees = out[m].trees[:best[m][1]]        # the prefix with the lowest loss is cut out of the ensemble
    return out


def _new(depth: int) -> dict:
    n = (2 << depth) - 1
    return {"feature": [-1] * n, "bin": [0] * n, "cut": [0.0] * n, "value": [0.0] * n, "open": [0]}


def _split(tree: dict, sums: np.ndarray, s: Booster, columns: list[int], cuts: list[list[float]], level: int) -> None:
    """Split the open nodes of a level, or make them leaves; their children get their values at once."""
    col, cut, gain, total = best_splits(sums, s, [len(cuts[f]) for f in columns])
    first, nxt = (1 << level) - 1, []
    for node in tree["open"]:
        i = node - first
        tree["value"][node] = _leaf(total[i], s)
        if not gain[i] > 1e-9:
            continue
        f, b = columns[col[i]], int(cut[i])
        tree["feature"][node], tree["bin"][node], tree["cut"][node] = f, b, float(cuts[f][b])
        left = sums[i, col[i], :b + 1].sum(0)
        tree["value"][2 * node + 1], tree["value"][2 * node + 2] = _leaf(left, s), _leaf(total[i] - left, s)
        nxt += [2 * node + 1, 2 * node + 2]
    tree["open"] = nxt


def _label_counts(blocks: DataFrame, specs: list[Booster]) -> list[tuple[float, int]]:
    """(positive, all) training rows of each model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for r in range(b.num_rows):
                y, fold = np.frombuffer(b.column(0)[r].as_buffer()), np.frombuffer(b.column(1)[r].as_buffer(), np.int32)
                for f in np.unique(fold).tolist():
                    got[f] = got.get(f, 0) + np.array([(y[fold == f] > 0.5).sum(), (fold == f).sum()])
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([int(x[0]) for x in got.values()], pa.int64()),
                                          pa.array([int(x[1]) for x in got.values()], pa.int64())], ["fold", "pos", "n"])

    rows = blocks.select("y", "fold").mapInArrow(run, "fold int, pos long, n long").groupBy("fold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).collect()
    return [(sum(r["pos"] for r in rows if r["fold"] != s.fold), sum(r["n"] for r in rows if r["fold"] != s.fold)) for s in specs]


# --- all rows in a task --------------------------------------------------------------------

#: Bytes of packed rows that a task may hold whole; beyond them the rows of a fit are dealt to tasks (``boost``).
WHOLE_BYTES = 64 * 1024 * 1024
#: Tasks for each that runs at once, so that long fits do not come last.
_WAVES = 3


class _Whole:
    """All rows of a fit as groups with equal bins, which have the same margin under every model.

    A round asks for the rows of each label, fold and group that its tree sees; the row's own hash decides, as in ``boost``.
    """

    def __init__(self, key: np.ndarray, y: np.ndarray, fold: np.ndarray, bins: np.ndarray, n_bins: int):
        code = np.zeros(len(key), np.int64)
        for f in range(bins.shape[1]):
            code = code * n_bins + bins[:, f]
            code = np.unique(code, return_inverse=True)[1] if code.size and code.max() > 1 << 40 else code
        _, first, group = np.unique(code, return_index=True, return_inverse=True)
        self.key, self.bins = key, bins[first].astype(np.int32)
        self.flat, self.start = self.bins.ravel(), np.arange(len(first)) * bins.shape[1]
        self.folds, place = np.unique(fold, return_inverse=True)
        self.shape = (len(self.folds), len(first), 2)
        self.slot = (place * len(first) + group) * 2 + (y > 0.5)
        self.all = self._counts(self.slot)

    def _counts(self, slot: np.ndarray) -> np.ndarray:
        return np.bincount(slot, minlength=int(np.prod(self.shape))).reshape(self.shape).astype(np.float64)

    def seen(self, s: Booster, number: int) -> np.ndarray:
        """Rows by fold, group and label that tree ``number`` draws."""
        return self.all if s.subsample >= 1 else self._counts(self.slot[drawn(self.key, s.seed, number, s.subsample)])

    def sides(self, counts: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by group and label outside of the fold, and in it."""
        inside = counts[self.folds == fold].sum(0)
        return counts.sum(0) - inside, inside

    def values(self, tree: dict, depth: int) -> np.ndarray:
        """The value of a tree for each group."""
        feature, cut, value = (np.array(tree[k]) for k in ("feature", "bin", "value"))
        for i in range((1 << depth) - 1):                   # below a leaf all rows go left to its value
            if feature[i] < 0:
                feature[i], cut[i], value[2 * i + 1], feature[2 * i + 1] = 0, 1 << 30, value[i], -1
        node = np.zeros(len(self.start), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (self.flat[self.start + feature[node]] > cut[node])
        return value[node]


@dataclass
class _Path:
    """Models whose trees have been the same so far."""

    members: list[int]
    margins: np.ndarray
    trees: list[dict]
    history: list[tuple[int, str, float, float]]


def _told(rows: _Whole, fold: int, margin: np.ndarray) -> list[tuple[str, float, float]]:
    """(train or val, log-loss, accuracy in %) of margins."""
    out = []
    for side, n in zip(("train", "val"), rows.sides(rows.all, fold), strict=True):
        if total := n.sum():
            loss = sum((_log_loss(np.float64(y), margin) * n[:, y]).sum() for y in (0, 1))
            hits = np.where(margin > 0, n[:, 1], n[:, 0]).sum()
            out.append((side, float(loss / total), float(100 * hits / total)))
    return out


def _friedman_gains(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain of each node, column and cut, rows on the left, rows on the right, rows of each node) as in ``split_gains``, before any rule on rows; ``sums``: gradients, rows."""
    left = sums.cumsum(2)
    right = left[:, :, -1:, :] - left
    nl, nr, n = left[..., 1], right[..., 1], left[:, :1, -1:, 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = nl * nr / np.maximum(n, 1) * (left[..., 0] / _POINT / nl - right[..., 0] / _POINT / nr) ** 2
    return np.where((nl > 0) & (nr > 0), np.round(gain, 12), -np.inf), nl, nr, n


def _chosen(gain: np.ndarray, nl: np.ndarray, nr: np.ndarray, n: np.ndarray, min_split: int, min_leaf: int) -> tuple[tuple[int, int], ...]:
    """(column, bin) of the best split of each node that keeps the rules, (-1, 0) where there is none."""
    if min_leaf > 1 or min_split > 2:
        gain = np.where((nl >= min_leaf) & (nr >= min_leaf) & (n >= min_split), gain, -np.inf)
    flat, bins = gain.reshape(len(gain), -1), gain.shape[2]
    return tuple((i // bins, i % bins) if flat[k, i] > 1e-9 else (-1, 0) for k, i in enumerate(flat.argmax(1).tolist()))


def _grown(rows: _Whole, specs: list[Booster], members: list[int], margin: np.ndarray, n: np.ndarray, columns: list[int], cuts: list[list[float]],
           n_bins: int) -> list[tuple[list[int], dict]]:
    """The next tree of models that agree so far, by the models that agree on it; they may differ in what may be split only."""
    s = specs[members[0]]
    at = np.flatnonzero(n.any(1))
    p = 1 / (1 + np.exp(-margin[at]))
    neg, pos = n[at, 0], n[at, 1]
    g = pos * np.rint((p - 1) * _POINT) + neg * np.rint(p * _POINT)
    count = neg + pos
    h = count * np.rint(p * (1 - p) * _POINT)
    binned, start = {f: rows.bins[at, f] for f in columns}, rows.start[at]
    root = _new(s.depth)
    root["value"][0] = _leaf((g.sum(), h.sum()), s)
    done, work = [], [(members, root, 0, np.zeros(len(at), np.int64), np.arange(len(at)))]
    while work:
        own, tree, level, node, alive = work.pop()
        if level == s.depth or (level and not tree["open"]):
            tree.pop("open")
            done.append((own, tree))
            continue
        first, width, whole = (1 << level) - 1, 1 << level, len(alive) == len(at)
        of = lambda x: x if whole else x[alive]
        parts = (of(g), of(count)) if s.kind == "friedman" else (of(g), of(h), of(count))
        sums = np.empty((len(parts), len(columns), width * n_bins))
        for c, f in enumerate(columns):
            place = of(binned[f]) + (node - first) * n_bins
            for q, w in enumerate(parts):
                sums[q, c] = np.bincount(place, w, width * n_bins)
        sums = sums.reshape(len(parts), len(columns), width, n_bins).transpose(2, 1, 3, 0)
        ways: list[tuple[list[int], dict]] = []
        if s.kind == "friedman":
            gain = _friedman_gains(sums[[i - first for i in tree["open"]]])
            by_rule: dict[tuple, list[int]] = {}
            for m in own:
                by_rule.setdefault((specs[m].min_split, specs[m].min_leaf), []).append(m)
            by_way: dict[tuple, list[int]] = {}
            for rule, same in by_rule.items():
                by_way.setdefault(_chosen(*gain, *rule), []).extend(same)
            for splits, same in by_way.items():
                t = {k: list(v) for k, v in tree.items()}
                t["open"] = []
                for i, (c, cut) in zip(tree["open"], splits, strict=True):
                    if c >= 0:
                        t["feature"][i], t["bin"][i], t["cut"][i] = columns[c], cut, float(cuts[columns[c]][cut])
                        t["open"] += [2 * i + 1, 2 * i + 2]
                ways.append((same, t))
        else:
            t = {k: list(v) for k, v in tree.items()}
            _split(t, sums.astype(np.int64), s, columns, cuts, level)
            ways.append((own, t))
        for same, t in ways:
            feature, cut = np.asarray(t["feature"]), np.asarray(t["bin"])
            f = feature[node]
            rest, down = alive, node
            if (f < 0).any():
                on = np.flatnonzero(f >= 0)
                rest, down, f = alive[on], node[on], f[on]
            below = 2 * down + 1 + (rows.flat[(start if len(rest) == len(at) else start[rest]) + f] > cut[down])
            if s.kind == "friedman":
                own_rows = lambda x, rest=rest: x if len(rest) == len(at) else x[rest]
                total = [np.bincount(below - 2 * first - 1, own_rows(x), 2 * width) for x in (g, h)]
                for i in t["open"]:
                    t["value"][i] = _leaf((total[0][i - 2 * first - 1], total[1][i - 2 * first - 1]), s)
            work.append((same, t, level + 1, below, rest))
    return done


def _boost_whole(rows: _Whole, cuts: list[list[float]], specs: list[Booster], at: frozenset[int] | None) -> list[Boosted]:
    """``boost`` over rows that one task holds. ``at``: numbers of rounds after which losses are noted, None: every one."""
    n_bins, out = max(len(c) for c in cuts) + 1, [Boosted(0.0) for _ in specs]
    paths: list[_Path] = []
    start: dict[Booster, list[int]] = {}
    for m, s in enumerate(specs):
        if s.prior:
            neg, pos = rows.sides(rows.all, s.fold)[0].sum(0)
            out[m].base = float(np.log(max(pos, 1e-9) / max(neg, 1e-9)))
        alike = replace(s, rounds=0, min_split=0, min_leaf=0) if s.kind == "friedman" and not s.patience else replace(s, rounds=-1 - m)
        start.setdefault(alike, []).append(m)
    paths = [_Path(ms, np.zeros(len(rows.start)), [], []) for ms in start.values()]
    best, number = {}, 0
    while paths:
        counts: dict[tuple, np.ndarray] = {}
        following: list[_Path] = []
        for path in paths:
            s, base = specs[path.members[0]], out[path.members[0]].base
            margin = path.margins + base
            if number and (s.patience or at is None or number in at):
                told = _told(rows, s.fold, margin)
                path.history = path.history + [(number, *t) for t in told]
                loss = next((t[1] for t in told if t[0] == "val"), None)
                if loss is not None and loss < best.get(path.members[0], (float("inf"), 0))[0]:
                    best[path.members[0]] = loss, number
            tired = bool(s.patience) and number - best.get(path.members[0], (0, 0))[1] >= s.patience
            for m in path.members:
                if tired or number >= specs[m].rounds:
                    out[m].trees, out[m].history, out[m].fitted = list(path.trees), list(path.history), number
            path.members = [m for m in path.members if not (tired or number >= specs[m].rounds)]
            if not path.members:
                continue
            drawn_by = (s.seed, s.subsample)
            if drawn_by not in counts:
                counts[drawn_by] = rows.seen(s, number)
            n = rows.sides(counts[drawn_by], s.fold)[0]
            columns = drawn_columns(len(cuts), s.seed, number, s.columns)
            for same, tree in _grown(rows, specs, path.members, margin, n, columns, cuts, n_bins):
                following.append(_Path(same, path.margins + rows.values(tree, s.depth), [*path.trees, tree], path.history))
        paths, number = following, number + 1
    for m, s in enumerate(specs):
        if s.patience:
            out[m].trees = out[m].trees[:best.get(m, (0, 0))[1]]
    return out


def fit(blocks: DataFrame, cuts: list[list[float]], specs: list[Booster], at: set[int] | None = None, trees: bool = True, in_step: int = 24) -> list[Boosted]:
    """The models of ``boost``, each fitted as a whole by a task that holds all rows, while they are few enough; the models are dealt to tasks.

    There is no job for a level or a round then. More rows than ``WHOLE_BYTES`` are dealt to tasks, ``in_step`` models at a time.
    ``at``: numbers of rounds after which losses are asked for (None: all); ``trees``: are the trees asked for?
    """
    d = len(cuts)
    n = blocks.agg(F.sum("n")).first()[0] or 0
    if n * (20 + 2 * d) > WHOLE_BYTES or n > _EXACT_ROWS:
        return [m for i in range(0, len(specs), in_step) for m in boost(blocks, cuts, specs[i:i + in_step])]
    sc = blocks.sparkSession.sparkContext
    packed = blocks.select("key", "y", "fold", "bins").toArrow()        # WHOLE_BYTES at most
    join = lambda c, t: np.concatenate([np.empty(0, t), *(np.frombuffer(x.as_buffer(), t) for x in packed.column(c))])
    key, y, fold, bins = join("key", np.uint64), join("y", np.float64), join("fold", np.int32), join("bins", np.uint16).reshape(-1, d)
    held_by_all = sc.broadcast((key, y > 0.5, fold.astype(np.int16), bins))
    # Models that may share trees go to the same task, and those that draw the same rows beside each other.
    kin: dict[tuple, list[int]] = {}
    for m, s in enumerate(specs):
        kin.setdefault((s.subsample, s.seed, s.step, s.fold, s.depth, s.kind), []).append(m)
    families = [kin[k] for k in sorted(kin)]
    each = max(1, len(families) // (_WAVES * sc.defaultParallelism))
    parts = [[m for f in families[i:i + each] for m in f] for i in range(0, len(families), each)]
    asked = None if at is None else frozenset(at)
    n_bins = max(map(len, cuts)) + 1

    def run(own: list[int]) -> list[tuple]:
        rows = _Whole(*held_by_all.value, n_bins)
        return [(m, b.base, b.trees if trees else [], b.history, b.fitted) for m, b in zip(own, _boost_whole(rows, cuts, [specs[m] for m in own], asked), strict=True)]

    got = {m: Boosted(*b) for done in sc.parallelize(parts, len(parts)).map(run).collect() for m, *b in done}
    held_by_all.destroy()
    return [got[m] for m in range(len(specs))]


def score(model: Boosted, df: DataFrame) -> DataFrame:
    """(id, label if there is one, prediction, p1) of ``df`` (id, features)."""
    label = ["label"] if "label" in df.columns else []
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ["id", *label])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(b.num_columns - 1)
            n = b.num_rows
            m = model.margins(x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)) if n else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array((m > 0).astype(np.int32)), pa.array(1 / (1 + np.exp(-m)))],
                                             ["id", *label, "prediction", "p1"])

    return df.select("id", *label, vector_to_array("features").alias("x")).mapInArrow(run, f"{kinds}, prediction int, p1 double")
