"""Hard-negative mining over vectors with a multiway hyperplane tree.

Every node of the tree has split points; a row belongs to the nearest of them, and each split point keeps the least and
the greatest distance to the rows of every sibling subtree. Scores are inner products of integer vectors. With one more
component, which lifts every row to the same norm, a row's distance to an anchor falls as its score rises, so a window
of scores is an annulus around the anchor. A subtree is left out for an anchor where the distances that its ranges and
the triangle inequality allow do not meet the annulus; the leaves that remain are compared exactly, so the result is
exact whatever the tree is worth.

The split points come from a bounded sample; every row is indexed. Anchors are taken in rounds of bounded size, each of
them a broadcast; a task keeps the best of each window of what it reads, and the best of all tasks meet per window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from breakwater.llm.common import prepare, shuffle_width, stored

# Parameters: rows that split points are chosen from, split points of a node, rows of a leaf below which nothing is
# split, anchors of a round, comparisons held at a time, candidates held before the best are taken.
SAMPLE, FANOUT, LEAF_ROWS, ROUND = 4096, 16, 256, 2048
HELD, PENDING = 1 << 21, 1 << 17
# Norms from here on would leave the whole numbers that doubles hold.
MOST_NORM = float(1 << 26)

_ROW = "leaf int, row long, vec_id long, label int, vec binary, low binary, high binary"
_BEST = "task int, win int, anchor_id long, positive_id long, positive_score long, row long, vec_id long, score long"


def _matrix(column, dim: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x); shorter vectors end in zeros."""
    offsets = column.offsets.to_numpy()
    values = np.floor(column.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    sizes, out = np.diff(offsets), np.zeros((len(offsets) - 1, dim))
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes)] = values[offsets[0] : offsets[-1]]
    return out


# -- the tree ---------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """Split points (lifted), and for each the child node or, as ``-1 - leaf``, the leaf."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)


class Tree:
    """Split points of all nodes; ``paths`` leads to each leaf; ranges are set once all rows are in it."""

    def __init__(self, sample: np.ndarray, norm2: float, leaf_share: float):
        self.norm2, self.nodes, self.paths = norm2, [], []
        self.low: np.ndarray | None = None
        self.high: np.ndarray | None = None
        self._grow(self.lifted(sample), leaf_share * max(1, len(sample)), [])

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm2 - (rows * rows).sum(axis=1)))
        return np.concatenate([rows, rest[:, None]], axis=1)

    def distances(self, lifted: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 * self.norm2 - 2 * (lifted @ points.T)))

    @property
    def slack(self) -> float:
        """More than rounding can add to a distance."""
        return 1e-5 * (self.norm2**0.5 + 1)

    def _split_points(self, rows: np.ndarray) -> np.ndarray:
        """Rows far from each other: each next one is the farthest from those chosen; equal rows are chosen once."""
        chosen, nearest = [0], self.distances(rows, rows[:1])[:, 0]
        while len(chosen) < FANOUT:
            far = int(nearest.argmax())
            if nearest[far] <= self.slack:
                break
            chosen.append(far)
            nearest = np.minimum(nearest, self.distances(rows, rows[far : far + 1])[:, 0])
        return rows[chosen]

    def _grow(self, rows: np.ndarray, leaf_rows: float, path: list[tuple[int, int]]) -> int:
        points = self._split_points(rows) if len(rows) > max(leaf_rows, FANOUT) else rows[:0]
        if len(points) < 2 and path:
            self.paths.append(path)
            return -len(self.paths)
        if len(points) < 2:
            points = rows[:1] if len(rows) else np.zeros((1, rows.shape[1]))
        number = len(self.nodes)
        self.nodes.append(node := Node(points))
        nearest = self.distances(rows, points).argmin(axis=1) if len(points) > 1 else np.zeros(len(rows), int)
        for child in range(len(points)):
            own = rows[nearest == child] if len(points) > 1 else rows[:0]
            node.children.append(self._grow(own, leaf_rows, [*path, (number, child)]))
        return number

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of no row: by node, split point, subtree."""
        shape = (len(self.nodes), FANOUT, FANOUT)
        return np.full(shape, np.inf), np.full(shape, -np.inf)

    def place(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The leaf of every row; the ranges widen by them."""
        lifted, leaves = self.lifted(rows), np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            away = self.distances(lifted[at], node.points)
            nearest, k = away.argmin(axis=1), len(node.points)
            for child in np.unique(nearest).tolist():
                own = nearest == child
                low[number, :k, child] = np.minimum(low[number, :k, child], away[own].min(axis=0))
                high[number, :k, child] = np.maximum(high[number, :k, child], away[own].max(axis=0))
                below = node.children[child]
                if below < 0:
                    leaves[at[own]] = -1 - below
                else:
                    todo.append((below, at[own]))
        return leaves


class Walk:
    """Which windows may have rows in a leaf; neighbouring leaves share the upper part of their paths."""

    def __init__(self, tree: Tree, anchors: np.ndarray, owner: np.ndarray):
        self.tree, self.anchors, self.owner = tree, anchors, owner
        self.norms = (anchors * anchors).sum(axis=1)
        self.kept: list[tuple[int, np.ndarray]] = []

    def _away(self, depth: int, number: int) -> np.ndarray:
        if depth < len(self.kept) and self.kept[depth][0] == number:
            return self.kept[depth][1]
        points = self.tree.nodes[number].points
        square = self.tree.norm2 + self.norms[:, None] - 2 * (self.anchors @ points[:, :-1].T)
        away = np.sqrt(np.maximum(0.0, square))
        self.kept[depth:] = [(number, away)]
        return away

    def annulus(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores from ``lo`` to ``hi`` as distances from the windows' anchors."""
        whole = self.tree.norm2 + self.norms[self.owner]
        return np.sqrt(np.maximum(0.0, whole - 2 * hi)), np.sqrt(np.maximum(0.0, whole - 2 * lo))

    def open(self, leaf: int, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """The windows for which no range on the way to the leaf rules it out."""
        tree, left = self.tree, np.arange(len(self.owner))
        for depth, (number, child) in enumerate(tree.paths[leaf]):
            away = self._away(depth, number)
            k = away.shape[1]
            low, high = tree.low[number, :k, child], tree.high[number, :k, child]
            least = np.maximum(away - high, low - away).max(axis=1)
            most = (away + high).min(axis=1)
            own = self.owner[left]
            left = left[(least[own] <= outer[left] + tree.slack) & (most[own] >= inner[left] - tree.slack)]
            if not len(left):
                break
        return left


# -- windows ----------------------------------------------------------------------------------------------------


@dataclass
class Windows:
    """What is asked for: of the rows with the anchor's label, or all others, the ``best`` scores from lo to hi."""

    best: int
    same: bool
    anchors: np.ndarray
    anchor_rows: np.ndarray
    anchor_ids: list
    labels: np.ndarray
    owner: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    positive_ids: list
    positive_scores: np.ndarray

    def fits(self, wins: np.ndarray, scores: np.ndarray, labels: np.ndarray, rows: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Of rows (down) and windows (across), which go together; an anchor is none of its own."""
        own = self.owner[wins]
        kind = labels[:, None] == self.labels[own][None, :]
        return (kind == self.same) & (scores >= lo[wins]) & (scores <= self.hi[wins]) & (rows[:, None] != self.anchor_rows[own][None, :])

    def raised(self, sample: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """``lo``, raised to the score that enough rows of the sample reach."""
        lo, step = self.lo.copy(), max(1, HELD // max(1, len(sample)))
        for at in range(0, len(lo) if len(sample) >= self.best else 0, step):
            wins = np.arange(at, min(at + step, len(lo)))
            scores = sample @ self.anchors[self.owner[wins]].T
            scores[~self.fits(wins, scores, labels, rows, self.lo)] = -np.inf
            kth = np.partition(scores, len(sample) - self.best, axis=0)[len(sample) - self.best]
            lo[wins] = np.maximum(lo[wins], kth)
        return lo


class Best:
    """The best rows of each window among those met: highest score, then least id, nulls last."""

    def __init__(self, best: int, lo: np.ndarray):
        self.best, self.lo, self.held, self.size = best, lo, [], 0

    def add(self, *found: np.ndarray) -> None:
        self.held.append(found)
        self.size += len(found[0])
        if self.size > PENDING:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        if not self.held:
            return [np.zeros(0, np.int64)] * 5
        win, score, bare, ids, row = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((row, ids, bare, -score, win))
        win = win[order]
        first = np.flatnonzero(np.concatenate(([True], win[1:] != win[:-1])))
        rank = np.arange(len(win)) - np.repeat(first, np.diff(np.append(first, len(win))))
        last = rank == self.best - 1
        self.lo[win[last]] = np.maximum(self.lo[win[last]], score[order][last])
        top = rank < self.best
        kept = [win[top], *(x[order][top] for x in (score, bare, ids, row))]
        self.held, self.size = [tuple(kept)], len(kept[0])
        return kept


def _searched(shared, dim: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        tree, windows = shared.value
        best = Best(windows.best, windows.lo.copy())
        walk = Walk(tree, windows.anchors, windows.owner)
        for batch in batches:
            leaves, rows = batch.column("leaf").to_numpy(), batch.column("row").to_numpy()
            bare = np.asarray(batch.column("vec_id").is_null()).astype(bool)
            ids = batch.column("vec_id").fill_null(0).to_numpy()
            labels = batch.column("label").to_numpy()
            vectors = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.float64).reshape(len(rows), dim)
            cuts = np.flatnonzero(np.concatenate(([True], leaves[1:] != leaves[:-1]))) if len(rows) else []
            for start, end in zip(cuts, [*cuts[1:], len(rows)]):
                asked = walk.open(int(leaves[start]), *walk.annulus(best.lo, windows.hi))
                step = max(1, HELD // int(end - start))
                for at in range(0, len(asked), step):
                    wins = asked[at : at + step]
                    scores = vectors[start:end] @ windows.anchors[windows.owner[wins]].T
                    r, w = np.nonzero(windows.fits(wins, scores, labels[start:end], rows[start:end], best.lo))
                    best.add(wins[w], scores[r, w], bare[start + r], ids[start + r], rows[start + r])
        win, score, bare, ids, row = best.settle()
        own = windows.owner[win].tolist()
        task = [TaskContext.get().partitionId()] * len(win)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(task, pa.int32()),
                pa.array(win, pa.int32()),
                pa.array([windows.anchor_ids[i] for i in own], pa.int64()),
                pa.array([windows.positive_ids[i] for i in win.tolist()], pa.int64()),
                pa.array(windows.positive_scores[win], pa.int64()),
                pa.array(row, pa.int64()),
                pa.array(ids, pa.int64(), mask=bare.astype(bool)),
                pa.array(score.astype(np.int64), pa.int64()),
            ],
            ["task", "win", "anchor_id", "positive_id", "positive_score", "row", "vec_id", "score"],
        )

    return run


# -- the operator -----------------------------------------------------------------------------------------------


class Index:
    """All rows by leaf, stored; the tree with its ranges; the sample it was grown from."""

    def __init__(self, rows: DataFrame, scale: int):
        spark = rows.sparkSession
        self.width = shuffle_width(spark)
        usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        taken = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "embedding")
        taken = taken.where(F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
        square = F.aggregate("embedding", F.lit(0.0), lambda sum, x: sum + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0)))
        facts = taken.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"), F.max(square).alias("norm2")).first()
        self.rows, self.dim, self.scale = facts.n, max(1, facts.dim or 0), scale
        if (facts.norm2 or 0.0) >= MOST_NORM**2:
            raise ValueError("vectors too long for exact scores; scale them down")
        few = taken.withColumn("deal", F.xxhash64("vec_id", "embedding")).orderBy("deal").limit(SAMPLE).drop("deal").toArrow().combine_chunks()
        lists = few.column("embedding").combine_chunks() if few.num_rows else None
        sample = np.zeros((0, self.dim)) if lists is None else _matrix(lists, self.dim, scale)
        self.tree = Tree(sample, facts.norm2 or 0.0, LEAF_ROWS / max(1, self.rows))
        placed = stored(taken.withColumn("row", F.monotonically_increasing_id()).mapInArrow(self._placed(spark), _ROW))
        self._widen(placed)
        by_leaf = placed.where(F.col("low").isNull()).drop("low", "high")
        dealt = by_leaf.repartitionByRange(self.width, F.col("leaf"), F.xxhash64("row")).sortWithinPartitions("leaf", "row")
        self.index = stored(dealt)

    def _placed(self, spark):
        shared, dim, scale = spark.sparkContext.broadcast(self.tree), self.dim, self.scale

        def run(batches: Iterable) -> Iterator:
            import pyarrow as pa

            def out(n: int, **columns):
                kinds = [("leaf", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int32())]
                kinds += [(c, pa.binary()) for c in ("vec", "low", "high")]
                arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns.get(c, [None] * n), k) for c, k in kinds]
                return pa.RecordBatch.from_arrays(arrays, [c for c, _ in kinds])

            tree = shared.value
            low, high = tree.ranges()
            for batch in batches:
                ints = _matrix(batch.column("embedding"), dim, scale)
                leaves = tree.place(ints, low, high)
                vecs = [v.tobytes() for v in ints]
                yield out(len(vecs), leaf=leaves, row=batch.column("row"), vec_id=batch.column("vec_id"), label=batch.column("label"), vec=vecs)
            for number in range(len(tree.nodes)):  # one row for each node that this task has met
                if np.isfinite(low[number]).any():
                    yield out(1, leaf=[number], low=[low[number].tobytes()], high=[high[number].tobytes()])

        return run

    def _widen(self, placed: DataFrame) -> None:
        """The ranges of all tasks become the tree's; their number is that of its nodes, which the sample bounds."""

        def merged(batches: Iterable) -> Iterator:
            import pyarrow as pa

            met: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    low, high = (np.frombuffer(row[c], np.float64) for c in ("low", "high"))
                    if row["leaf"] in met:
                        low, high = np.minimum(met[row["leaf"]][0], low), np.maximum(met[row["leaf"]][1], high)
                    met[row["leaf"]] = [low, high]
            columns = [pa.array(list(met), pa.int32()), *(pa.array([x[i].tobytes() for x in met.values()], pa.binary()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "low", "high"])

        found = placed.where(F.col("low").isNotNull()).select("leaf", "low", "high")
        for key in (F.pmod(F.monotonically_increasing_id(), F.lit(16)), F.lit(0)):  # parts of a node first
            found = found.withColumn("part", key).repartition(self.width, "leaf", "part").drop("part")
            found = found.mapInArrow(merged, "leaf int, low binary, high binary")
        self.tree.low, self.tree.high = self.tree.ranges()
        for row in found.collect():
            for whole, own in ((self.tree.low, row.low), (self.tree.high, row.high)):
                whole[row.leaf] = np.frombuffer(own, np.float64).reshape(FANOUT, FANOUT)

    def arrays(self, frame: DataFrame) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        """Vectors, rows, ids and labels of a bounded number of indexed rows."""
        found = frame.select("row", "vec_id", "label", "vec").toArrow()
        vectors = np.frombuffer(b"".join(found.column("vec").to_pylist()), np.float64).reshape(found.num_rows, self.dim)
        return vectors, found.column("row").to_numpy(), found.column("vec_id").to_pylist(), found.column("label").to_numpy()

    def search(self, windows: Windows) -> DataFrame:
        """The windows' rows with ``rank``, from 1."""
        shared = self.index.sparkSession.sparkContext.broadcast((self.tree, windows))
        found = self.index.mapInArrow(_searched(shared, self.dim), _BEST)
        order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
        part = Window.partitionBy("win", F.pmod("task", F.lit(16))).orderBy(*order)
        few = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= windows.best)
        return few.withColumn("rank", F.row_number().over(Window.partitionBy("win").orderBy(*order))).where(F.col("rank") <= windows.best)


def hard_negatives(
    rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, every: int = 100
) -> DataFrame:
    """For each anchor and positive the best rows of other labels whose score is ``low`` to ``high`` per cent of the positive's.

    ``rows`` has ``vec_id, label, embedding``; anchors are the rows whose id ``every`` divides, positives the best other
    rows of an anchor's label. A component counts as floor(scale * x); shorter vectors end in zeros. Rows with a null
    label, vector or component, or a component that is not finite, take no part; a null id is never an anchor and comes
    last among ties. Repeated rows are rows of their own, so a repeated anchor has its result twice, and its twin among
    its positives. A positive score below 0 has no window and no rows. An empty table gives none; other columns are not
    read. Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    spark = rows.sparkSession
    prepare(spark)
    index = Index(rows, scale)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    anchors = index.index.where(F.col("vec_id") % every == 0)
    rounds = -(-anchors.count() // ROUND)
    base = index.arrays(index.index.withColumn("deal", F.xxhash64("row")).orderBy("deal").limit(SAMPLE)) if rounds else None
    done = []
    for k in range(rounds):
        vectors, own, ids, labels = index.arrays(anchors.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == k))
        if not len(own):
            continue
        size = len(own)
        best = Windows(positives, True, vectors, own, ids, labels, np.arange(size), np.full(size, -np.inf), np.full(size, np.inf), [None] * size, np.zeros(size, np.int64))
        best.lo = best.raised(base[0], base[3], base[1])
        met = index.search(best).select("win", "vec_id", "score").toArrow()
        owner, scores = met.column("win").to_numpy(), met.column("score").to_numpy()
        able = np.flatnonzero(scores >= 0)
        owner, scores, ids_of = owner[able], scores[able], met.column("vec_id").take(able).to_pylist()
        lo, hi = -(-low * scores // 100), high * scores // 100
        pairs = Windows(negatives, False, vectors, own, ids, labels, owner, lo.astype(np.float64), hi.astype(np.float64), ids_of, scores)
        pairs.lo = pairs.raised(base[0], base[3], base[1])
        found = index.search(pairs).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        done.append(found if rounds == 1 else stored(found))
    if not done:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    result = done[0]
    for found in done[1:]:
        result = result.unionByName(found)
    return result.select(*names)


#: The query's result for SQL.
SQL = r"""
with ok as (
    select row_number() over () as r, vec_id,
           case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * cast(x as double)) for x in embedding] as v
    from embeddings
    where label is not null and embedding is not null
      and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
anchors as (select * from ok where vec_id % 100 = 0),
scored as (
    select a.r as a, a.vec_id as anchor_id, a.label as anchor_label, o.r, o.vec_id, o.label,
           cast(list_dot_product(a.v, o.v) as bigint) as score
    from anchors a join ok o on a.r <> o.r),
positives as (
    select a, anchor_id, r as p, vec_id as positive_id, score as positive_score
    from (select *, row_number() over (partition by a order by score desc, vec_id nulls last) as k
          from scored where label = anchor_label) where k <= 5),
ranked as (
    select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
           row_number() over (partition by p.a, p.p order by s.score desc, s.vec_id nulls last) as rank
    from positives p join scored s on s.a = p.a and s.label <> s.anchor_label
         and 100 * s.score between 30 * p.positive_score and 90 * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""
