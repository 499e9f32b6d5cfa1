"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

Copies are folded first. Spherical k-means on a bounded sample gives centroids;
centroids closer to each other than half the threshold angle are thinned out, so
one dense group does not spread over many cells. Every vector goes to the cell
of its nearest centroid.

Inside a cell, salted into blocks of bounded size, vectors gather around leaders:
two vectors within half the threshold angle of one leader are within the
threshold of each other, so the members of such a ball are all linked and are
counted, not compared. What is compared are balls (most hold one vector). A ball
stands in its own cell and is shown to every other cell whose centroid is not
farther than ``reach`` allows; products of leaders, block by block, tell whether
all, none or some of the members of two balls are linked. Only for the last, their
members are multiplied. No pair leaves a block, only counts, one link per ball
towards its component, and pairs of balls that their members must decide.

A pair in two cells is found if one of its vectors is shown to the other's cell.
For vectors u and v at the threshold angle a, and centroids c and d, v can only be
nearer to d if u's cosine to c exceeds that to d by at most tan(a) |d - c| times
the part of v's deviation that points along d - c. That part is at most 1 and has
the standard deviation 1 / sqrt(dim) where directions are random; ``reach`` counts
these deviations, and reach >= sqrt(dim) loses nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import connected_components
from kindred.operators.vectorsum import as_list_column, as_matrix, merge_sums
from kindred.session import materialize

THRESHOLD = 0.9
#: Standard deviations of the random part of a pair that cells are shown for.
REACH = 2.5
#: Vectors a cell should hold, and bytes of all centroids at most.
CELL_ROWS = 1_024
CENTROID_BYTES = 32 << 20
#: Rows that centroids are fitted on at most, per centroid and at all, and rounds of k-means.
SAMPLE_PER_CELL = 64
SAMPLE_ROWS = 4_000_000
ROUNDS = 6
#: Rows of a block at most (a salted part holds about as many), and entries of one product.
BLOCK_ROWS = 2_048
PRODUCT_ENTRIES = 1 << 20
#: Room for rounding in angles that decide for whole balls.
ANGLE_ROOM = 1e-7

SUMS = "key bigint, part bigint, n bigint, total array<double>"
MEMBERS = "v bigint, least bigint, copies bigint, vec array<double>, cell int, ball bigint, n_ball bigint, radius double"
FOUND = "a bigint, b bigint, n bigint, kind int"
#: Kinds of rows that blocks put out: links of a ball's members (n), a link between two balls, two balls whose members decide.
COUNT, LINK, OPEN = 0, 1, 2


def _unit(matrix: np.ndarray) -> np.ndarray:
    if not matrix.size:
        return matrix
    # entries scaled first, so that squares neither vanish nor overflow
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def comparable(v: str):
    """Whether a vector links with anything: no null, no null or non-finite entry, not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(v).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def folded_vectors(rows: DataFrame) -> DataFrame:
    """v, least, copies, vec: distinct vectors with the least id and the number of their rows."""
    distinct = rows.groupBy(F.col("vec")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return materialize(distinct.select(F.monotonically_increasing_id().alias("v"), "least", "copies", "vec"), "distinct")


def fit_centroids(distinct: DataFrame, n_rows: int, cells: int) -> np.ndarray:
    """Unit centroids of spherical k-means over a sample of at most SAMPLE_ROWS
    rows, each at least half the threshold angle from the others. The sample and
    the first centroids are taken by a hash of the vectors."""
    wanted = min(SAMPLE_ROWS, SAMPLE_PER_CELL * cells)
    sample = distinct.select("vec", F.xxhash64("vec").alias("h"))
    if wanted < n_rows:
        sample = sample.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * wanted / n_rows))
    sample = materialize(sample, "sample")
    start = sample.orderBy("h", "vec").limit(cells).select("vec").collect()
    centroids = _unit(np.array([row["vec"] for row in start], dtype=np.float64))
    if len(centroids) < 2:
        return centroids
    for _ in range(ROUNDS):
        centroids = _moved(sample, centroids)
    return _thinned(centroids)


def _moved(sample: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the direction of the sum of each cell's unit vectors; an empty cell keeps its centroid."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(centroids)
        n = np.zeros(len(centroids), np.int64)
        for batch in batches:
            unit = _unit(as_matrix(batch.column(0)))
            for lo, near in _nearest(unit, centroids):
                order = np.argsort(near, kind="stable")
                starts = np.nonzero(np.diff(near[order], prepend=-1))[0]
                total[near[order][starts]] += np.add.reduceat(unit[lo : lo + len(near)][order], starts, axis=0)
                n += np.bincount(near, minlength=len(centroids))
        used = np.nonzero(n)[0]
        if len(used):
            part = np.full(len(used), TaskContext.get().partitionId(), np.int64)
            columns = [pa.array(used), pa.array(part), pa.array(n[used]), as_list_column(total[used])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "part", "n", "total"])

    moved = centroids.copy()
    for row in merge_sums(sample.select("vec").mapInArrow(added, SUMS)).collect():
        total = np.array(row["total"])
        if np.linalg.norm(total) > 0:
            moved[row["key"]] = total / np.linalg.norm(total)
    return moved


def _nearest(unit: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    step = max(1, PRODUCT_ENTRIES // len(centroids))
    for lo in range(0, len(unit), step):
        yield lo, (unit[lo : lo + step] @ centroids.T).argmax(axis=1)


def _thinned(centroids: np.ndarray) -> np.ndarray:
    """Centroids without those nearer than half the threshold angle to an earlier one."""
    apart = math.cos(math.acos(THRESHOLD) / 2)
    kept = np.zeros((0, centroids.shape[1]))
    for c in centroids:
        if not len(kept) or (kept @ c).max() < apart:
            kept = np.vstack([kept, c])
    return kept


def _with_cell(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [part for _, part in _nearest(_unit(as_matrix(batch.column(3))), centroids)]
            cell = pa.array(np.concatenate([np.zeros(0, np.int64), *near]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], [*batch.schema.names, "cell"])

    return distinct.select("v", "least", "copies", "vec").mapInArrow(assigned, "v bigint, least bigint, copies bigint, vec array<double>, cell int")


def _parts(n_rows: str):
    """Blocks that hold so many rows."""
    return F.ceil(F.col(n_rows) / F.lit(BLOCK_ROWS)).cast("int")


def _part(key: str, seed: int, parts: str):
    """The block of a row."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.greatest(F.col(parts), F.lit(1))).cast("int")


def gathered(distinct: DataFrame, centroids: np.ndarray, threshold: float) -> DataFrame:
    """Members with their cell and ball. The leader's row names the number of rows
    (copies included) of its ball and the largest angle of a member to it."""
    celled = materialize(_with_cell(distinct, centroids), "celled")
    # a row per cell, at most one per centroid
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows")).select("cell", _parts("n_rows").alias("parts"))
    salted = celled.join(F.broadcast(sizes), "cell").withColumn("salt", _part("v", 1, "parts")).drop("parts")
    half = math.acos(threshold) / 2 - ANGLE_ROOM

    def led(group: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(group, sort_keys=[("v", "ascending")])
        group = group.take(order)
        unit = _unit(as_matrix(group["vec"]))
        copies = group["copies"].to_numpy()
        leader, angle = _leaders(unit, half)
        v = group["v"].to_numpy()
        n = np.bincount(leader, weights=copies, minlength=len(v)).astype(np.int64)
        radius = np.zeros(len(v))
        np.maximum.at(radius, leader, angle)
        leads = leader == np.arange(len(v))
        return pa.table(
            {
                **{name: group[name] for name in ("v", "least", "copies", "vec", "cell")},
                "ball": pa.array(v[leader]),
                "n_ball": pa.array(n, mask=~leads),
                "radius": pa.array(radius, mask=~leads),
            }
        )

    return materialize(salted.groupBy("cell", "salt").applyInArrow(led, MEMBERS), "members")


def _leaders(unit: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first row of a ball that takes it, and its angle to it:
    a row within ``half`` of leaders joins the nearest, any other leads."""
    near = math.cos(half)
    leader = np.arange(len(unit))
    angle = np.zeros(len(unit))
    leads = np.zeros(0, np.int64)
    step = 256
    for lo in range(0, len(unit), step):
        rows = np.arange(lo, min(lo + step, len(unit)))
        if len(leads):
            cosine = unit[rows] @ unit[leads].T
            best = cosine.argmax(axis=1)
            value = cosine[np.arange(len(rows)), best]
            joins = value >= near
            leader[rows[joins]] = leads[best[joins]]
            angle[rows[joins]] = _angle(value[joins])
            rows = rows[~joins]
        # the rest of these rows among themselves
        among = unit[rows] @ unit[rows].T
        free = np.ones(len(rows), bool)
        for i in range(len(rows)):
            if free[i]:
                taken = np.nonzero(free & (among[i] >= near))[0]
                taken = taken[taken != i]
                leader[rows[taken]] = rows[i]
                angle[rows[taken]] = _angle(among[i, taken])
                free[taken] = False
        leads = np.concatenate([leads, rows[leader[rows] == rows]])
    return leader, angle


def shown(members: DataFrame, centroids: np.ndarray, threshold: float, reach: float) -> DataFrame:
    """A row per ball and cell that compares it: cell, ball, home, n_ball, radius, vec, others (the cells it is shown to)."""
    tangent = math.tan(math.acos(threshold))
    part = min(1.0, reach / math.sqrt(centroids.shape[1]))
    step = max(1, PRODUCT_ENTRIES // len(centroids))
    between = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T)) if len(centroids) <= 2_048 else None
    schema = "cell int, ball bigint, home int, n_ball bigint, radius double, vec array<double>, others array<int>"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                piece = batch.slice(lo, step)
                unit = _unit(as_matrix(piece["vec"]))
                home = piece["cell"].to_numpy()
                cosine = unit @ centroids.T
                apart = between[home] if between is not None else np.sqrt(np.maximum(0.0, 2 - 2 * centroids[home] @ centroids.T))
                # members may lie up to the radius off the leader
                off = 2 * np.sin(piece["radius"].to_numpy() / 2)
                room = apart * (tangent * part + off[:, None])
                row, cell = np.nonzero(cosine >= cosine[np.arange(len(unit)), home][:, None] - room - 1e-12)
                ends = np.searchsorted(row, np.arange(len(unit) + 1)).astype(np.int32)
                others = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell.astype(np.int32)))
                at = pa.array(row)
                columns = [pa.array(cell.astype(np.int32)), *(piece[c].take(at) for c in ("ball", "cell", "n_ball", "radius", "vec")), others.take(at)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split()[0] for field in schema.split(", ")]
    balls = members.filter("v = ball").select("ball", "cell", "n_ball", "radius", "vec")
    return materialize(balls.mapInArrow(placed, schema), "shown")


def compared(balls: DataFrame, threshold: float) -> DataFrame:
    """What the blocks of all cells find out about balls, see FOUND.

    A cell's own balls are dealt into blocks, and so are all balls it compares
    them with; a group is one block of each.
    """
    own = F.col("home") == F.col("cell")
    # a row per cell, at most one per centroid
    sizes = balls.groupBy("cell").agg(F.count_if(own).alias("n_own"), F.count(F.lit(1)).alias("n_all"))
    sizes = sizes.filter("n_own > 0").select("cell", _parts("n_own").alias("own_parts"), _parts("n_all").alias("all_parts"))
    sized = balls.join(F.broadcast(sizes), "cell")
    row = F.struct(*balls.columns).alias("row")
    i, j = _part("ball", 2, "own_parts").alias("i"), _part("ball", 3, "all_parts").alias("j")
    every_i = F.explode(F.sequence(F.lit(0), F.col("own_parts") - 1)).alias("i")
    every_j = F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)).alias("j")
    left = sized.filter(own).select(row, i, every_j, F.lit(True).alias("is_left"))
    right = sized.select(row, every_i, j, F.lit(False).alias("is_left"))
    dealt = left.unionByName(right).select("i", "j", "is_left", "row.*")

    def block(group: pa.Table) -> pa.Table:
        is_left = group["is_left"]
        return _block_findings(group.filter(is_left), group.filter(pa.compute.invert(is_left)), threshold)

    return materialize(dealt.groupBy("cell", "i", "j").applyInArrow(block, FOUND), "found")


def _block_findings(left: pa.Table, right: pa.Table, threshold: float) -> pa.Table:
    if not len(left) or not len(right):
        return _findings([], [], [], [])
    order = pa.compute.sort_indices(right, sort_keys=[("ball", "ascending")])
    right = right.take(order)
    cell = left["home"][0].as_py()
    a, b = left["ball"].to_numpy(), right["ball"].to_numpy()
    ua, ub = _unit(as_matrix(left["vec"])), _unit(as_matrix(right["vec"]))
    na, nb = left["n_ball"].to_numpy(), right["n_ball"].to_numpy()
    ra, rb = left["radius"].to_numpy(), right["radius"].to_numpy()
    home = right["home"].to_numpy()
    other = home != cell
    # a right ball of a smaller cell is that cell's affair for the left balls shown there
    homes, column = np.unique(home, return_inverse=True)
    told = _shown_to(left["others"], homes) & (homes < cell)
    limit = math.acos(threshold)
    single = threshold
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    forest = _Forest(np.concatenate([a, b]))
    open_a, open_b = [], []
    step = max(1, PRODUCT_ENTRIES // len(b))
    for lo in range(0, len(a), step):
        hi = min(lo + step, len(a))
        cosine = ua[lo:hi] @ ub.T
        spread = ra[lo:hi, None] + rb
        # nothing can be linked where the angle exceeds the limit by the radii
        maybe = cosine >= np.cos(np.minimum(limit + spread + ANGLE_ROOM, math.pi))
        maybe &= ~told[lo:hi][:, column]
        maybe &= a[lo:hi, None] != b
        x, y = np.nonzero(maybe)
        if not len(x):
            continue
        c, s = cosine[x, y], spread[x, y]
        alone = s == 0
        linked = np.where(alone, c >= single, _angle(c) + s <= limit - ANGLE_ROOM)
        undecided = ~linked & ~alone
        # own balls meet twice, once as left and right each; each time the left one counts
        keep = undecided & (other[y] | (a[lo:hi][x] < b[y]))
        open_a.append(a[lo:hi][x[keep]])
        open_b.append(b[y[keep]])
        x, y = x[linked], y[linked]
        np.add.at(links_a, lo + x, nb[y])
        far = other[y]
        np.add.at(links_b, y[far], na[lo + x[far]])
        forest.join(lo + x, len(a) + y)
    counted_a, counted_b = np.nonzero(links_a)[0], np.nonzero(links_b)[0]
    node, root = forest.links()
    opened = np.concatenate(open_a) if open_a else np.zeros(0, np.int64)
    return _findings(
        [a[counted_a], b[counted_b], node, opened],
        [a[counted_a], b[counted_b], root, np.concatenate(open_b) if open_b else opened],
        [links_a[counted_a], links_b[counted_b], np.zeros(len(node), np.int64), np.zeros(len(opened), np.int64)],
        [COUNT, COUNT, LINK, OPEN],
    )


def _shown_to(others: pa.ChunkedArray, homes: np.ndarray) -> np.ndarray:
    """Rows by homes: whether the list of the row names the home."""
    lists = others.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(lists)), sizes)
    at = np.minimum(np.searchsorted(homes, values), len(homes) - 1)
    hit = homes[at] == values
    out = np.zeros((len(lists), len(homes)), bool)
    out[rows[hit], at[hit]] = True
    return out


def _findings(a: list, b: list, n: list, kinds: list) -> pa.Table:
    kind = np.concatenate([np.zeros(0, np.int32), *(np.full(len(x), k, np.int32) for x, k in zip(a, kinds))])
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return pa.table({"a": join(a), "b": join(b), "n": join(n), "kind": kind})


class _Forest:
    """Components of a block's members, by the smallest of them."""

    def __init__(self, names: np.ndarray):
        self.names, self.place = np.unique(names, return_inverse=True)
        self.root = np.arange(len(self.names))

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        x, y = self.place[x], self.place[y]
        while len(x):
            rx, ry = self.root[x], self.root[y]
            apart = rx != ry
            x, y = x[apart], y[apart]
            low, high = np.minimum(rx, ry)[apart], np.maximum(rx, ry)[apart]
            np.minimum.at(self.root, high, low)
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.nonzero(self.root != np.arange(len(self.root)))[0]
        return self.names[moved], self.names[self.root[moved]]


def decided_by_members(found: DataFrame, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """For the open pairs of balls: v, n (links of single vectors) and links a, b of balls.
    A ball has at most one block of members, so a pair is two blocks."""
    pairs = found.filter(F.col("kind") == OPEN).select("a", "b")
    body = members.select("ball", "v", "copies", "vec")
    first = pairs.join(body.withColumnRenamed("ball", "a"), "a").toDF("a", "b", "v", "copies", "vec")
    second = pairs.join(body.withColumnRenamed("ball", "b"), "b").toDF("b", "a", "v", "copies", "vec")
    schema = "v bigint, n bigint, a bigint, b bigint"

    def multiplied(x: pa.Table, y: pa.Table) -> pa.Table:
        hit = _unit(as_matrix(x["vec"])) @ _unit(as_matrix(y["vec"])).T >= threshold
        n_x, n_y = hit @ y["copies"].to_numpy(), x["copies"].to_numpy() @ hit
        vs = np.concatenate([x["v"].to_numpy(), y["v"].to_numpy()])
        n = np.concatenate([n_x, n_y]).astype(np.int64)
        some = np.nonzero(n)[0]
        ball_a, ball_b = x["a"][0].as_py(), x["b"][0].as_py()
        return pa.table(
            {
                "v": vs[some],
                "n": n[some],
                "a": np.full(len(some), ball_a, np.int64),
                "b": np.full(len(some), ball_b, np.int64),
            }
        )

    pieces = materialize(first.groupBy(first.a, first.b).cogroup(second.groupBy(second.a, second.b)).applyInArrow(multiplied, schema), "opened")
    return pieces.groupBy("v").agg(F.sum("n").alias("n_open")), pieces.select("a", "b").distinct()


def near_duplicate_vectors(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    reach: float = REACH,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    No link is below the threshold. With ``reach`` of at least sqrt(dim) all are
    found; below it a pair at the very threshold may be missed, one well above it
    hardly (README has the measured recall). A table of up to ``cell_rows`` distinct
    vectors is one cell, where nothing can be missed.

    Defined cases: vectors that are null, zero or hold null or non-finite entries
    have no links and are components of their own. Copies of a vector are linked
    with each other; repeated ids are different rows. A row without an id is
    linked like any other, names no component, and is kept only where its
    component has no id (then component_id is null). Vectors of different sizes are
    an error. An empty table gives no rows. Other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    # -0.0 is 0.0 when copies are folded
    usable = comparable("vec")
    tagged = rows.select("id", F.when(usable, F.transform("vec", lambda x: x + F.lit(0.0))).alias("vec"))
    alone = tagged.filter(F.col("vec").isNull()).select(
        F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    distinct = folded_vectors(tagged.filter(F.col("vec").isNotNull()))
    n_rows, least_dim, most_dim = distinct.agg(F.count(F.lit(1)), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if n_rows and least_dim != most_dim:
        raise ValueError(f"vectors of {least_dim} and of {most_dim} entries")
    named = alone
    if n_rows:
        cells = max(1, min(math.ceil(n_rows / cell_rows), CENTROID_BYTES // (8 * most_dim)))
        centroids = fit_centroids(distinct, n_rows, cells)
        members = gathered(distinct, centroids, threshold)
        found = compared(shown(members, centroids, threshold, reach), threshold)
        named = named.unionByName(_named_rows(tagged, members, found, threshold))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return named.select("vec_id", "n_links", "component_id", kept.alias("kept"))


def _named_rows(tagged: DataFrame, members: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    by_member, more_links = decided_by_members(found, members, threshold)
    links = found.filter(F.col("kind") == LINK).select("a", "b").union(more_links)
    components = connected_components(links).withColumnRenamed("node", "ball")
    by_ball = found.filter(F.col("kind") == COUNT).groupBy(F.col("a").alias("ball")).agg(F.sum("n").alias("n_far"))
    sizes = members.filter("v = ball").select("ball", F.col("n_ball").alias("n_own"))
    least = members.groupBy("ball").agg(F.min("least").alias("least"))
    # everything about a ball in one row per ball
    balls = sizes.join(least, "ball").join(by_ball, "ball", "left").join(components, "ball", "left")
    balls = materialize(balls.withColumn("root", F.coalesce("root", "ball")), "balls")
    names = balls.groupBy("root").agg(F.min("least").alias("component_id"))
    about = balls.join(names, "root").select("ball", F.expr("n_own - 1 + coalesce(n_far, 0)").alias("n_ball_links"), "component_id")
    vectors = members.select("v", "ball", "vec").join(about, "ball").join(by_member, "v", "left")
    vectors = materialize(vectors.select("vec", F.expr("n_ball_links + coalesce(n_open, 0)").alias("n_links"), "component_id"), "vectors")
    rows = tagged.filter(F.col("vec").isNotNull())
    return rows.join(vectors, "vec").select(F.col("id").alias("vec_id"), "n_links", "component_id")
