"""Hard negatives through an STR-packed R-tree over integer vectors, searched by inner product."""

from __future__ import annotations

import heapq
import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.session import materialize

#: Rows of a leaf box, children of an inner node, rows of a tile (one packed subtree, one row of the index), about.
LEAF, FAN, TILE = 128, 16, 4096
#: Rows of the sample that shapes the upper tiling, expected; and the greatest number of its regions.
SAMPLE, REGIONS = 16_384, 1024
#: Groups of regions that a block of queries is sent to, at most; queries of a block, about.
GROUPS, BLOCK = 64, 512
#: Blocks whose best rows a task holds at a time; beyond that the least recently used are handed on as they are.
HELD = 256
#: Stands for "no row" among scores.
NONE = -(1 << 62)
_KINDS = ("<i2", "<i4", "<i8")


def quantised(vec: str) -> Column:
    """Every component x of a float vector as floor(256 * x)."""
    return F.transform(F.col(vec), lambda x: F.floor(x.cast("double") * 256).cast("long"))


def usable(vec: str, label: str) -> Column:
    """Rows that take part: a label and a vector without null, NaN or infinite components."""
    finite = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.col(label).isNotNull() & F.col(vec).isNotNull() & F.coalesce(finite, F.lit(False))


# ---- sort-tile-recursive packing -----------------------------------------------------------------------------------
def _tiles(x: np.ndarray, size: int) -> tuple:
    """Sort-tile-recursive tiling into pages of ``size`` rows: (coordinate, cuts, children), or the rows of a page.

    Coordinates are taken by falling variance; on each the rows are sorted and cut into the P^(1/d) slabs of whole
    pages that P pages and d coordinates left ask for.
    """
    dims = np.argsort(-x.var(axis=0), kind="stable") if len(x) else np.zeros(0, int)

    def tile(at: np.ndarray, depth: int) -> tuple:
        pages = -(-len(at) // size)
        if pages <= 1 or depth == len(dims):
            return (None, at)
        slabs = math.ceil(round(pages ** (1 / (len(dims) - depth)), 9))
        if slabs <= 1:
            return tile(at, depth + 1)
        d = dims[depth]
        at = at[np.argsort(x[at, d], kind="stable")]
        starts = range(0, len(at), size * -(-pages // slabs))
        return (int(d), x[at[list(starts)[1:]], d], [tile(at[s:s + starts.step], depth + 1) for s in starts])

    return tile(np.arange(len(x)), 0)


def _pages(node: tuple) -> Iterator[np.ndarray]:
    if node[0] is None:
        yield node[1]
    else:
        for child in node[2]:
            yield from _pages(child)


class Regions:
    """The upper tiling, shaped on a sample: numbers every vector with the region that it falls into."""

    def __init__(self, sample: np.ndarray, regions: int):
        numbers = iter(range(1 << 30))

        def number(node):
            return next(numbers) if node[0] is None else (node[0], node[1], [number(c) for c in node[2]])

        self.root = number(_tiles(sample, max(1, -(-len(sample) // max(1, regions)))))
        self.count = next(numbers)

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)

        def route(node, at):
            if isinstance(node, int):
                out[at] = node
            elif len(at):
                part = np.searchsorted(node[1], x[at, node[0]], side="right")
                for k, child in enumerate(node[2]):
                    route(child, at[part == k])

        route(self.root, np.arange(len(x)))
        return out


def _boxes(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Minimum bounding boxes (lows, highs) by level: leaves of ``LEAF`` neighbouring rows first, the root last."""
    cuts = np.arange(0, len(x), LEAF)
    levels = [(np.minimum.reduceat(x, cuts), np.maximum.reduceat(x, cuts))]
    while len(levels[-1][0]) > 1:
        cuts = np.arange(0, len(levels[-1][0]), FAN)
        levels.append((np.minimum.reduceat(levels[-1][0], cuts), np.maximum.reduceat(levels[-1][1], cuts)))
    return levels


def _packed(x: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in the narrowest kind that holds them."""
    reach = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    kind = next(k for k, name in enumerate(_KINDS) if reach <= np.iinfo(name).max)
    return kind, x.astype(_KINDS[kind]).tobytes()


def _unpacked(kind: int, data: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, _KINDS[kind]).reshape(rows, dim)


# ---- search of one tile --------------------------------------------------------------------------------------------
@dataclass
class Queries:
    """A block of queries and the best rows found for each so far (by score, then id, null ids last)."""

    key: np.ndarray
    own: np.ndarray  # the row that a query never finds: itself
    label: np.ndarray
    low: np.ndarray  # least and greatest 100 * score
    high: np.ndarray
    x: np.ndarray
    score: np.ndarray
    row: np.ndarray
    id: np.ndarray
    no_id: np.ndarray

    def offer(self, q: np.ndarray, score: np.ndarray, row: np.ndarray, id_: np.ndarray, no_id: np.ndarray) -> None:
        """Keep the best of what queries ``q`` hold and the offered rows (``score`` is NONE where one does not fit)."""
        k = self.score.shape[1]
        new = [np.broadcast_to(a, score.shape) for a in (row, id_, no_id)]
        score = np.hstack([self.score[q], score])
        row, id_, no_id = (np.hstack([old[q], a]) for old, a in zip((self.row, self.id, self.no_id), new))
        best = np.lexsort((id_, no_id, -score), axis=1)[:, :k]
        for name, a in (("score", score), ("row", row), ("id", id_), ("no_id", no_id)):
            getattr(self, name)[q] = np.take_along_axis(a, best, axis=1)

    def found(self) -> pa.RecordBatch:
        q, j = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (self.key[q], self.row[q, j], self.id[q, j], self.no_id[q, j], self.score[q, j])],
            names=["q", "row", "id", "no_id", "score"])


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """Arrays whose products add up without rounding: doubles where they can, else Python integers."""
    reach = [max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0 for a in arrays]
    fits = 100 * math.prod(reach) * max(1, arrays[0].shape[1]) < 1 << 53
    return [a.astype(np.float64 if fits else object) for a in arrays]


class Tile:
    """One packed subtree: rows in STR order with their boxes."""

    def __init__(self, r: dict):
        n, dim = r["n"], r["dim"]
        self.x = _unpacked(r["kind"], r["x"], dim, n)
        self.row, self.id, self.label = (np.frombuffer(r[c], "<i8") for c in ("rows", "ids", "labels"))
        self.no_id = np.frombuffer(r["no_ids"], np.bool_)
        self.levels, at = [], 0
        lows, highs = (_unpacked(r["kind"], r[c], dim, r["n_boxes"]) for c in ("lows", "highs"))
        size = -(-n // LEAF)
        while True:
            self.levels.append((lows[at:at + size], highs[at:at + size]))
            at += size
            if size <= 1:
                break
            size = -(-size // FAN)

    def search(self, queries: Queries, same_label: bool) -> None:
        """Best-first: the box with the greatest possible score of any query that still needs it comes next.

        A box gives every query an interval of inner products, coordinate by coordinate. It is pruned for a query if the
        interval misses the query's window or ends strictly below its k-th best score.
        """
        if not len(self.row):
            return
        x, rows = _exact(queries.x, self.x)
        up, down = np.maximum(x, 0), np.minimum(x, 0)

        def needs(live, level, lo, hi):
            low, high = (a[lo:hi].astype(x.dtype) for a in self.levels[level])
            most = up[live] @ high.T + down[live] @ low.T
            least = up[live] @ low.T + down[live] @ high.T
            fits = ((most >= queries.score[live, -1:]) & (100 * most >= queries.low[live, None])
                    & (100 * least <= queries.high[live, None]))
            return most, np.asarray(fits, bool)

        top = len(self.levels) - 1
        every = np.arange(len(queries.key))
        most, fits = needs(every, top, 0, 1)
        live = every[fits[:, 0]]
        heap = [(-float(most[live, 0].max()), 0, top, 0, live, most[live, 0])] if len(live) else []
        pushed = 1
        while heap:
            _, _, level, node, live, most = heapq.heappop(heap)
            live = live[np.asarray(most >= queries.score[live, -1], bool)]  # the k-th score has risen meanwhile
            if not len(live):
                continue
            if level:
                lo, hi = node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0]))
                most, fits = needs(live, level - 1, lo, hi)
                for c in range(hi - lo):
                    if fits[:, c].any():
                        at = fits[:, c]
                        heapq.heappush(heap, (-float(most[at, c].max()), pushed, level - 1, lo + c, live[at], most[at, c]))
                        pushed += 1
                continue
            here = slice(node * LEAF, (node + 1) * LEAF)
            score = x[live] @ rows[here].T
            fits = np.asarray((score >= queries.score[live, -1:]) & (100 * score >= queries.low[live, None])
                              & (100 * score <= queries.high[live, None]), bool)
            same = queries.label[live, None] == self.label[here]
            fits &= (same if same_label else ~same) & (queries.own[live, None] != self.row[here])
            some = fits.any(axis=1)
            if some.any():
                queries.offer(live[some], np.where(fits[some], score[some], NONE).astype(np.int64), self.row[here],
                              self.id[here], self.no_id[here])


# ---- index and search on Spark -------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Index:
    rows: DataFrame  # row, id, no_id, label, x, dim, region: every row that takes part
    tiles: DataFrame  # one row per packed subtree
    regions: int
    n: int


def build_index(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> Index:
    """Pack all rows (``vec_col``: array of long, without nulls) into an R-tree.

    A sample of about ``SAMPLE`` rows gives the cuts of the upper tiling (at most ``REGIONS`` regions); every row is sent
    to its region, a region of many rows (equal vectors, too) is dealt out by a hash of the row number, and each such
    tile is packed in its task into one row of the index table. The sample shapes boxes only.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"),
                          F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
                          F.col(id_col).isNull().alias("no_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).alias("x"), F.size(vec_col).alias("dim"))
    rows = materialize(rows, "rtree-rows")
    n = rows.count()
    want = min(REGIONS, max(1, n // TILE))
    sample = rows.sample(min(1.0, SAMPLE / max(1, n)), seed=7).select("dim", "x").collect() if want > 1 else []
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r.x)
    upper = {d: Regions(np.array(xs, np.int64), max(1, want * len(xs) // len(sample))) for d, xs in by_dim.items() if d}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["region"] = np.zeros(len(pdf), np.int64)
            for d, at in pdf.groupby("dim").indices.items():
                if d in upper:
                    pdf.iloc[at, pdf.columns.get_loc("region")] = upper[d].of(np.stack(pdf["x"].to_numpy()[at]))
            yield pdf

    kinds = "row long, id long, no_id boolean, label long, x array<long>, dim int, region long"
    placed = materialize(rows.mapInPandas(place, kinds), "rtree-placed") if upper else rows.withColumn(
        "region", F.lit(0).cast("long"))
    parts = placed.groupBy(F.col("dim").alias("p_dim"), F.col("region").alias("p_region")).agg(
        F.ceil(F.count(F.lit(1)) / TILE).alias("parts"))
    dealt = placed.join(parts, (F.col("dim") == F.col("p_dim")) & (F.col("region") == F.col("p_region"))).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["x"].tolist(), np.int64).reshape(len(pdf), -1)
        order = np.concatenate(list(_pages(_tiles(x, LEAF))))
        x, pdf = x[order], pdf.iloc[order]
        levels = _boxes(x) if x.shape[1] else [(x[:1], x[:1])]
        kind, data = _packed(x)
        lows, highs = (np.concatenate([level[k] for level in levels]) for k in (0, 1))
        return pd.DataFrame([{
            "region": pdf["region"].iloc[0], "dim": x.shape[1], "n": len(x), "kind": kind, "x": data,
            "rows": pdf["row"].to_numpy("<i8").tobytes(), "ids": pdf["id"].to_numpy("<i8").tobytes(),
            "no_ids": pdf["no_id"].to_numpy(np.bool_).tobytes(), "labels": pdf["label"].to_numpy("<i8").tobytes(),
            "lows": lows.astype(_KINDS[kind]).tobytes(), "highs": highs.astype(_KINDS[kind]).tobytes(),
            "n_boxes": len(lows)}])

    tiles = dealt.groupBy("dim", "region", "part").applyInPandas(
        pack, "region long, dim int, n int, kind int, x binary, rows binary, ids binary, no_ids binary, labels binary, "
              "lows binary, highs binary, n_boxes int")
    regions = max([1, *(u.count for u in upper.values())])
    return Index(placed, materialize(tiles, "rtree-tiles"), regions, n)


def search(index: Index, queries: DataFrame, n_queries: int, k: int, same_label: bool) -> DataFrame:
    """(q, row, id, no_id, score, rank): for each query the first ``k`` rows by score, then id.

    ``queries`` has q, own, label, x, dim, region, low, high (bounds of 100 * score). They are packed into blocks, a
    block is sent to every group of regions (a fixed number at most) and meets its tiles one after the other, so that the
    k-th scores it has reached prune the next ones. A task holds a tile and the best rows of ``HELD`` blocks. What the
    tasks found is ranked per query.
    """
    spark = queries.sparkSession
    groups = min(GROUPS, index.regions)
    wide = max(1, round(BLOCK * index.regions / max(1, n_queries)))  # neighbouring regions that share a block
    counts = queries.groupBy(F.col("dim").alias("c_dim"), F.expr(f"region div {wide}").alias("c_span")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    spans = queries.withColumn("span", F.expr(f"region div {wide}"))
    spans = spans.join(counts, (F.col("dim") == F.col("c_dim")) & (F.col("span") == F.col("c_span"))).withColumn(
        "part", F.pmod(F.xxhash64("q"), F.col("parts")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["x"].tolist(), np.int64).reshape(len(pdf), -1)
        kind, data = _packed(x)
        return pd.DataFrame([{"q_dim": x.shape[1], "q_n": len(x), "q_kind": kind, "q_x": data,
                              **{f"q_{c}": pdf[c].to_numpy("<i8").tobytes() for c in ("q", "own", "label", "low", "high")}}])

    fields = "q_dim int, q_n int, q_kind int, q_x binary, q_q binary, q_own binary, q_label binary, q_low binary, q_high binary"
    blocks = materialize(spans.groupBy("dim", "span", "part").applyInPandas(pack, fields), "rtree-queries")
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = blocks.withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(
        tasks, "q_dim", "q_group")
    tiles = index.tiles.withColumn("group", F.expr(f"CAST(region * {groups} div {index.regions} AS INT)")).repartition(
        tasks, "dim", "group")
    pairs = tiles.hint("merge").join(sent, (F.col("dim") == F.col("q_dim")) & (F.col("group") == F.col("q_group")))

    def unpack(r: dict) -> Queries:
        n = r["q_n"]
        numbers = [np.frombuffer(r[f"q_{c}"], "<i8") for c in ("q", "own", "label", "low", "high")]
        return Queries(*numbers, _unpacked(r["q_kind"], r["q_x"], r["q_dim"], n), np.full((n, k), NONE),
                       np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, Queries] = OrderedDict()
        last, tile = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("block", "rows")}
                if r["rows"] != last:
                    last, tile = r["rows"], Tile(batch.slice(i, 1).to_pylist()[0])
                if r["block"] not in held:
                    if len(held) >= HELD:
                        yield held.popitem(last=False)[1].found()
                    held[r["block"]] = unpack(batch.slice(i, 1).to_pylist()[0])
                held.move_to_end(r["block"])
                tile.search(held[r["block"]], same_label)
        for block in held.values():
            yield block.found()

    found = pairs.mapInArrow(run, "q long, row long, id long, no_id boolean, score long")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "no_id", "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of every anchor.

    ``vectors`` has whole-number vectors (``quantised``); ``anchors`` is a condition on ``id_col``. An anchor's positives
    are the first ``positives`` other rows of its label by inner product, ties by id. For each, its negatives are the first
    ``negatives`` rows of another label with low * positive_score <= 100 * negative_score <= high * positive_score.
    Both searches go over all rows through one R-tree.

    Defined cases: rows with a null label, a null vector or a null component take no part; every other row does, also
    repeated ones, each as a row of its own (equal ids tie); a null id is no anchor and comes last among ties; vectors are
    compared with those of the same length only, and empty ones score 0; an anchor without positives or a positive
    without negatives gives no rows; an empty table gives none; further columns are ignored. Scores must stay below
    2^55 in size, sums are exact up to there.
    """
    usable_rows = vectors.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()
                                & F.forall(F.col(vec_col), lambda x: x.isNotNull()))
    index = build_index(usable_rows, id_col, vec_col, label_col)
    wanted = materialize(index.rows.withColumn(id_col, F.when(~F.col("no_id"), F.col("id"))).where(anchors)
                         .select("row", "id", "label", "x", "dim", "region"), "rtree-anchors")
    n = wanted.count()
    wide_open = [F.lit(-(1 << 63)).cast("long").alias("low"), F.lit((1 << 63) - 1).cast("long").alias("high")]
    asked = wanted.select(F.col("row").alias("q"), F.col("row").alias("own"), "label", "x", "dim", "region", *wide_open)
    near = materialize(search(index, asked, n, positives, True).select(
        F.monotonically_increasing_id().alias("pair"), F.col("q").alias("anchor"),
        F.when(~F.col("no_id"), F.col("id")).alias("positive_id"), F.col("score").alias("positive_score")), "rtree-positives")
    asked = near.join(wanted, F.col("anchor") == F.col("row")).select(
        F.col("pair").alias("q"), F.col("row").alias("own"), "label", "x", "dim", "region",
        (F.lit(low) * F.col("positive_score")).alias("low"), (F.lit(high) * F.col("positive_score")).alias("high"))
    far = search(index, asked, n * positives, negatives, False).select(
        F.col("q").alias("n_pair"), "rank", F.when(~F.col("no_id"), F.col("id")).alias("negative_id"),
        F.col("score").alias("negative_score"))
    names = wanted.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id"))
    return (far.join(near, F.col("n_pair") == F.col("pair")).join(names, F.col("anchor") == F.col("a_row"))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
