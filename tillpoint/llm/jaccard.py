"""Exact n-gram Jaccard self-join of documents and its groups, through prefix trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import whole
from tillpoint.llm.components import components
from tillpoint.llm.trie import PrefixTree
from tillpoint.session import materialize

#: Sets of up to this size show all members to the test for partners, longer ones a fixed share of the hash space.
SMALL = 64
#: Sets that one prefix tree holds, about, and their members together, unless a single set has more.
BLOCK, BLOCK_MEMBERS = 400, 1 << 19
#: Lists of first members that one prefix tree holds, about, and the members shown of each.
LISTS, WINDOW = 2048, 64
#: Greatest size of a bit filter (a power of 2): the proven bound of what is broadcast. More hashes than an eighth of it
#: are joined instead.
FILTER_BITS = 1 << 27
#: Members that more nodes than this begin with are moved to the end of the global order, round by round; where they
#: still come first, they are settled through hubs and blocks, all others pair by pair.
FREQUENT, ROUNDS = 48, 2
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """The set of a whole text: 64-bit hashes of its distinct n-grams in ascending order.

    A-Z are lower-cased and words parted at ASCII white space; fewer than ``n`` words are one n-gram, none are no set.
    The order of the hashes is the global order of all sets.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(h))
    if not k:
        return np.zeros(0, np.int64)
    grams = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        grams = (grams ^ h[i:len(h) - k + 1 + i]) * _M1
        grams ^= grams >> np.uint64(29)
    grams *= _M2
    grams ^= grams >> np.uint64(32)
    return np.unique(grams.view(np.int64))


def _sampled(members: np.ndarray, percent: int) -> np.ndarray:
    """Members in the share of the hash space that is shown: twice what similar sets may lack, and a little more."""
    share = min(1.0, 0.05 + 2 * (100 - percent) / 100)
    return members <= int(share * ((1 << 64) - 1)) - (1 << 63)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, node): equal texts are one node."""
    return docs.select(F.col(id_col).alias("id"), whole(text_col).alias("t"),
                       F.xxhash64(F.lit("node"), whole(text_col)).alias("node"))


def _possible(docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Nodes that may have a similar partner.

    A set with a partner shares all but a tenth (at 90 percent) of its members with it, so a set is alone if more of its
    members than that occur in no other node. To show this, a fixed share of the hash space is enough for longer sets;
    sets a little above the limit also show the rest, uncounted, for their smaller partners. One shuffle of (member,
    node) rows, summed per member on both sides of it.
    """
    margin = -(-100 * SMALL // percent)

    def show(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            member, node, counted = [], [], []
            for t, k in zip(pdf["t"], pdf["node"]):
                s = ngram_set(t, n)
                keep = _sampled(s, percent)
                count = np.ones(len(s), bool) if len(s) <= SMALL else keep
                if len(s) > margin:
                    s, count = s[keep], count[keep]
                member.append(s)
                counted.append(count)
                node.append(np.full(len(s), k))
            if member:
                yield pd.DataFrame({"member": np.concatenate(member), "node": np.concatenate(node),
                                    "counted": np.concatenate(counted)})

    shown = docs.select("t", "node").mapInPandas(show, "member long, node long, counted boolean")
    own = (shown.groupBy("member").agg(F.min("node").alias("node"), F.max("node").alias("other"),
                                       F.max("counted").alias("counted"))
           .where("node = other and counted").groupBy(F.col("node").alias("own_node")).agg(F.count(F.lit(1)).alias("own")))
    return (nodes.join(own, F.col("node") == F.col("own_node"), "left")
            .where((F.col("size") > 0) & (F.coalesce("own", F.lit(0)) <= _spare("size", percent))).select("node", "rep"))


@dataclass(frozen=True)
class BitFilter:
    """A set of hashes as bits of a bounded number: others may seem to be in it, none that is in it is missed."""

    on: np.ndarray
    bits: int

    def has(self, h: np.ndarray) -> np.ndarray:
        at = _places(h, self.bits)
        return ((self.on[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    u = h.view(np.uint64)
    return np.stack([(u >> np.uint64(s)) & np.uint64(bits - 1) for s in (0, 16, 32)]).astype(np.int64)


def bit_filter(hashes: DataFrame) -> BitFilter | None:
    """The filter of the one column ``h``: every partition marks its bits, and the marks are put together. None if there
    are too many hashes for a filter to part them from others."""
    count, bits = hashes.count(), 1 << 16
    if 8 * count > FILTER_BITS:
        return None
    while bits < min(32 * count, FILTER_BITS):
        bits *= 2
    chunk = min(bits, 1 << 19)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        on = np.zeros(bits, bool)
        for pdf in batches:
            on[_places(pdf["h"].to_numpy(np.int64), bits).ravel()] = True
        rows = [(i, np.packbits(on[i * chunk:(i + 1) * chunk]).tobytes()) for i in range(bits // chunk)
                if on[i * chunk:(i + 1) * chunk].any()]
        yield pd.DataFrame(rows, columns=["i", "b"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        both = np.bitwise_or.reduce(np.stack([np.frombuffer(b, np.uint8) for b in pdf["b"]]), axis=0)
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "b": [both.tobytes()]})

    out = np.zeros(bits // 8, np.uint8)
    for r in (hashes.mapInPandas(mark, "i int, b binary")
              .groupBy("i").applyInPandas(merge, "i int, b binary").toLocalIterator()):
        out[r["i"] * chunk // 8:(r["i"] + 1) * chunk // 8] = np.frombuffer(r["b"], np.uint8)
    return BitFilter(out, bits)


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, size, members) of the wanted nodes, from one row of each; the texts stay where they are read, unless more
    nodes are wanted than a bit filter can hold."""
    hashes = wanted.select(F.xxhash64("node", "rep").alias("h"))
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(hashes))
    keyed = docs.select("node", "t", F.xxhash64("node", "id").alias("h"))
    if shared.value is None:
        keyed = keyed.join(hashes, "h", "left_semi")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            maybe = np.ones(len(pdf), bool) if shared.value is None else shared.value.has(pdf["h"].to_numpy(np.int64))
            rows = [(k, len(s), s) for k, s in ((k, ngram_set(t, n)) for k, t in
                                                zip(pdf["node"][maybe], pdf["t"][maybe]))]
            yield pd.DataFrame(rows, columns=["node", "size", "members"])

    rows = keyed.mapInPandas(build, "node long, size long, members array<long>")
    rows = rows.where("size > 0").join(wanted.select(F.col("node").alias("w")), F.col("node") == F.col("w"), "left_semi")
    return materialize(rows, "ngram-sets")


def _linked(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that the tasks find; ``tasks`` has (task, side, node, comp): side 0 is the tree, side 1 probes.

    A task whose probes are also its tree has rows of side 0 only. Links that join nothing new within the task, given
    the components that its nodes are already in, are left out.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["side", "node"])
        side = [pdf[pdf["side"] == k] for k in (0, 1)]
        if side[1].empty:
            side[1] = side[0]
        sets = [[np.asarray(m) for m in s["members"]] for s in side]
        tree, probe = PrefixTree(sets[0]).join(sets[1], percent)
        node = [s["node"].tolist() for s in side]
        root: dict[int, int] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for s in side:
            for a, c in zip(s["node"], s["comp"]):
                root[find(("n", a))] = find(("c", c))
        out = []
        for i, j in zip(tree.tolist(), probe.tolist()):
            a, b = find(("n", node[0][i])), find(("n", node[1][j]))
            if a != b:
                root[a] = b
                out.append((node[0][i], node[1][j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)

    rows = tasks.join(sets.withColumnRenamed("node", "s_node"), F.col("node") == F.col("s_node"))
    return rows.select("task", "side", "node", "comp", "members").groupBy("task").applyInPandas(run, "u long, v long")


def _spare(size: str, percent: int):
    """Members of a set that a similar one may lack, at most."""
    return F.expr(f"{size} - ({percent} * {size} + 99) div 100")


def _first_members(sets: DataFrame, percent: int, last: DataFrame | None) -> DataFrame:
    """(member, node, size) of the first members of each set in the global order: by hash, those of ``last`` (its column
    ``h``) at the end, marked by a bit filter or, if they are too many for one, by a join.

    Two similar sets have one of their first ``spare + 1`` members in common, and of twice as many at least the lesser
    ``spare + 1``. That holds in any order that is the same for all sets.
    """
    marks = None if last is None else bit_filter(last)
    if last is not None and marks is None:
        late = (sets.select("node", "size", F.explode("members").alias("member"))
                .join(last, F.col("member") == F.col("h"), "left"))
        ordered = late.groupBy("node", "size").agg(
            F.sort_array(F.collect_set(F.struct(F.col("h").isNotNull().alias("late"), "member"))).alias("s"))
        count = (2 * _spare("size", percent) + 1).cast("int")
        return ordered.select(F.explode(F.slice("s.member", F.lit(1), count)).alias("member"), "node", "size")
    shared = sets.sparkSession.sparkContext.broadcast(marks)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            member, node, size = [], [], []
            for k, m in zip(pdf["node"], pdf["members"]):
                m = np.asarray(m, np.int64)
                n = 2 * (len(m) - -(-percent * len(m) // 100)) + 1
                if shared.value is not None:
                    m = m[np.argsort(shared.value.has(m), kind="stable")]
                member.append(m[:n])
                node.append(np.full(len(member[-1]), k))
                size.append(np.full(len(member[-1]), len(m)))
            if member:
                yield pd.DataFrame({"member": np.concatenate(member), "node": np.concatenate(node),
                                    "size": np.concatenate(size)})

    return sets.select("node", "members").mapInPandas(first, "member long, node long, size long")


def _prefixes(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """First members of all sets and, per member that several sets begin with, their number.

    Members that many sets begin with are put last and the next ones come first instead, for a few rounds: what is left
    in front is rare, or belongs to a large group of similar sets.
    """
    frequent = None
    for k in range(ROUNDS + 1):
        prefixes = materialize(_first_members(sets, percent, frequent), f"first-members-{k}")
        counts = materialize(prefixes.groupBy("member").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"counts-{k}")
        more = counts.where(F.col("n") > FREQUENT).select(F.col("member").alias("h"))
        if k == ROUNDS or more.isEmpty():
            return prefixes, counts
        frequent = more if frequent is None else frequent.unionByName(more).distinct()


def _blocks(size: str = "size"):
    """Into how many blocks a group is cut: by its sets and by their members."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(size) / BLOCK_MEMBERS))


def _hub_tasks(pairs: DataFrame) -> DataFrame:
    """Tasks that compare a hub with its nodes, from (hub, node, size of the node), in chunks of a bounded size."""
    counts = pairs.groupBy(F.col("hub").alias("c_hub")).agg(_blocks().alias("n"))
    dealt = (pairs.join(counts, F.col("hub") == F.col("c_hub"))
             .withColumn("task", F.struct("hub", F.pmod(F.xxhash64("node"), F.col("n")).alias("part"))))
    tree = dealt.select("task", F.lit(0).alias("side"), "node", F.col("node").alias("comp"))
    probe = dealt.select("task", F.lit(1).alias("side"), F.col("hub").alias("node"), F.col("hub").alias("comp")).distinct()
    return tree.unionByName(probe)


def _star_pairs(frequent: DataFrame, percent: int) -> DataFrame:
    """For every frequent member, the least node that has it (the hub) and each other node that has it."""
    hubs = frequent.groupBy(F.col("member").alias("m")).agg(F.min(F.struct("node", "size")).alias("hub"))
    return (frequent.join(hubs, F.col("member") == F.col("m"))
            .where((F.col("node") != F.col("hub.node"))
                   & (100 * F.least("size", "hub.size") >= percent * F.greatest("size", "hub.size")))
            .select(F.col("hub.node").alias("hub"), "node", "size").distinct())


def _rare_pairs(prefixes: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """(hub, node, size of the node): pairs of nodes that may have enough of the other first members in common.

    At most ``FREQUENT`` nodes have such a member. A similar pair that has no frequent member in common has more of
    these in common than the smaller set can spare. The first members of a node are a list, rarest first; the list from each
    member on that enough others follow goes to the task of that member, ``WINDOW`` members of it, with the number of
    those left out. A task holds the lists of many members in one prefix tree (``PrefixTree.meet``). Members are shown
    by half of their hash, which can only add pairs; all are confirmed on whole sets.
    """
    few = counts.where(F.col("n") <= FREQUENT).select(F.col("member").alias("m"), "n")
    lists = (prefixes.join(few, F.col("member") == F.col("m")).groupBy("node", "size")
             .agg(F.sort_array(F.collect_set(F.struct("n", "member"))).alias("s"))
             .select("node", "size", F.expr("transform(s, x -> cast(x.member & 2147483647L as int))").alias("list"),
                     F.expr(f"({percent} * size + 99) div 100").alias("least")))
    lists = lists.withColumn("starts", (F.size("list") - _spare("least", percent)).cast("int")).where("starts > 0")
    lists = materialize(lists.select("node", "size", "list", "starts"), "rare-lists")
    total = lists.agg(F.sum("starts")).first()[0] or 0
    rows = (lists.select("node", "size", "list", F.explode(F.sequence(F.lit(1), F.col("starts"))).alias("i"))
            .select("node", "size", F.expr(f"slice(list, i, {WINDOW})").alias("part"),
                    F.greatest(F.lit(0), F.size("list") - F.col("i") + 1 - WINDOW).alias("rest"),
                    F.pmod(F.xxhash64(F.expr("list[i - 1]")), F.lit(-(-total // LISTS) or 1)).alias("task")))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        node, size = pdf["node"].to_numpy(np.int64), pdf["size"].to_numpy(np.int64)
        tree = PrefixTree([np.asarray(m, np.int64) for m in pdf["part"]])
        i, j = tree.meet(size, pdf["rest"].to_numpy(np.int64), percent)
        i, j = np.where(node[i] <= node[j], i, j), np.where(node[i] <= node[j], j, i)
        out = pd.DataFrame({"hub": node[i], "node": node[j], "size": size[j]})
        return out[out["hub"] != out["node"]].drop_duplicates()

    return (rows.groupBy("task").applyInPandas(search, "hub long, node long, size long")).distinct()


def _block_tasks(frequent: DataFrame, known: DataFrame) -> DataFrame | None:
    """What the hubs have left open: frequent members whose nodes are not all in one component.

    Nodes that such members connect form clusters, a cluster is cut into blocks (nodes of one component together, a
    large component in several), and every two blocks meet in a task, unless both hold the same component only.
    """
    rows = (frequent.join(known.select(F.col("node").alias("k"), "comp"), F.col("node") == F.col("k"), "left")
            .select("member", "node", "size", F.coalesce("comp", "node").alias("comp")))
    open_members = (rows.groupBy("member").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                               F.min("node").alias("first"))
                    .where("c0 <> c1").select(F.col("member").alias("m"), "first"))
    edges = (rows.join(open_members, F.col("member") == F.col("m"))
             .select(F.col("first").alias("u"), F.col("node").alias("v"), "size", "comp").distinct())
    edges = materialize(edges, "open-edges")
    if edges.isEmpty():
        return None
    clusters = components(edges, "clusters")
    members = edges.select(F.col("v").alias("node"), "size", "comp").distinct()
    members = materialize(members.join(clusters.select(F.col("node").alias("k"), F.col("comp").alias("cluster")),
                                       F.col("node") == F.col("k")).select("node", "size", "comp", "cluster"), "open-nodes")
    sizes = members.groupBy(F.col("cluster").alias("s_cluster")).agg(_blocks().alias("n"))
    comps = members.groupBy(F.col("cluster").alias("p_cluster"), F.col("comp").alias("p_comp")).agg(_blocks().alias("p"))
    large = F.col("p") > 1
    block = F.struct(F.when(large, F.col("comp")).alias("comp"), F.when(large, F.pmod(
        F.xxhash64("node"), F.col("p"))).otherwise(F.pmod(F.xxhash64("comp"), F.col("n"))).alias("part"))
    dealt = (members.join(sizes, F.col("cluster") == F.col("s_cluster"))
             .join(comps, (F.col("cluster") == F.col("p_cluster")) & (F.col("comp") == F.col("p_comp")))
             .select("node", "comp", "cluster", block.alias("block")))
    dealt = materialize(dealt, "open-blocks")
    blocks = dealt.select("cluster", "block").distinct()  # a few hundred nodes each
    a = blocks.select(F.col("cluster").alias("c"), F.col("block").alias("a"))
    b = blocks.select(F.col("cluster").alias("d"), F.col("block").alias("b"))
    meet = (a.join(b, (F.col("c") == F.col("d")) & (F.col("a") <= F.col("b")))
            .where(F.col("a.comp").isNull() | ~F.col("a.comp").eqNullSafe(F.col("b.comp"))).select("c", "a", "b"))
    sides = meet.select("c", F.struct("c", "a", "b").alias("task"), F.lit(0).alias("side"), F.col("a").alias("of")).unionByName(
        meet.where("a <> b").select("c", F.struct("c", "a", "b").alias("task"), F.lit(1).alias("side"),
                                    F.col("b").alias("of")))
    return (dealt.join(sides, (F.col("cluster") == F.col("c")) & F.col("block").eqNullSafe(F.col("of")))
            .select("task", "side", "node", "comp"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                   percent: int = 90) -> DataFrame:
    """(id, node, n_shingles, component_id) of every row: groups of documents connected by a similarity of ``percent``.

    1. Equal texts are one node. 2. Nodes with too many members of their own are alone. 3. The sets of the others are
    built. Similar sets have some of their first members in common, in an order by hash with frequent members last. For a member that many nodes begin
    with, the least node is compared with all others, which settles a group of any size in time linear in it if its
    members resemble the hub; what that leaves open is compared block by block. For other members, prefix trees of the
    first members from each of them on give the pairs that have enough in common. All pairs are confirmed in prefix
    trees of the ordered sets. 4. Components of all links; the least id names one.

    No pairs within a group are listed; a task holds about two blocks of sets. N-grams are compared by 64-bit hashes.

    Defined cases: null and empty texts and texts without words have no members and are linked with nothing, not even
    each other; fewer words than ``n`` are one n-gram; repeated rows each come out, with the same component; null ids
    are linked too, but never name a component unless all its ids are null; components of equal least id share a name
    (``drop_copies`` does not go by it); an empty table gives none; further columns are ignored.
    """
    return _named_groups(docs, id_col, text_col, n, percent).drop("comp")


def _named_groups(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """``jaccard_groups`` with ``comp``, the least node of the component, which tells apart those of one name."""
    texts = _documents(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.array([len(ngram_set(t, n)) for t in batch.column("t").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("node"), size], names=["id", "node", "size"])

    slim = materialize(texts.mapInArrow(measure, f"id {kind}, node long, size long"), "ngram-sizes")
    nodes = slim.groupBy("node").agg(F.min("size").alias("size"), F.min("id").alias("rep"))
    wanted = materialize(_possible(texts, nodes, n, percent), "possible")
    sets = _sets(texts, wanted, n)
    prefixes, counts = _prefixes(sets, percent)
    often = counts.where(F.col("n") > FREQUENT).select(F.col("member").alias("m"))
    frequent = materialize(prefixes.join(often, F.col("member") == F.col("m")).select("member", "node", "size"),
                           "frequent-rows")
    star = materialize(_star_pairs(frequent, percent), "hub-pairs")
    links = materialize(_linked(_hub_tasks(star), sets, percent), "links")
    blocks = None if frequent.isEmpty() else _block_tasks(frequent, components(links, "groups"))
    pairs = materialize(_rare_pairs(prefixes, counts, percent), "pairs")
    links = links.unionByName(materialize(_linked(_hub_tasks(pairs), sets, percent), "links"))
    if blocks is not None:
        links = links.unionByName(materialize(_linked(blocks, sets, percent), "links"))
    known = components(links, "groups")
    named = (slim.join(known.select(F.col("node").alias("k"), "comp"), F.col("node") == F.col("k"), "left")
             .select("id", "node", "size", F.coalesce("comp", "node").alias("comp")))
    least = named.where("size > 0").groupBy(F.col("comp").alias("l_comp")).agg(F.min("id").alias("least"))
    least = materialize(least, "group-names")
    return (named.join(least, F.col("comp") == F.col("l_comp"), "left")
            .select(F.col("id").alias(id_col), "node", F.col("size").alias("n_shingles"), named["comp"],
                    F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                percent: int = 90) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one document of each group: the least id stays.

    Texts without words stay. A group is a component, not its name: texts that are not linked all stay, whether their ids
    are null or repeat. Of repeated rows (equal id and text) one stays; where ids repeat within a group, the least
    text hash decides.
    """
    groups = materialize(_named_groups(docs, id_col, text_col, n, percent), "jaccard-groups")
    empty = groups.where("n_shingles = 0").select(id_col, "node")
    stay = (groups.where("n_shingles > 0").groupBy("comp")
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col("node"))).alias("s"))
            .select(F.col("s.id").alias(id_col), F.col("s.node").alias("node")).unionByName(empty))
    stay = stay.select(F.col(id_col).alias("s_id"), F.col("node").alias("s_node")).distinct()
    rows = docs.withColumn("__node", F.xxhash64(F.lit("node"), whole(text_col)))
    kept = rows.join(stay, rows[id_col].eqNullSafe(stay["s_id"]) & (rows["__node"] == stay["s_node"]), "left_semi")
    return kept.dropDuplicates([id_col, "__node"]).select(*docs.columns)
