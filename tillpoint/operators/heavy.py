"""Heavy products (F8) from bounded summaries: one pass finds candidates with a proven bound, a second sums only those.

A grouped sum shuffles every product that a task saw. Here a task keeps at most ``counters`` products per group (a weighted
Misra-Gries summary): where it has more, it subtracts the largest weight left out from those kept and adds that cut to the
group's error. Summaries add up, so over all tasks a product's positive amounts lie between its estimate and estimate + error,
and its sum between estimate - negatives and estimate + error, also for a product that no summary holds (estimate 0).

* A group that was never cut has exact sums already.
* Where the k-th largest lower bound is above the error, only products whose upper bound reaches it can be among the first k
  (ties included): their rows alone are read again and summed exactly.
* Any other group (no product stands out) is summed over all its products. The result is exact for every input.

A task's memory is bounded: beyond ``budget`` entries it cuts, and if many groups keep it full it hands its summary out and
starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.numeric import cents, from_cents
from tillpoint.operators.features import TOP_K_PRODUCTS, month_key
from tillpoint.session import materialize

#: Products that a task keeps per group.
COUNTERS = 256
#: Entries that a task holds before it cuts.
BUDGET = 500_000
#: Rows that a task gathers at least before it adds them to its summary.
GATHER = 65_536


def _group_codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """A number per row, equal for equal keys; null is a key like any other."""
    codes = np.zeros(table.num_rows, dtype=np.int64)
    for k in keys:
        column = table[k].combine_chunks().dictionary_encode(null_encoding="encode")
        codes = codes * (len(column.dictionary) + 1) + column.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(codes, return_inverse=True)[1].reshape(-1).astype(np.int64)
    return codes


def _cut(state: pa.Table, keys: list[str], counters: int) -> tuple[pa.Table, pa.Table]:
    """At most ``counters`` entries per group, and one row (keys, corte, negativo) per group that lost any."""
    group, weight = _group_codes(state, keys), state["_w"].to_numpy()
    order = np.lexsort((-weight, group))
    g, w = group[order], weight[order]
    first = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    slot = np.cumsum(first) - 1
    rank = np.arange(len(g)) - starts[slot]
    size = np.diff(np.r_[starts, len(g)])
    full = size > counters
    cut = np.zeros(len(starts), dtype=np.int64)
    cut[full] = w[starts[full] + counters]
    left = w - cut[slot]
    keep = (rank < counters) & (~full[slot] | (left > 0))
    kept = state.take(pa.array(order[keep])).drop_columns(["_w"]).append_column("_w", pa.array(left[keep], pa.int64()))
    lost = state.select(keys).take(pa.array(order[starts[full]]))
    lost = lost.append_column("_corte", pa.array(cut[full], pa.int64())).append_column("_neg", pa.array(np.zeros(int(full.sum()), np.int64)))
    return kept, lost


def _added(parts: list[pa.Table], by: list[str], sums: list[str]) -> pa.Table:
    found = pa.concat_tables(parts).group_by(by).aggregate([(s, "sum") for s in sums])
    return found.rename_columns([c.removesuffix("_sum") if c in [f"{s}_sum" for s in sums] else c for c in found.column_names]).select([*by, *sums])


def summaries(rows: DataFrame, keys: list[str], item: str, counters: int = COUNTERS, budget: int = BUDGET) -> DataFrame:
    """Summaries of all tasks over ``rows`` (keys, item, ``_w`` bigint without nulls): product rows (``_grupo`` false) with a
    weight, and group rows (``_grupo`` true) with what was cut and the negative amounts, whose sign is dropped."""
    named = [*keys, item]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, lost, waiting, n_waiting = None, [], [], 0

        def out():
            held = _cut(state, keys, counters)
            products = held[0]
            groups = _added([*lost, held[1]], keys, ["_corte", "_neg"])
            zero = pa.array(np.zeros(products.num_rows, np.int64))
            blank = pa.nulls(groups.num_rows, state.schema.field(item).type)
            yield from (products.append_column("_corte", zero).append_column("_neg", zero)
                        .append_column("_grupo", pa.array(np.zeros(products.num_rows, bool)))).to_batches()
            yield from pa.table([*[groups[k] for k in keys], blank, pa.array(np.zeros(groups.num_rows, np.int64)), groups["_corte"],
                                 groups["_neg"], pa.array(np.ones(groups.num_rows, bool))],
                                names=[*named, "_w", "_corte", "_neg", "_grupo"]).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select([*named, "_w"])
            below = pc.less(table["_w"], 0)
            if pc.any(below).as_py():
                minus = table.filter(below)
                minus = minus.select(keys).append_column("_corte", pa.array(np.zeros(minus.num_rows, np.int64))).append_column(
                    "_neg", pc.negate(minus["_w"]))
                lost = [_added([*lost, minus], keys, ["_corte", "_neg"])]
            table = table.set_column(len(named), "_w", pc.max_element_wise(table["_w"], pa.scalar(0, pa.int64())))
            waiting.append(table)
            n_waiting += table.num_rows
            # as many rows as the summary has entries: adding a batch at a time would go over all of them for each
            if n_waiting < min(budget, max(GATHER, 0 if state is None else state.num_rows)):
                continue
            state = _added(waiting if state is None else [state, *waiting], named, ["_w"])
            waiting, n_waiting = [], 0
            if state.num_rows > budget:
                state, cut = _cut(state, keys, counters)
                lost = [_added([*lost, cut], keys, ["_corte", "_neg"])]
                if state.num_rows > budget // 2 or lost[0].num_rows > budget:
                    yield from out()
                    state, lost = None, []
                    pa.default_memory_pool().release_unused()
        if waiting:
            state = _added(waiting if state is None else [state, *waiting], named, ["_w"])
        if state is not None:
            yield from out()

    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*[f"`{c}` {fields[c]}" for c in named], "_w bigint", "_corte bigint", "_neg bigint", "_grupo boolean"])
    return rows.select(*named, "_w").mapInArrow(summarise, schema)


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in columns])


def _first(sums: DataFrame, keys: list[str], item: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_w"), F.asc(item)))
    return sums.withColumn("rank", place).where(F.col("rank") <= k)


def top_k(rows: DataFrame, keys: list[str], item: str, weight: Column, k: int, counters: int = COUNTERS,
          budget: int = BUDGET) -> DataFrame:
    """(keys, item, ``_w``, rank): the ``k`` items of largest summed ``weight`` (a bigint) per ``keys``, ties by the lower item.

    Exact, and equal to the grouped sum with a ranking. A missing weight counts 0; null is a key and an item like any other;
    negative weights are summed as they are; an empty input gives no row. ``counters`` must be at least ``k``. ``rows`` is read
    once for the summaries and, if any group was cut, twice more: pass a written table.
    """
    if counters < k:
        raise ValueError("counters must be at least k")
    rows = rows.select(*keys, item, F.coalesce(weight, F.lit(0)).cast("bigint").alias("_w"))
    parts = materialize(summaries(rows, keys, item, counters, budget), "resumos")
    held = parts.where("NOT _grupo").groupBy(*keys, item).agg(F.sum("_w").alias("_w"))
    cut = parts.where("_grupo")
    if cut.isEmpty():
        return _first(held, keys, item, k)
    held = materialize(held, "estimativas")
    cut = cut.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(F.sum("_corte").alias("_erro"), F.sum("_neg").alias("_neg"))
    leading = _first(held, keys, item, k)
    least = leading.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_w").alias("_kesimo"))
    # per cut group the bound that a product must reach, or null where no bound holds
    named = cut.select(*[F.col(f"_{c}").alias(c) for c in keys], "_erro", "_neg")
    groups = (named.join(least, _same(named, least, keys), "left")
              .select(*keys, "_erro", F.when((F.col("_n") >= k) & (F.col("_kesimo") - F.col("_neg") > F.col("_erro")),
                                             F.col("_kesimo") - F.col("_neg")).alias("_limite")))
    groups = materialize(groups.select(*[F.col(c).alias(f"_{c}") for c in keys], "_erro", "_limite"), "grupos")
    wanted = (held.join(groups.where("_limite IS NOT NULL"), _same(held, groups, keys))
              .where(F.col("_w") + F.col("_erro") >= F.col("_limite"))
              .select(*[F.col(c).alias(f"_{c}") for c in [*keys, item]]))
    unbounded = groups.where("_limite IS NULL")
    exact = [leading.drop("rank").join(groups, _same(leading, groups, keys), "left_anti")]
    for part, columns in ((wanted, [*keys, item]), (unbounded, keys)):
        exact.append(rows.join(part, _same(rows, part, columns), "left_semi").groupBy(*keys, item).agg(F.sum("_w").alias("_w")))
    return _first(reduce(DataFrame.unionByName, exact), keys, item, k)


def top_produtos(vendas: DataFrame, k: int = TOP_K_PRODUCTS, by_store: bool = True, counters: int = COUNTERS,
                 budget: int = BUDGET) -> DataFrame:
    """F8 by summaries: the top ``k`` products by revenue per store and month, or per month of the whole chain."""
    keys = ["loja_id", "mes"] if by_store else ["mes"]
    rows = vendas.withColumn("mes", month_key())
    found = top_k(rows, keys, "produto_id", cents("valor_total", vendas), k, counters, budget)
    return found.select(*keys, "produto_id", from_cents("_w").alias("receita"), F.col("rank").cast("bigint").alias("rank"))
