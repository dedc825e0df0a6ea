"""``make_set(x, n)`` without collecting a group into one buffer.

The set of a group is defined as its n smallest distinct non-empty values
(sorted, so results are reproducible). All requested sets of an
aggregation are computed in one pass:

1. stack (keys, set id, value) rows and drop duplicates — partial
   aggregation removes repeats before the shuffle;
2. ``row_number()`` per (keys, set id) ordered by value, kept where <= n.
   Catalyst plans this as a partial ``WindowGroupLimit`` before the
   exchange, so each map partition sends at most n values per group even
   when one group holds a third of all rows;
3. ``collect_list`` of at most n values per group and set.

Sets without a cap (``n=None``) are the full distinct set; use them only
for small domains (categories, codes, levels, statement kinds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded_sets(df: DataFrame, keys: Sequence[str],
                 specs: Sequence[tuple[str, Column | str, int]]) -> DataFrame:
    """(keys..., <name> array<string> per spec) for specs (name, value, n)."""
    items = [F.struct(F.lit(i).alias("sid"), F.col(v).cast("string").alias("val")
                      if isinstance(v, str) else v.cast("string").alias("val"))
             for i, (_, v, _) in enumerate(specs)]
    stacked = (df.select(*keys, F.explode(F.array(*items)).alias("it"))
               .select(*keys, "it.sid", "it.val")
               .where(F.col("val").isNotNull() & (F.col("val") != ""))
               .dropDuplicates([*keys, "sid", "val"]))
    w = Window.partitionBy(*keys, "sid").orderBy("val")
    limit = max(n for _, _, n in specs)
    ranked = stacked.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= limit)
    per_spec = F.create_map(*[x for i, (_, _, n) in enumerate(specs) for x in (F.lit(i), F.lit(n))])
    ranked = ranked.where(F.col("rn") <= per_spec[F.col("sid")])
    aggs = [F.array_sort(F.collect_list(F.when(F.col("sid") == i, F.col("val")))).alias(name)
            for i, (name, _, _) in enumerate(specs)]
    return ranked.groupBy(*keys).agg(*aggs)


def attach_sets(agg: DataFrame, df: DataFrame, keys: Sequence[str],
                specs: Sequence[tuple[str, Column | str, int]]) -> DataFrame:
    """Left-join ``bounded_sets`` onto an aggregate on its group keys
    (null-safe); groups without values get an empty array."""
    if not specs:
        return agg
    sets = bounded_sets(df, keys, specs)
    sets = sets.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[n for n, _, _ in specs])
    cond = [agg[k].eqNullSafe(sets[f"__k_{k}"]) for k in keys]
    out = agg.join(sets, cond, "left").drop(*[f"__k_{k}" for k in keys])
    empty = F.array().cast("array<string>")
    return out.withColumns({n: F.coalesce(F.col(n), empty) for n, _, _ in specs})


def aggregate_with_sets(df: DataFrame, keys: Sequence[str],
                        aggs: Sequence[tuple[str, str, Column | str | None]],
                        sets: Sequence[tuple[str, Column | str, int]] = ()) -> DataFrame:
    """One-pass ``summarize`` with bounded ``make_set(x, n)`` columns.

    ``aggs``: (name, kind, column) with kind in count / count_if / min / max /
    small_set / dcount (distinct non-empty values, exact).
    ``sets``: (name, value, n) -> the n smallest distinct non-empty values.

    Each row is stacked into a "base" item (set id -1, carries the row's
    metric inputs) plus one item per set value, so the raw rows are scanned
    and shuffled once:
      1. group by (keys, set id, value): base items aggregate the metrics,
         set items become distinct values (map-side combine first);
      2. ``row_number`` per (keys, set id) ordered by value, kept <= n, with
         a partial WindowGroupLimit before the exchange, so a hot group
         sends at most n values per set from each partition;
      3. group by keys to assemble metrics and sorted sets.
    A ``dcount`` column is one more stacked value whose stage-1 groups are
    counted per key (no cap) in a second, column-pruned branch.
    """
    if not sets:
        out = []
        for name, kind, c in aggs:
            out.append(_plain_agg(kind, c).alias(name))
        return df.groupBy(*keys).agg(*out)
    base_item = F.struct(F.lit(-1).alias("sid"), F.lit(None).cast("string").alias("val"))
    dsid = {j: len(sets) + k for k, j in enumerate(j for j, (_, kind, _) in enumerate(aggs) if kind == "dcount")}
    items = [base_item] + [F.struct(F.lit(i).alias("sid"),
                                    (F.col(v) if isinstance(v, str) else v).cast("string").alias("val"))
                           for i, (_, v, _) in enumerate(sets)]
    items += [F.struct(F.lit(dsid[j]).alias("sid"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("val"))
              for j, (_, kind, c) in enumerate(aggs) if kind == "dcount"]
    inputs = [(f"__a{j}", (F.col(c) if isinstance(c, str) else c)) for j, (_, kind, c) in enumerate(aggs)
              if kind not in ("count", "dcount")]
    x = (df.select(*keys, *[c.alias(n) for n, c in inputs], F.explode(F.array(*items)).alias("__it"))
         .select(*keys, *[n for n, _ in inputs], F.col("__it.sid").alias("sid"), F.col("__it.val").alias("val"))
         .where((F.col("sid") == -1) | (F.col("val").isNotNull() & (F.col("val") != ""))))
    is_base = F.col("sid") == -1
    stage1 = [F.count(F.lit(1)).alias("__c")]
    for j, (name, kind, c) in enumerate(aggs):
        if kind in ("count", "dcount"):
            continue
        a = F.col(f"__a{j}")
        if kind == "count_if":
            stage1.append(F.count_if(is_base & a).alias(f"__a{j}"))
        elif kind == "min":
            stage1.append(F.min(F.when(is_base, a)).alias(f"__a{j}"))
        elif kind == "max":
            stage1.append(F.max(F.when(is_base, a)).alias(f"__a{j}"))
        elif kind == "small_set":
            stage1.append(F.collect_set(F.when(is_base & (a != ""), a)).alias(f"__a{j}"))
        else:
            raise ValueError(kind)
    g = x.groupBy(*keys, "sid", "val").agg(*stage1)
    dcounts = None
    if dsid:
        # Distinct counts: one (keys, value) group per distinct value, counted
        # per key. Catalyst prunes this branch's stage 1 to the columns it
        # needs, so it is planned as its own (narrow) scan and aggregation.
        dcounts = (g.where(F.col("sid") >= len(sets))
                   .groupBy(*keys).agg(*[F.count_if(F.col("sid") == sid).alias(f"__d{j}") for j, sid in dsid.items()]))
        g = g.where(F.col("sid") < len(sets))
    limit = max(n for _, _, n in sets)
    caps = F.create_map(F.lit(-1), F.lit(1), *[x for i, (_, _, n) in enumerate(sets) for x in (F.lit(i), F.lit(n))])
    w = Window.partitionBy(*keys, "sid").orderBy("val")
    g = g.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= limit)
    g = g.where(F.col("__rn") <= caps[F.col("sid")])
    final = []
    for j, (name, kind, c) in enumerate(aggs):
        if kind == "count":
            final.append(F.sum(F.when(is_base, F.col("__c"))).cast("long").alias(name))
            continue
        if kind == "dcount":
            continue
        a = F.col(f"__a{j}")
        if kind == "count_if":
            final.append(F.sum(F.when(is_base, a)).cast("long").alias(name))
        elif kind == "small_set":
            final.append(F.array_sort(F.max(F.when(is_base, a))).alias(name))
        elif kind == "min":
            final.append(F.min(F.when(is_base, a)).alias(name))
        else:
            final.append(F.max(F.when(is_base, a)).alias(name))
    for i, (name, _, _) in enumerate(sets):
        final.append(F.array_sort(F.collect_list(F.when(F.col("sid") == i, F.col("val")))).alias(name))
    out = g.groupBy(*keys).agg(*final)
    if dcounts is not None:
        d = dcounts.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in dcounts.columns if c.startswith("__d")])
        out = out.join(d, [out[k].eqNullSafe(d[f"__k_{k}"]) for k in keys], "left")
        out = out.select(*keys, *[(F.coalesce(F.col(f"__d{j}"), F.lit(0)).cast("long").alias(name)
                                   if kind == "dcount" else F.col(name)) for j, (name, kind, _) in enumerate(aggs)],
                         *[n for n, _, _ in sets])
    return out


def _plain_agg(kind: str, c) -> Column:
    if kind == "count":
        return F.count(F.lit(1))
    c = F.col(c) if isinstance(c, str) else c
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    if kind == "small_set":
        return small_set(c)
    if kind == "count_if":
        return F.count_if(c)
    if kind == "dcount":
        return F.count_distinct(F.when(c != "", c))
    raise ValueError(kind)


def small_set(c: Column | str) -> Column:
    """``make_set(x)`` over a small domain: sorted distinct non-empty values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_sort(F.collect_set(F.when(c != "", c)))


def join_set(c: Column | str, sep: str = ", ") -> Column:
    """``strcat_array(set, sep)``."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, sep)


#: A cap no set of a small domain reaches.
_WHOLE = 2**31 - 1


def merge_partials(parts: DataFrame, keys: Sequence[str], *, sums: Sequence[str] = (), mins: Sequence[str] = (),
                   maxs: Sequence[str] = (), sets: Sequence[tuple[str, int | None]] = ()) -> DataFrame:
    """One row per key from partial rows that hold sums, extremes and bounded sets.

    A bounded set merges exactly: the n smallest of a union are among the n smallest
    of its parts. ``sets``: (array column, n or None for all of a small domain). Set
    values are stacked next to the partial rows and ranked per key and set, so that
    no key's sets are gathered before they are cut to n.
    """
    def stacked(sid: int, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(sid).alias("sid"), v.alias("val")))

    items = [stacked(-1, F.array(F.lit(None).cast("string")))]
    items += [stacked(i, F.coalesce(F.col(name), F.array().cast("array<string>"))) for i, (name, _) in enumerate(sets)]
    plain = [*sums, *mins, *maxs]
    x = parts.select(*keys, *plain, F.explode(F.concat(*items)).alias("__it")).select(
        *keys, *plain, "__it.sid", "__it.val")
    base = F.col("sid") == -1
    g = x.groupBy(*keys, "sid", "val").agg(
        *[F.sum(F.when(base, F.col(c))).alias(c) for c in sums],
        *[F.min(F.when(base, F.col(c))).alias(c) for c in mins],
        *[F.max(F.when(base, F.col(c))).alias(c) for c in maxs])
    if sets:
        caps = F.create_map(F.lit(-1), F.lit(1), *[F.lit(v) for i, (_, n) in enumerate(sets) for v in (i, n or _WHOLE)])
        w = Window.partitionBy(*keys, "sid").orderBy("val")
        g = g.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= caps[F.col("sid")])
    return g.groupBy(*keys).agg(
        *[F.max(F.when(base, F.col(c))).cast("long").alias(c) for c in sums],
        *[F.max(F.when(base, F.col(c))).alias(c) for c in [*mins, *maxs]],
        *[F.array_sort(F.collect_list(F.when(F.col("sid") == i, F.col("val")))).alias(name)
          for i, (name, _) in enumerate(sets)])
