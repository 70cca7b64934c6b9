"""Panel operators: labels, first-valid collapse, wide pivot, calendar densify,
window splits, profile, as-of carry-forward, melt.

SURVEY 2.4-2.8: A1-A5, A13, J4-J6, J9, R1-R4, F2, S13, T10, X10.

The long (entity, time) form is canonical; the wide form is an export for a
bounded entity list (its width is 6 x entities columns).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggs import first_valid
from ..functions.exprs import UNKNOWN_LABEL, col as order_col, format_entity, format_ticker, pack_order_key
from ..session import ensure_checkpoint_dir
from .clean import any_not_null
from .index import ordinal_index

STEP_INTERVALS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "hour": "INTERVAL 1 HOUR"}
#: Steps of whole days.
STEP_DAYS = {"day": 1, "week": 7}


# --------------------------------------------------------------------------- keys


def entity_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys, sorted."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key)


# ------------------------------------------------------------------------- labels


def last_label(df: DataFrame, entity: str, label: str, order: str | Column,
               default: str = UNKNOWN_LABEL, out: str = "label") -> DataFrame:
    """A1 + X3 + J4: last non-null label per entity in ``order``; blank/missing -> default.

    A dictionary aggregate: the highest order of every (entity, label), a
    number in a hashed buffer with a map-side partial step, then the winner
    among an entity's distinct labels.  So only the dictionary is ranked, not
    the rows, and a hot entity costs one buffer per label and task.  Give a
    numeric order (``time_order``); a struct would sort every row.  Equal
    orders: the first label by text.
    """
    seen = (df.where(F.col(entity).isNotNull()).groupBy(entity, F.col(label).alias("_raw"))
            .agg(F.max(F.when(F.col(label).isNotNull(), order_col(order))).alias("_o")))
    best = Window.partitionBy(entity).orderBy(F.col("_o").desc_nulls_last(), "_raw")
    return (seen.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") == 1)
            .select(entity, format_ticker("_raw", default).alias(out)))


def time_order(df: DataFrame, time: str, order: str | Column) -> Column:
    """Time, then input order, as one number where the order is one of at most 31 digits (else a struct)."""
    kind = df.select(order_col(order).alias("o")).schema["o"].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)) and (not isinstance(kind, T.DecimalType) or kind.scale == 0):
        days = F.datediff(F.col(time), F.lit("0001-01-01").cast("date"))
        return pack_order_key([(days, 7), (order, 31)])
    return F.struct(F.col(time), order_col(order))


# ------------------------------------------------------------------ first valid


def first_valid_long(df: DataFrame, keys: Sequence[str], fields: Sequence[str],
                     order: str | Column) -> DataFrame:
    """A2/V1: per key, the first non-null value of every field, each field on its own.

    Several rows per key are merged field-wise, as ``pivot_table(aggfunc=
    first_valid)`` does.  Null keys vanish (F1).
    """
    keep = None
    for k in keys:
        c = F.col(k).isNotNull()
        keep = c if keep is None else keep & c
    return (df.where(keep).groupBy(*keys)
            .agg(*[first_valid(f, order).alias(f) for f in fields]))


# ------------------------------------------------------------------------ widen


def wide_names(labels: Sequence[tuple[object, str]], fields: Sequence[str],
               prefix_entity: bool | None = None) -> tuple[list[str], bool]:
    """Output names in entity-major order.

    Bare ``<label>_<field>`` unless two entities share a label (or
    ``prefix_entity`` is True): then ``<entity>_<label>_<field>``.
    """
    seen = [lab for _, lab in labels]
    collide = len(set(seen)) != len(seen)
    if prefix_entity is False and collide:
        raise ValueError("two entities share a label; use prefix_entity=True")
    prefixed = bool(prefix_entity) or (prefix_entity is None and collide)
    names = []
    for ent, lab in labels:
        stem = f"{ent}_{lab}" if prefixed else lab
        names.extend(f"{stem}_{f}" for f in fields)
    return names, prefixed


def calendar_days(lo: Column, hi: Column, step: str = "day", name: str = "timestamp") -> Column:
    """Every step between two bounds (inclusive), as a generator column."""
    return F.explode(F.sequence(lo, hi, F.expr(STEP_INTERVALS[step]))).alias(name)


def widen(df: DataFrame, entity: str, time: str, fields: Sequence[str], order: str | Column,
          label: str, prefix_entity: bool | None = None, entities: Sequence | None = None,
          id_value: object = 1) -> DataFrame:
    """Long panel -> dense wide daily panel.

    1. one aggregation per entity: label = last valid label in (time, order)
       (A1) -> names, plus first / last valued day (Q2 calendar bounds).
       The table is collected: one row per output column group, as the
       columns of a wide frame are named in its plan.  ``entities`` is the
       caller's list; for a whole panel use ``dense_long``, which has the
       same cells and no such table.
    2. one hash aggregation on (entity, day): the first valid value of every
       field (A2), map-side combined.
    3. per day of the calendar, from the first to the last date holding any
       value (Q2), the observed cells become one array with their entities'
       positions; checkpointed.
    4. an Arrow step (``_spread``) deals the array out into ``<label>_<field>``
       columns in entity-major order; missing values give NULL (J6).

    The wide step sits on a checkpoint leaf, so neither the optimizer
    nor AQE's per-stage re-planning walks thousands of columns through the
    aggregations and joins below it; the shuffles carry narrow rows only.  The
    plan holds a name and a type a column and no expression, as a projection's
    expressions are what fills the driver.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)

    if entities is not None:
        df = df.where(F.col(entity).isin(list(entities)))
    clean = df.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
    # One pass per entity: its label (A1) and its first / last valued day
    # (Q2); the global calendar bounds are reduced from these rows.
    valued_t = F.when(any_not_null(fields), F.col(time))
    spans = clean.groupBy(entity).agg(F.min(valued_t).alias("_lo"), F.max(valued_t).alias("_hi"))
    summary = last_label(clean, entity, label, time_order(clean, time, order)).join(spans, entity)
    rows = summary.orderBy(entity).collect()
    los = [r["_lo"] for r in rows if r["_lo"] is not None]
    his = [r["_hi"] for r in rows if r["_hi"] is not None]
    lo, hi = (min(los), max(his)) if los else (None, None)
    values = [r[entity] for r in rows]
    ent_text = [str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in values]
    names, _ = wide_names(list(zip(ent_text, [r["label"] for r in rows])), fields, prefix_entity)

    # Numeric fields only: a fixed-width buffer keeps this on HashAggregate
    # (a string value in the buffer would force the sort-based path).
    firsts = clean.groupBy(entity, time).agg(*[first_valid(f, order).alias(f) for f in fields])

    ent_type = df.schema[entity].dataType.simpleString()
    # One row per output column group, already in the plan's column list.
    positions = spark.createDataFrame([(v, p) for p, v in enumerate(values)], f"`{entity}` {ent_type}, _p int")
    time_type = df.schema[time].dataType
    # Only observed cells are shuffled, by day; the calendar's days (bounded by the span) are one row each
    # beside them, whose missing cell is not collected.  Checkpointed: the size of the observed cells.
    days = spark.range(1).select(calendar_days(F.lit(lo).cast(time_type), F.lit(hi).cast(time_type), name=time))
    # A struct keeps each field's own type.
    cells = (firsts.where(any_not_null(fields)).join(F.broadcast(days), time).join(F.broadcast(positions), entity)
             .select(time, F.struct("_p", *[F.col(_quote(f)).alias(f"_v{k}") for k, f in enumerate(fields)]).alias("_c")))
    none = F.lit(None).cast(cells.schema["_c"].dataType)
    observed = (cells.unionByName(days.select(time, none.alias("_c"))).groupBy(time)
                .agg(F.collect_list("_c").alias("_a")).checkpoint(eager=True))
    cells = observed.withColumn("id", F.lit(id_value)).select("id", time, "_a")
    # A task first compiles a projection over all columns: no more tasks than run at once, each with whole batches.
    n_days = (hi - lo).days + 1 if los else 0
    tasks = min(spark.sparkContext.defaultParallelism, -(-n_days // _batch_rows(len(names))))
    return _spread(cells.coalesce(max(1, tasks)), names, [df.schema[f].dataType for f in fields])


#: Cells in a batch that the wide step hands back; its cost is by column, whatever the rows.
BATCH_CELLS = 16_000_000


def _batch_rows(width: int) -> int:
    return max(1, BATCH_CELLS // max(1, width))


def _spread(cells: DataFrame, names: Sequence[str], kinds: Sequence[T.DataType]) -> DataFrame:
    """The last column, an array of structs of a position and values of ``kinds``, as columns ``names``, position by position; the columns before it stay.

    Positions that an array does not hold give NULLs.
    """
    lead, names, width = len(cells.columns) - 1, list(names), len(kinds)
    schema = T.StructType([*cells.schema.fields[:lead], *[T.StructField(n, kinds[k % width]) for k, n in enumerate(names)]])
    step, count = _batch_rows(len(names)), len(names) // width

    def wide(parts, shape):
        """The rows of ``parts`` (columns before, arrays) as one batch."""
        table = pa.Table.from_batches(parts).combine_chunks()
        n, lists = table.num_rows, pa.concat_arrays(table.column(lead).chunks)
        place, *values = lists.flatten().flatten()
        row = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
        # All days' values of an entity lie side by side.
        at = np.full(count * n, -1)
        at[place.to_numpy().astype(np.int64) * n + row] = np.arange(len(row))
        at = pa.array(at, mask=at < 0)
        by_field = [v.take(at) for v in values]
        columns = [pa.concat_arrays(table.column(i).chunks) for i in range(lead)] + [v.slice(e * n, n) for e in range(count) for v in by_field]
        if shape is None:
            shape = pa.schema([pa.field(name, c.type) for name, c in zip([*table.schema.names[:lead], *names], columns, strict=True)])
        return pa.RecordBatch.from_arrays(columns, schema=shape)

    def run(batches):
        shape, parts, held = None, [], 0
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                parts.append(batch.slice(lo, step - held))
                lo, held = lo + parts[-1].num_rows, held + parts[-1].num_rows
                if held == step:
                    out = wide(parts, shape)
                    shape, parts, held = out.schema, [], 0
                    yield out
                    del out
        if held:
            yield wide(parts, shape)

    return cells.mapInArrow(run, schema)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dense_long(df: DataFrame, entity: str, time: str, fields: Sequence[str], order: str | Column,
               label: str) -> DataFrame:
    """R1/A3/J5/J6 for any number of entities: the wide panel's cells, one row per entity and day.

    First valid values per (entity, day), the calendar from the first to the
    last day that holds any value, and the entity's label; nothing but the two
    calendar bounds comes to the driver.  The label joins the observed rows,
    so no join or sort handles the calendar's.
    """
    keyed = df.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
    firsts = first_valid_long(keyed, [entity, time], fields, order)
    labels = last_label(keyed, entity, label, time_order(keyed, time, order))
    return (densify(firsts.join(labels, entity), [entity, "label"], time, fields, span=valued_span(keyed, time, fields))
            .select(entity, "label", time, *fields))


def valued_span(df: DataFrame, time: str, fields: Sequence[str]) -> tuple:
    """Q2: the first and the last time of a row that holds any value."""
    valued = F.when(any_not_null(fields), F.col(time))
    return tuple(df.agg(F.min(valued), F.max(valued)).first())


def wide_blocks(df: DataFrame, entity: str, time: str, fields: Sequence[str], order: str | Column, label: str,
                per_block: int = 500, prefix_entity: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """R1/R2/J6 for any number of entities: the wide panel in blocks of ``per_block`` entities, and its manifest.

    manifest  ``block, position, column_name, entity, field``: every column of the wide panel in its order
              (entity-major, fields in the given order), names as in ``widen``
    blocks    ``block, time, cells``: the block's columns of one day, an array of one struct of the fields
              an entity; days run over the whole calendar

    Blocks are numbered by the entities' sorted position (``index.ordinal_index``), so no entity list
    reaches the driver; the entities are counted there, and two counts decide whether labels collide.
    A (block, day) group holds at most ``per_block`` cells; a block, observed cells on its days, lies in one task.
    """
    keyed = df.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
    labels = last_label(keyed, entity, label, time_order(keyed, time, order))
    named = labels.join(ordinal_index(keyed, entity, "_i"), entity).checkpoint(eager=True)
    if prefix_entity is None:
        both = named.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
        prefix_entity = both[0] != both[1]
    elif not prefix_entity and named.groupBy("label").count().where("count > 1").limit(1).count():
        raise ValueError("two entities share a label; use prefix_entity=True")
    stem = F.concat_ws("_", format_entity(entity), "label") if prefix_entity else F.col("label")
    block, place = F.floor(F.col("_i") / per_block).cast("int"), (F.col("_i") % per_block).cast("int")
    manifest = named.select(block.alias("block"), place.alias("_p"), F.col(entity).alias("entity"), stem.alias("_stem"),
                            F.posexplode(F.array(*map(F.lit, fields))).alias("_f", "field")).select(
        "block", (F.col("_p") * len(fields) + F.col("_f")).alias("position"), F.concat_ws("_", "_stem", "field").alias("column_name"), "entity", "field")
    firsts = first_valid_long(keyed, [entity, time], fields, order)
    # Only observed cells are dealt out, by block; a block's missing days and cells are filled in where its rows lie.
    placed = firsts.join(named.select(entity, block.alias("block"), place.alias("_p")), entity).repartition("block")
    cells = F.array_sort(F.collect_list(F.struct(F.col("_p"), F.struct(*fields).alias("v"))))
    days = densify(placed.groupBy("block", time).agg(cells.alias("_s")), ["block"], time, span=valued_span(keyed, time, fields))
    none = F.struct(*[F.lit(None).cast(df.schema[f].dataType).alias(f) for f in fields])
    size = F.least(F.lit(per_block), F.lit(named.count()) - F.col("block") * per_block).cast("int")
    # Every observed cell is followed by the empty ones up to the next.
    runs = F.transform("_s", lambda x, i: F.concat(F.array(x["v"]), F.array_repeat(none, F.coalesce(F.get("_s", i + 1)["_p"], size) - x["_p"] - 1)))
    filled = F.concat(F.array_repeat(none, F.get("_s", F.lit(0))["_p"]), F.flatten(runs))
    blocks = days.select("block", time, F.coalesce(filled, F.array_repeat(none, size)).alias("cells"))
    return manifest, blocks


def wide_block(blocks: DataFrame, manifest: DataFrame, block: int, time: str, fields: Sequence[str], id_value: object = 1) -> DataFrame:
    """One block as a wide frame ``id, time, columns``: its names, at most per_block x fields, come from the manifest."""
    names = [r[0] for r in manifest.where(F.col("block") == block).orderBy("position").select("column_name").collect()]
    spread = [f"cells[{k // len(fields)}].{_quote(fields[k % len(fields)])} AS {_quote(n)}" for k, n in enumerate(names)]
    return blocks.where(F.col("block") == block).withColumn("id", F.lit(id_value)).selectExpr("id", _quote(time), *spread)


def block_cells(blocks: DataFrame, manifest: DataFrame, time: str, fields: Sequence[str]) -> DataFrame:
    """The blocks' cells that hold a value, named by the manifest: ``block, position, column_name, time, value``."""
    at = blocks.select("block", time, F.posexplode("cells").alias("_p", "_c")).where(any_not_null([f"_c.{_quote(f)}" for f in fields]))
    # An entity's names are one row, joined before its values are dealt out one by one.
    names = (manifest.groupBy("block", F.floor(F.col("position") / len(fields)).cast("int").alias("_p"))
             .agg(F.array_sort(F.collect_list(F.struct("position", "column_name"))).alias("_n")))
    values = F.array(*[F.col(f"_c.{_quote(f)}").cast("double") for f in fields])
    each = (at.join(names, ["block", "_p"]).select("block", time, values.alias("_v"), F.explode("_n").alias("_n"))
            .withColumn("value", F.get("_v", (F.col("_n.position") % len(fields)).cast("int"))).where(F.col("value").isNotNull()))
    return each.select("block", "_n.position", "_n.column_name", time, "value")


# ----------------------------------------------------------------------- densify


def densify(df: DataFrame, keys: Sequence[str], time: str, fields: Sequence[str] | None = None,
            bounds: str = "global", step: str = "day", span: tuple | None = None) -> DataFrame:
    """Re-index every series onto the full calendar.

    ``bounds="global"``: one span for all keys, from the first to the last time
    at which a row holds a value (two scalars; ``span`` gives them where the
    caller has them cheaper than from ``df``); ``bounds="entity"``: each key
    spans its own valued times.  Days and weeks over a date column are filled
    in by ``_filled``, which deals out the observed rows alone.  Other steps:
    the grid is generated per key with ``explode(sequence(..))`` (no cross
    join) and left-joined to the observations on (keys, time); ``df`` is then
    read twice: materialize an expensive input first.
    """
    t = F.col(time)
    for k in keys:  # a NULL key is no series
        df = df.where(F.col(k).isNotNull())
    kind = df.schema[time].dataType
    valued = F.when(any_not_null(fields) if fields else F.lit(True), t)
    if bounds not in ("global", "entity"):
        raise ValueError("bounds must be 'global' or 'entity'")
    if bounds == "global":
        # Two scalars, fetched once (scalar sub-queries would recompute the input per bound).
        lo, hi = (F.lit(v).cast(kind) for v in (span or df.agg(F.min(valued), F.max(valued)).first()))
    else:
        lo, hi = F.col("_lo"), F.col("_hi")
    if isinstance(kind, T.DateType) and step in STEP_DAYS:
        rest = [c for c in df.columns if c not in (*keys, time)]
        if bounds == "entity":
            own = Window.partitionBy(*keys)
            df = df.withColumns({"_lo": F.min(valued).over(own), "_hi": F.max(valued).over(own)})
        return _filled(df, keys, time, rest, lo, hi, STEP_DAYS[step])
    per_key = df.groupBy(*keys).agg(F.min(valued).alias("_lo"), F.max(valued).alias("_hi"))
    grid = per_key.select(*keys, calendar_days(lo, hi, step, time))
    return grid.join(df, [*keys, time], "left")


def _filled(df: DataFrame, keys: Sequence[str], time: str, rest: Sequence[str], lo: Column, hi: Column, days: int) -> DataFrame:
    """The rows of ``df`` (``rest``: its other columns) on the calendar ``lo``, ``lo + days``, .. ``hi`` of their key, and a row without values for every other day.

    Every row also stands for the gap up to the key's next one, the first for the days before it too, so
    the calendar arises in place, after the only shuffle (by key).  Rows off the calendar give no row, but
    a key that has no other keeps its calendar.
    """
    t, at = F.col(time), F.col("_at")
    on = t.between(lo, hi) & (F.pmod(F.datediff(t, lo), F.lit(days)) == 0)
    series = Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_first())
    near = df.withColumn("_at", F.when(on, t)).withColumns(
        {"_before": F.lag("_at").over(series), "_next": F.lead("_at").over(series), "_more": F.lead(F.lit(1)).over(series)})
    start = F.when(F.col("_before").isNull(), lo).otherwise(at)
    # A repeated time stands for itself only.
    end = F.when(F.col("_next").isNull(), hi).otherwise(F.greatest(at, F.date_sub("_next", days)))
    # No calendar without bounds.
    steps = F.when(start <= end, F.sequence(F.lit(0), F.floor(F.datediff(end, start) / days).cast("int")))
    each = near.where(at.isNotNull() | F.col("_more").isNull()).select("*", start.alias("_start"), F.explode(steps).alias("_k"))
    each = each.withColumn("_day", F.date_add("_start", F.col("_k") * days))
    return each.select(*keys, F.col("_day").alias(time), *[F.when(F.col("_day") == at, F.col(_quote(c))).alias(c) for c in rest])


# ------------------------------------------------------------------------ splits


def _as_bound(v: object, kind: str = "date") -> Column:
    return F.lit(v).cast(kind)


def split_windows(df: DataFrame, windows: Mapping[str, tuple[str, str]], time: str = "timestamp",
                  all_name: str | None = "all", out: str = "split") -> DataFrame:
    """Tag rows with every window (inclusive bounds) they fall in.

    ``all`` spans the first window start to the last window end.  Rows in no
    window are dropped; a row in two windows appears once per window.
    Writing with ``partitionBy(out)`` stores all splits in one job.
    """
    tags = [F.when(F.col(time).between(_as_bound(s), _as_bound(e)), F.lit(n))
            for n, (s, e) in windows.items()]
    if all_name:
        lo = min(s for s, _ in windows.values())
        hi = max(e for _, e in windows.values())
        tags.append(F.when(F.col(time).between(_as_bound(lo), _as_bound(hi)), F.lit(all_name)))
    arr = F.filter(F.array(*tags), lambda x: x.isNotNull())
    return df.select("*", F.explode(arr).alias(out))


def select_window(df: DataFrame, window: tuple[str, str], time: str = "timestamp") -> DataFrame:
    """One window as a plain range filter (pushed down to the Parquet scan)."""
    s, e = window
    return df.where(F.col(time).between(_as_bound(s), _as_bound(e)))


def split_per_key(df: DataFrame, bounds: DataFrame, keys: Sequence[str], time: str = "timestamp",
                  out: str = "split") -> DataFrame:
    """T10 ``partition_by``: windows that differ per key, from a bounds table.

    ``bounds`` holds ``keys…, split, start, end`` (a few rows per key); rows
    are tagged by an equi-join on the keys plus a range condition.
    """
    cond = [df[k] == bounds[k] for k in keys] + [df[time].between(bounds["start"], bounds["end"])]
    return df.join(bounds, cond, "inner").select(df["*"], bounds[out])


# ----------------------------------------------------------------------- profile


def profile(df: DataFrame, id_col: str, time: str, value: str | None = None) -> DataFrame:
    """One summary row (rows, series, first/last time, null values)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(id_col).alias("n_ids"),
            F.min(time).alias("min_ts"),
            F.max(time).alias("max_ts")]
    if value is not None:
        aggs.append(F.count_if(F.col(value).isNull()).alias("n_null_value"))
    return df.agg(*aggs)


# ---------------------------------------------------------------------- as-of


def asof_fill(obs: DataFrame, series: str, time: str, value: str, lo: Column, hi: Column,
              lag_days: int = 0, out_time: str = "timestamp") -> DataFrame:
    """Carry each series' latest available observation forward onto a daily grid.

    ``obs`` holds (series, time, value) at any frequency; an observation is
    usable from ``time + lag_days`` on.  The grid is one row per series and
    day, so each window partition holds one series' calendar (bounded by the
    span), not the panel.
    """
    avail = obs.select(F.col(series), F.date_add(F.to_date(time), lag_days).alias("_d"),
                       F.col(value).alias("_v"), F.lit(0).alias("_grid"), F.col(time).alias("_t"))
    grid = (obs.select(series).distinct()
            .select(series, calendar_days(lo, hi, "day", "_d"))
            .select(series, "_d", F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_grid"),
                    F.lit(None).cast(avail.schema["_t"].dataType).alias("_t")))
    w = (Window.partitionBy(series).orderBy("_d", "_grid", "_t")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (avail.unionByName(grid)
              .withColumn("_carry", F.last("_v", ignorenulls=True).over(w)))
    return filled.where(F.col("_grid") == 1).select(series, F.col("_d").alias(out_time),
                                                    F.col("_carry").alias(value))


# ------------------------------------------------------------------------- melt


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "metric",
         value: str = "value") -> DataFrame:
    """Wide -> long, keeping NULL values (pandas ``melt`` semantics)."""
    return df.unpivot(list(ids), list(values), var, value)

