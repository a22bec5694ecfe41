"""Order-dependent operators on many time series, safe under heavy skew.

A plain ``Window.partitionBy(series)`` puts every row of a series into one
task; if one series holds a third of all rows that task never finishes. We
split every series into time chunks (``chunk_days`` wide, derived from the
ordering timestamp, so chunk order equals row order) and run the window per
(series, chunk). What must cross a chunk border is tiny, and it is carried
by one *boundary row* per (series, chunk), unioned into the window input and
sorted in front of the chunk's real rows:

* ``series_lag``: the boundary row holds the last row of the previous
  non-empty chunk, so LAG of the first real row sees it;
* ``series_running_sum``: the boundary row holds the total of all earlier
  chunks, so the running sum starts from it.

Boundary rows come from a map-side partial aggregate per (series, chunk) and
a window over that small table (one row per chunk). One big exchange (the
window's), no second sort.

Rows are ordered NULLS LAST (a reading without a time sorts after the
timed ones, as in the SQL engine the queries come from); NULL times form the
last chunk of their series, with an id of its own: chunk ids are never NULL, so
later joins on (series, chunk) are plain equalities that keep the layout.

Chunks are cut by rank. Rows are counted per (series, coarse chunk) with a
partial aggregate. For the coarse chunks that hold more than
``max_rows_per_chunk`` rows, and for those only, a KLL sketch of the row's
*position* (offset in the chunk, then the leading bits of the tie-breakers; only
tie-breakers where the time is NULL) gives the values that cut the chunk into
pieces of equal row counts, however its rows are spread: a burst, or all
readings without a time, is cut like any other chunk. Pieces hold at most twice
the limit while a coarse chunk holds at most about 700 times the limit (rank
error of the sketch). Rows that agree in position stay together: rows of one
microsecond whose first tie-breaker agrees in its leading bits. The cut values
number at most total_rows / max_rows_per_chunk - a proven bound - and are
broadcast, so the big side never moves for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
REAL = "_real"
MAX_ROWS_PER_CHUNK = 4_000_000
_SUB_BITS = 20  # up to 2^20 pieces per coarse chunk
NULL_BASE = 1 << 40  # the coarse chunk of rows without a time: larger than any other
SKETCH_K = 8192  # rank error below 0.07 %
_RANKS = 1024  # ranks that are asked of a sketch


def chunk_of(ts: str | Column, chunk_days: int) -> Column:
    """Chunk number of a timestamp/date: whole ``chunk_days`` periods since 1970-01-01."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return F.floor(days / F.lit(chunk_days)).cast("long")


def pieces_before(cuts: Column, position: Column) -> Column:
    """How many of the ascending ``cuts`` (fewer than _RANKS) are <= ``position``, by binary search."""
    steps = [_RANKS >> i for i in range(1, _RANKS.bit_length())]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= position, at + step).otherwise(at),
    )


def cut_hot(
    df: DataFrame, keys: Sequence[str], base: Column, position: Column, limit: int = MAX_ROWS_PER_CHUNK
) -> DataFrame:
    """Add CHUNK: a long that increases with (``base``, ``position``) inside each group of ``keys``.

    ``base``: a coarse chunk number, not NULL, below 2^42; ``position``: a long, not NULL, that increases
    with the row order inside a coarse chunk. A coarse chunk of more than ``limit`` rows is cut by the ranks
    of ``position`` (see the module text).
    """
    keys = list(keys)
    placed = df.withColumn("_base", base.cast("long"))
    counts = placed.groupBy(*keys, "_base").agg(F.count(F.lit(1)).alias("_n"))
    named = [F.col(k).alias("_h_" + k) for k in keys] + [F.col("_base").alias("_h_base")]
    same = F.col("_base") == F.col("_h_base")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_h_" + k))
    # at most total_rows / limit rows: a proven bound for broadcast
    hot = counts.filter(F.col("_n") > limit).select(*named, "_n")
    ranks = F.array(*[F.lit(i / _RANKS) for i in range(1, _RANKS)])
    sketched = (
        placed.withColumn("_pos", position)
        .join(F.broadcast(hot), same)
        .groupBy(*keys, "_base")
        .agg(F.kll_sketch_agg_bigint("_pos", F.lit(SKETCH_K)).alias("_s"), F.max("_n").alias("_n"))
        .select(*named, F.kll_sketch_get_quantile_bigint("_s", ranks).alias("_q"), F.least(F.ceil(F.col("_n") / limit), F.lit(_RANKS)).cast("int").alias("_k"))
    )
    every = F.transform(
        F.sequence(F.lit(1), F.col("_k") - 1), lambda i: F.element_at("_q", F.floor(i * _RANKS / F.col("_k")).cast("int"))
    )
    # at most as many cut values as total_rows / limit
    cuts = sketched.select(*["_h_" + k for k in keys], "_h_base", F.array_distinct(every).alias("_cuts"))
    joined = placed.join(F.broadcast(cuts), same, "left")
    sub = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(pieces_before(F.col("_cuts"), position))
    chunk = F.col("_base") * F.lit(2**_SUB_BITS) + sub.cast("long")
    return joined.select(*[F.col(c) for c in df.columns], chunk.cast("long").alias(CHUNK))


def _place(tie: str, dtype: str) -> tuple[Column, int]:
    """(value, bits): an order-preserving value, not negative, of a tie-breaker, NULL last."""
    if dtype in ("int", "smallint", "tinyint"):
        return F.coalesce(F.col(tie).cast("long") + F.lit(2**31), F.lit(2**32)), 33
    # BIGINT: the value itself where it is not negative and below 2^62, as ids are
    return F.coalesce(F.least(F.greatest(F.col(tie).cast("long"), F.lit(0)), F.lit(2**62 - 1)), F.lit(2**62 - 1)), 62


def _packed(parts: Sequence[tuple[Column, int]], room: int) -> Column:
    """The leading ``room`` bits of the parts written one after the other."""
    out = F.lit(0).cast("long")
    for value, bits in parts:
        used = min(bits, room)
        out = F.shiftleft(out, used).bitwiseOR(F.shiftright(value, bits - used)) if used else out
        room -= used
    return F.shiftleft(out, room)


def row_position(order: Sequence[str], dtypes: dict[str, str], chunk_days: int) -> Column:
    """Where a row stands in its coarse chunk, as a long that increases with the order of ``order``."""
    ts, ties = order[0], [t for t in order[1:] if dtypes[t] in ("int", "smallint", "tinyint", "bigint")]
    span = chunk_days * 86_400_000_000
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz"))
    places = [_place(t, dtypes[t]) for t in ties]
    timed = _packed([(micros - chunk_of(ts, chunk_days) * F.lit(span), span.bit_length()), *places], 62)
    return F.when(F.col(ts).isNull(), _packed(places, 62)).otherwise(timed)


def with_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk_days: int = 7,
    max_rows_per_chunk: int = MAX_ROWS_PER_CHUNK,
) -> DataFrame:
    """Add CHUNK: a long, not NULL, increasing with ``order`` (timestamp, tie-breakers; NULLS LAST) inside each series."""
    base = F.coalesce(chunk_of(order[0], chunk_days), F.lit(NULL_BASE))
    return cut_hot(df, keys, base, row_position(order, dict(df.dtypes), chunk_days), max_rows_per_chunk)


def order_key(order: Sequence[str], dtypes: dict[str, str]) -> Column:
    """One sort key for (timestamp, tie-breakers...), NULLS LAST.

    Up to two INT tie-breakers give an exact DECIMAL(38,0): epoch-microseconds
    * 2^33 + (t + 2^31) each, NULL counting as 2^32, larger than any value,
    so MAX of the key picks the last row of a chunk in the full order. Other tie-breakers
    (BIGINT, more than two) give a struct of null flags and values. Unlike MAX_BY
    over a struct, an aggregate keyed by a decimal runs as a hash aggregate
    (no sort of the input).
    """
    ts, ties = order[0], list(order[1:])
    if len(ties) > 2 or any(dtypes[t] not in ("int", "smallint", "tinyint") for t in ties):
        return F.struct(F.col(ts), *[x for t in ties for x in (F.col(t).isNull(), F.col(t))])
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # a chunk holds only timed rows or only rows without a time
    key = F.coalesce(F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz")), F.lit(0)).cast("decimal(38,0)")
    for t in ties:
        place = F.coalesce(F.col(t).cast("long") + F.lit(2**31), F.lit(2**32))
        key = key * F.lit(2**33).cast("decimal(38,0)") + place.cast("decimal(38,0)")
    return key.cast("decimal(38,0)")


def _boundary_rows(staged: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Rows shaped like ``staged`` with only keys, chunk and ``values`` set, REAL = 0."""
    fields = {f.name: f.dataType for f in staged.schema.fields}
    cols = []
    for name, dtype in fields.items():
        if name in values:
            cols.append(values[name].cast(dtype).alias(name))
        elif name == REAL:
            cols.append(F.lit(0).alias(REAL))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return cols


def series_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    chunk_days: int = 7,
    max_rows_per_chunk: int = MAX_ROWS_PER_CHUNK,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` in the previous row of the same series.

    With ``keep_chunk`` the chunk id stays as column ``_chunk``: the output is
    hash-partitioned on (keys, _chunk), and a later join on those keys needs
    no shuffle of this side.

    ``order[0]`` is the timestamp (chunks come from it), then tie-breakers; rows must be unique in ``order`` within a series (true after
    the staging DISTINCT), so "last row of a chunk" is well defined. Equal to ``lag(c) over
    (partition by keys order by order)``.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    staged = with_chunks(df, keys, order, chunk_days, max_rows_per_chunk).withColumn(REAL, F.lit(1))

    key = order_key(order, dict(staged.dtypes))
    last = staged.groupBy(*keys, CHUNK).agg(*[F.max_by(c, key).alias("_last_" + c) for c in cols])
    nxt = last.select(
        *keys,
        F.lead(CHUNK).over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("_next"),
        *["_last_" + c for c in cols],
    ).filter(F.col("_next").isNotNull()).withColumn(CHUNK, F.col("_next"))
    values = {k: F.col(k) for k in keys} | {CHUNK: F.col(CHUNK)} | {c: F.col("_last_" + c) for c in cols}
    boundary = nxt.select(*_boundary_rows(staged, values))

    w = Window.partitionBy(*keys, CHUNK).orderBy(F.col(REAL), *[F.col(c).asc_nulls_last() for c in order])
    lagged = staged.unionByName(boundary).withColumn("_prev", F.lag(F.struct(*cols)).over(w))
    return lagged.filter(F.col(REAL) == 1).select(
        *[F.col(c) for c in df.columns],
        *[F.col("_prev").getField(c).alias(prefix + c) for c in cols],
        *([F.col(CHUNK)] if keep_chunk else []),
    )


def series_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "cum_",
    chunk_days: int = 7,
    max_rows_per_chunk: int = MAX_ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``prefix + c`` = running total of ``c`` per series (rows unbounded preceding).

    Exact for integral columns.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    staged = with_chunks(df, keys, order, chunk_days, max_rows_per_chunk).withColumn(REAL, F.lit(1))

    totals = staged.groupBy(*keys, CHUNK).agg(*[F.sum(c).alias("_tot_" + c) for c in cols])
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, CHUNK, *[F.sum("_tot_" + c).over(before).alias(c) for c in cols]).filter(
        F.col(cols[0]).isNotNull()
    )
    values = {k: F.col(k) for k in keys} | {CHUNK: F.col(CHUNK)} | {c: F.col(c) for c in cols}
    boundary = offsets.select(*_boundary_rows(staged, values))

    w = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(F.col(REAL), *[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = staged.unionByName(boundary).select("*", *[F.sum(c).over(w).alias(prefix + c) for c in cols])
    return summed.filter(F.col(REAL) == 1).select(*[F.col(c) for c in df.columns], *[F.col(prefix + c) for c in cols])
