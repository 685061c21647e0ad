"""Call chains and call trees: the hops of a transaction in order, caller to callee, and under what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.callers import NO_CALLER
from hoptrail.functions.traces import cell_start, present, service_node
from hoptrail.operators.graph import caller_columns
from hoptrail.plans.filters import EVERYTHING, TraceFilter


def call_chains(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, segment_seconds: int = 10
) -> DataFrame:
    """Number the hops of every transaction by start time.

    Among hops that start together the longer one comes first, as it encloses
    the other; callee, endpoint, caller and status settle the rest. A caller has the name that
    the service graph gives it. Hops are numbered inside (transaction, time segment), then
    shifted by the hops of earlier segments, so that one id reused by a large
    part of the traffic is spread over its segments. Few transactions span
    two segments, hence few shifts are joined. Traces without a transaction
    id belong to no chain.
    """
    hops = (
        flt.apply(traces)
        .where(present("id_transaccion") & (F.col("id_transaccion") != NO_CALLER))
        .withColumn(
            "segment",
            F.coalesce(cell_start(F.col("event_timestamp"), segment_seconds), F.lit(2**62)),
        )
    )
    keys = ["id_transaccion", "segment"]
    inside = Window.partitionBy(*keys).orderBy(
        F.asc_nulls_last("event_timestamp"),
        F.desc_nulls_last("time_transaction"),
        F.asc_nulls_last("id_recurso"),
        F.asc_nulls_last("endpoint"),
        F.asc_nulls_last("source"),
        F.asc_nulls_last("status_response"),
    )
    earlier = (
        Window.partitionBy("id_transaccion")
        .orderBy("segment")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        hops.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("shift", F.sum("size").over(earlier))
        .where("shift > 0")
        .select(*keys, "shift")
    )
    return (
        hops.select("*", caller_columns()[0]).withColumn("place", F.row_number().over(inside))
        .join(shifts, keys, "left")
        .select(
            "id_transaccion",
            (F.col("place") + F.coalesce("shift", F.lit(0))).alias("hop"),
            "event_timestamp",
            F.col("source").alias("caller"),
            service_node().alias("callee"),
            "endpoint",
            "status_response",
            "time_transaction",
        )
    )


def call_chain(traces: DataFrame, id_transaccion: str) -> DataFrame:
    """The chain of one transaction, in order."""
    return call_chains(traces.where(F.col("id_transaccion") == id_transaccion)).orderBy("hop")


# Parents of a cell are halved so often, so many ways at a time, before hops are compared with them one by one.
FANOUT, LEVELS = 16, 3


def call_tree(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, segment_seconds: int = 10, cell_seconds: int = 1
) -> DataFrame:
    """The hops of `call_chains` with the number of their parent, null for a root.

    The parent of a hop is the narrowest hop before it in the chain that encloses it in time and
    whose callee is its caller; of equally narrow ones the last. A hop without a duration ends when
    it starts; one without a time has no parent and is none.

    Intervals meet by time cell: a hop looks for its parent in the cell it starts in, and stands as
    a possible parent in each cell it lasts in, once per `cell_seconds` of its duration. So a
    transaction id reused by much of the traffic is spread over (service, cell).

    Inside a cell, possible parents are ranked from the narrowest, and their ranks dealt into
    `FANOUT` ranges. A range has a parent for a hop if the latest end of its members before
    the hop isn't before the hop's own; the hop goes to the first such range, `LEVELS` times. So it
    is joined with the members of one range in `FANOUT ** LEVELS` (one, in a cell of no
    more parents), not with all that its service did in the cell.
    """
    hops = call_chains(traces, flt, segment_seconds)
    width = cell_seconds * 1_000_000
    start = F.unix_micros("event_timestamp")
    end = start + F.coalesce("time_transaction", F.lit(0)) * 1000
    timed = hops.withColumns({"_start": start, "_end": end, "_cell": F.floor(start / F.lit(width))})
    last = F.greatest(F.floor(F.col("_end") / F.lit(width)), F.col("_cell"))
    length = F.col("_end") - F.col("_start")

    def role(service: Column, cell: Column, length: Column) -> Column:
        return F.struct(service.alias("service"), cell.alias("cell"), length.alias("length"))

    child = F.array(role(F.col("caller"), F.col("_cell"), F.lit(None).cast("long")))
    parent = F.transform(F.sequence("_cell", last), lambda cell: role(F.col("callee"), cell, length))
    can_be = F.col("_start").isNotNull() & F.col("callee").isNotNull()
    roles = timed.withColumn("_role", F.explode(F.when(can_be, F.concat(child, parent)).otherwise(child)))
    # Only parents have a `_length`; of a parent just the number and the end are needed.
    is_parent = F.col("_role.length").isNotNull()
    mine = [name for name in hops.columns if name not in ("id_transaccion", "hop")]
    keys = ["id_transaccion", "_service", "_cell"]
    roles = roles.select(
        "id_transaccion",
        F.col("_role.service").alias("_service"),
        F.col("_role.cell").alias("_cell"),
        F.col("_role.length").alias("_length"),
        "hop",
        "_end",
        *(F.when(~is_parent, F.col(name)).alias(name) for name in mine),
    )
    narrowest = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_length"), F.desc("hop"))
    in_range = F.ceil(F.count("_length").over(Window.partitionBy(*keys)) / F.lit(FANOUT**LEVELS))
    ranked = roles.withColumns({"_rank": F.row_number().over(narrowest) - 1, "_in_range": in_range}).withColumn(
        "_place", F.when(F.col("_length").isNotNull(), F.floor(F.col("_rank") / F.col("_in_range")))
    )
    placed = ranked.withColumn("_node", F.lit(0).cast("long"))
    # A parent comes before its children in the chain, so it starts no later.
    before = (
        Window.partitionBy(*keys, "_node")
        .orderBy("hop", F.asc_nulls_first("_place"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    for level in reversed(range(LEVELS)):
        part = F.floor(F.col("_place") / F.lit(FANOUT**level))
        latest = [F.max(F.when(F.pmod(part, F.lit(FANOUT)) == i, F.col("_end"))).over(before) for i in range(FANOUT)]
        first = F.coalesce(*(F.when(F.col(f"_latest{i}") >= F.col("_end"), F.lit(i)) for i in range(FANOUT)))
        placed = (
            placed.withColumns({f"_latest{i}": latest[i] for i in range(FANOUT)})
            .withColumn("_node", F.coalesce(part, F.col("_node") * FANOUT + first))
            .drop(*(f"_latest{i}" for i in range(FANOUT)))
        )
    children = placed.where("_place IS NULL").select(*keys, "_node", "hop", "_end", *mine)
    parents = ranked.where("_place IS NOT NULL").select(
        *keys, F.col("_place").alias("_node"), F.col("hop").alias("parent_hop"), "_rank", F.col("_end").alias("_until")
    )
    encloses = (F.col("p.parent_hop") < F.col("h.hop")) & (F.col("p._until") >= F.col("h._end"))
    met = [*keys, "_node"]
    joined = children.alias("h").join(
        parents.alias("p"), [F.col(f"h.{k}") == F.col(f"p.{k}") for k in met] + [encloses], "left"
    )
    best = Window.partitionBy(*(F.col(f"h.{k}") for k in met), "hop").orderBy(F.asc_nulls_last("_rank"))
    return (
        joined.withColumn("_nearest", F.row_number().over(best))
        .where("_nearest = 1")
        .select(*(F.col(f"h.{name}") for name in hops.columns), "parent_hop")
    )
