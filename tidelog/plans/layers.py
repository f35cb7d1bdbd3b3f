"""Steps that carry a lake from its newest Bronze batch to Silver and Gold.

Batch jobs and micro-batches run the same steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.config import LOG_POSITION
from tidelog.functions.events import DELETE
from tidelog.operators import (
    add_domain_deltas,
    add_tallies,
    apply_changes,
    daily_changes,
    domain_counts,
    domain_deltas,
    drop_older_than_marks,
    drop_stored,
    high_water_marks,
    join_runs,
    latest_state,
    offset_runs,
    to_silver,
)
from tidelog.operators.kept import carried_extreme, figure_changes, live_figures, newest_events
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DAILY, DOMAIN, FIGURES, MARKS, NEWEST, RUNS, SILVER, Lake


DEDUPE = ("exact", "offsets", "none")


def fresh_records(change_log: DataFrame, lake: Lake, dedupe: str) -> DataFrame:
    """Records of a batch scan or micro-batch that Bronze does not hold yet.

    ``exact`` compares log positions with the runs of stored offsets; ``offsets`` compares
    with the highest stored offset per log partition and needs a source that delivers in
    offset order; ``none`` takes everything.  The filter comes before the JSON is parsed, and neither reads
    the history: only batches since the last time are added to the small table of runs or marks.
    """
    if dedupe == "exact":
        advance_runs(lake)
        return drop_stored(change_log, lake.read(RUNS))
    if dedupe == "offsets":
        advance_marks(lake)
        return drop_older_than_marks(change_log, lake.read(MARKS))
    if dedupe == "none":
        return change_log
    raise ValueError(f"dedupe must be one of {DEDUPE}, not {dedupe!r}")


def advance_silver(lake: Lake, mode: str = "ordered", image: str = "coalesce") -> int | None:
    """Merge the Bronze batches Silver does not cover yet.

    In ``reference`` mode the result depends on the batch cuts, so each batch is
    merged on its own, in order; in ``ordered`` mode all of them at once.
    """
    last = lake.last_batch()
    done = lake.version(SILVER, below=last + 1)
    if last < 0 or done == last:
        return None
    steps = [last] if mode == "ordered" else lake.batches(after=done)
    rows = None
    for step in steps:
        changes = latest_state(lake.bronze(after=done, through=step), lake.spec, image=image)
        if done >= 0:
            state = apply_changes(lake.read(SILVER, done), changes, lake.spec, mode)
            rows = lake.publish(SILVER, state, step, merged_onto=done)
        else:
            # Without an older version there is nothing a change could be late for.
            state = changes if mode == "ordered" else changes.where(F.col("op_type") != DELETE)
            rows = lake.publish(SILVER, state, step)
        done = step
    return rows


def fresh_state(lake: Lake, image: str = "coalesce") -> DataFrame:
    """Silver including the batches it does not cover yet, merged while reading.

    With a large Silver, merge it seldom and read it through this.
    """
    done = lake.version(SILVER)
    if done == lake.last_batch():
        return lake.read(SILVER, done)
    changes = latest_state(lake.bronze(after=done), lake.spec, image=image)
    return apply_changes(lake.read(SILVER, done), changes, lake.spec) if done >= 0 else changes


def rebuild_silver(lake: Lake, method: str = "window", image: str = "coalesce") -> int | None:
    """Replace Silver by a build from the whole history."""
    last = lake.last_batch()
    if last < 0:
        return None
    state = latest_state(lake.bronze(through=last), lake.spec, method, image)
    return lake.publish(SILVER, state, last, replace=True)


def advance_gold(lake: Lake) -> dict[str, int | None]:
    """Bring the domain table to the version of Silver, and the daily tally to the history.

    The domain table is counted from Silver, one shuffle of partial counts.
    """
    last = lake.version(SILVER)
    rows: dict[str, int | None] = {}
    if last < 0:
        return rows
    if lake.version(DAILY) < lake.last_batch():
        rows[DAILY] = advance_daily(lake)
    if lake.spec.domain_column and lake.version(DOMAIN) < last:
        silver = to_silver(lake.read(SILVER, last), lake.spec)
        rows[DOMAIN] = lake.publish(DOMAIN, domain_counts(silver, lake.spec), last)
    return rows


def advance_daily(lake: Lake) -> int | None:
    """Add the new batches to the daily tally, which needs no Silver."""
    last = lake.last_batch()
    done = lake.version(DAILY, below=last + 1)
    if done >= last:
        return None
    tally = daily_changes(lake.bronze(after=done, through=last))
    if done >= 0:
        tally = add_tallies(lake.read(DAILY, done), tally)
    return lake.publish(DAILY, tally, last)


def advance_keyed(lake: Lake, table: KeyedTable, mode: str = "ordered", image: str = "coalesce") -> int | None:
    """Merge the batches that ``table`` does not cover yet, and carry the domain table along.

    Only partitions with changed keys are read and written, and the domain counts move by what the merge
    staged: one off for each old image, one on for each new one.  The work follows the
    changes.  Returns the newest batch, None if the table covers it already.

    Each step can be repeated: what is staged is written once, the domain table's next version comes
    from the previous one and what is staged, and the batch counts as merged last.
    """
    last = lake.last_batch()
    done = table.version()
    if last < 0 or done >= last:
        return None
    # In reference mode the result depends on the batch cuts.
    for step in [last] if mode == "ordered" else lake.batches(after=done):
        # What an earlier try has staged is finished first, under its own number.
        begun = table.pending()
        step = step if begun is None else begun
        if begun is None:
            table.stage(latest_state(lake.bronze(after=done, through=step), lake.spec, image=image), step, mode)
        counted = lake.version(DOMAIN, below=step)
        staged = table.staged(step)
        if lake.spec.domain_column and counted == done:
            domains = lake.read(DOMAIN, counted)
            if staged is not None:
                domains = add_domain_deltas(domains, domain_deltas(staged))
            lake.publish(DOMAIN, domains, step)
        table.replace(step)
        if lake.spec.domain_column and lake.version(DOMAIN) < step:
            # The domain table was never carried along: count it once.
            lake.publish(DOMAIN, domain_counts(to_silver(table.read(), lake.spec), lake.spec), step)
        _advance_figures(lake, table, staged, done, step)
        done = step
    return advance_keyed(lake, table, mode, image) or done


def _advance_figures(lake: Lake, table: KeyedTable, staged: DataFrame | None, done: int, step: int) -> None:
    """Carry the count of live rows and the extremes of their event time along with a merge.

    Silver is only read (one column) if a row that had an extreme went and none of the new ones reaches it.
    """
    if lake.version(FIGURES) >= step:
        return
    known = lake.read(FIGURES, done).first() if done >= 0 and lake.version(FIGURES, below=step) == done else None
    if known is not None and staged is None:
        figures = lake.read(FIGURES, done)
    elif known is not None:
        change = figure_changes(staged).first()  # one row
        first, sure_first = carried_extreme(known.earliest_ms, change.new_earliest, change.old_earliest, largest=False)
        last, sure_last = carried_extreme(known.latest_ms, change.new_latest, change.old_latest, largest=True)
        total = known.total_users + change.added
        figures = live_figures(table.read())
        if sure_first and sure_last:
            row = [(total, first, last)] if total else [(0, None, None)]
            figures = lake.spark.createDataFrame(row, "total_users bigint, earliest_ms bigint, latest_ms bigint")
    else:
        figures = live_figures(table.read())
    lake.publish(FIGURES, figures.withColumn("figures_built_at", F.current_timestamp()), step)


def advance_newest_events(lake: Lake, rows: int = 20) -> int | None:
    """Bring the table of the ``rows`` newest events to the newest batch; keep ``rows`` the same for a lake."""
    last = lake.last_batch()
    done = lake.version(NEWEST, below=last + 1)
    if done >= last:
        return None
    newer = lake.bronze(after=done, through=last)
    return lake.publish(NEWEST, newest_events(lake.read(NEWEST, done), newer, rows=rows), last)


def rebuild_gold(lake: Lake) -> dict[str, int | None]:
    """Replace both Gold tables by builds from whole Bronze and Silver."""
    last = lake.version(SILVER)
    if last < 0:
        return {}
    daily = daily_changes(lake.bronze(through=last))
    rows = {DAILY: lake.publish(DAILY, daily, last, replace=True)}
    if lake.spec.domain_column:
        silver = to_silver(lake.read(SILVER, last), lake.spec)
        domains = domain_counts(silver, lake.spec)
        rows[DOMAIN] = lake.publish(DOMAIN, domains, last, replace=True)
    return rows


def advance_marks(lake: Lake) -> None:
    """Bring the table of highest stored offsets to the newest batch."""
    last = lake.last_batch()
    done = lake.version(MARKS, below=last + 1)
    if done < last:
        newer = lake.bronze(after=done, through=last).select(*LOG_POSITION)
        known = lake.read(MARKS, done).unionByName(newer)
        lake.publish(MARKS, high_water_marks(known), last)


def advance_runs(lake: Lake) -> None:
    """Bring the runs of stored offsets to the newest batch."""
    last = lake.last_batch()
    done = lake.version(RUNS, below=last + 1)
    if done < last:
        newer = offset_runs(lake.bronze(after=done, through=last))
        runs = join_runs(lake.read(RUNS, done), newer) if done >= 0 else newer
        lake.publish(RUNS, runs, last)
