from tidelog.operators.append import (
    drop_older_than_marks,
    drop_seen,
    drop_seen_events,
    high_water_marks,
)
from tidelog.operators.envelope import parse_events
from tidelog.operators.gold import (
    add_domain_deltas,
    add_tallies,
    daily_changes,
    domain_counts,
    domain_deltas,
)
from tidelog.operators.latest import latest_state, to_silver
from tidelog.operators.merge import apply_changes
from tidelog.operators.runs import drop_stored, join_runs, offset_runs
from tidelog.operators.seed import insert_if_absent, seed_users

__all__ = [
    "add_domain_deltas",
    "add_tallies",
    "apply_changes",
    "daily_changes",
    "domain_counts",
    "domain_deltas",
    "drop_older_than_marks",
    "drop_seen",
    "drop_seen_events",
    "drop_stored",
    "high_water_marks",
    "insert_if_absent",
    "join_runs",
    "latest_state",
    "offset_runs",
    "parse_events",
    "seed_users",
    "to_silver",
]
