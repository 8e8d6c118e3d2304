"""Which rows of a table's history a later reference date can need, for tenura.sources.state."""

from __future__ import annotations

from tenura.operators.contracts import compact_contracts
from tenura.operators.divisions import compact_snapshots

STATES = {
    "activity_daily_contracts": compact_contracts,
    "division_statistics_daily": compact_snapshots,
}
