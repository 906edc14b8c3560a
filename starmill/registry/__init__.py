"""Every operator as a query over the given tables, with the SQL that checks it."""

from starmill.registry import (
    analytics,
    cleaning,
    dimensions,
    duplicates,
    history,
    joins,
    loads,
    reports,
    rules,
    scans,
    sessions,
    streams,
)

QUERIES = {
    name: pair
    for module in (
        scans, cleaning, rules, duplicates, reports, dimensions, loads, history, analytics, joins, streams, sessions,
    )
    for name, pair in module.QUERIES.items()
}
