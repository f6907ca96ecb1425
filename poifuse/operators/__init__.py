"""DataFrame-to-DataFrame operators: joins, merges, rankings and reports."""
