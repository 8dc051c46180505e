"""Plans: warehouse writes, daily run, backfill, registered queries."""
