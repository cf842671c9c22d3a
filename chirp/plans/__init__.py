"""Query plans over the shared test tables: the tweet view and the
registered queries (see chirp.plans.queries)."""
