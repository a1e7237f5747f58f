"""Runnable plans: the three stage jobs and the named query registry."""

from salesmart.plans import queries as queries      # first: it and io_queries import each other, in this order only
