"""Queries over the given tables, each beside the SQL that must give the same rows."""

from . import q_catalog, q_daily, q_dqm, q_eval, q_indices, q_more, q_props, q_store

QUERY_MODULES = (q_dqm, q_daily, q_indices, q_props, q_eval, q_catalog, q_more, q_store)
