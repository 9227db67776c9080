"""Registered queries over the given tables, each with its SQL check where SQL can say it."""

from tracelake.suite import registry


def load() -> None:
    from tracelake.suite import (  # noqa: F401
        cards, consent, filters, governance, pairs, redaction, search, sources, streams,
    )


QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
