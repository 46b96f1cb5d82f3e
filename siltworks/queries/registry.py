"""All registered queries and the SQL each is checked against."""

from __future__ import annotations

from functools import wraps

from siltworks.queries import constraints, loads, runs, typing, versions
from siltworks.session import tune

ALL = {**loads.QUERIES, **typing.QUERIES, **constraints.QUERIES, **runs.QUERIES, **versions.QUERIES}


def _tuned(run):
    @wraps(run)
    def call(spark, sf_dir):
        # A session of its own: the caller's settings and views stay as they are.
        return run(tune(spark.newSession()), sf_dir)

    return call


def queries() -> dict:
    return {name: _tuned(run) for name, (run, _) in ALL.items()}


def checks() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
