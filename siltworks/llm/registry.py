"""Queries of the training-data operators."""

from __future__ import annotations

from siltworks.llm import (
    alignment,
    branch_bound,
    elias_fano,
    empirical_bayes,
    extendible,
    harmonic_packing,
    importance,
    length_histogram,
    lsh_forest,
    prefix_free,
    simhash,
    viterbi,
    weak_supervision,
)

MODULES = [
    harmonic_packing,
    length_histogram,
    weak_supervision,
    empirical_bayes,
    lsh_forest,
    branch_bound,
    extendible,
    viterbi,
    elias_fano,
    prefix_free,
    alignment,
    importance,
    simhash,
]
ALL = {name: found for module in MODULES for name, found in module.QUERIES.items()}


def queries() -> dict:
    return {name: run for name, (run, _) in ALL.items()}


def checks() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
