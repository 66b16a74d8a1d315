"""Brute-force forms of the pipeline's filtering stages, on lists of (doc_id, text)."""

from __future__ import annotations

from test_decontaminate import brute
from test_line_runs import brute as lines
from test_simhash import brute_components, brute_fingerprint


def brute_lines(rows):
    """Texts without repeated runs of lines; documents of which nothing is left are gone."""
    done = lines(rows)
    return [(d, done[d][0]) for d, t in rows if not t.strip() or done[d][1] < sum(1 for x in t.split("\n") if x.strip())]


def brute_simhash_keep(rows):
    group = brute_components([brute_fingerprint(t) for _, t in rows], 3)
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min(d, least.get(g, d))
    return [r for r, g in zip(rows, group) if least[g] == r[0]]


def brute_leaks(text, items):
    return any(brute(text, item) for item in items)
