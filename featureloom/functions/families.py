"""Task-side helper for hub nodes: few paths that stand for all paths with the same text.

The functions here travel to the Python workers by value, so that the workers need no copy
of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle

BUFFER = 2_000


def representatives(families: list[frozenset], room: int) -> list[int]:
    """Indices of sets that stand for all: whatever ``room`` nodes are still to come, if one
    of ``families`` avoids them, then one of the chosen sets does.

    Take any set; a continuation that it blocks must use one of its nodes, so for each of
    them look among the sets without that node, with one node less to come.
    """
    chosen: set[int] = set()

    def pick(candidates: list[int], left: int) -> None:
        if not candidates:
            return
        head = candidates[0]
        chosen.add(head)
        if left:
            for node in families[head]:
                pick([c for c in candidates if node not in families[c]], left - 1)

    pick(list(range(len(families))), room)
    return sorted(chosen)


def thin_task(room: int, group_width: int):
    """Task function: rows sorted by their first columns in, representatives out.

    The last column is the set. Only rows of the current group are held: new ones up to a
    fixed number on top of the representatives kept so far.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, limit, columns = None, [], BUFFER, None

        def thin():
            keep = representatives([frozenset(row[-1]) for row in held], room)
            return [held[i] for i in keep]

        for batch in batches:
            columns, done = batch.columns, []
            for row in batch.itertuples(index=False, name=None):
                if row[:group_width] != group:
                    done += thin() if held else []
                    group, held, limit = row[:group_width], [], BUFFER
                held.append(row)
                if len(held) >= limit:
                    held = thin()
                    limit = len(held) + BUFFER
            if done:
                yield pd.DataFrame(done, columns=columns)
        if held:
            yield pd.DataFrame(thin(), columns=columns)

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
