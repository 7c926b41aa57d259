"""Records of lists as a stream: one state a key, by the same rule as in batch."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.progress import EMPTY_LIST

FIELDS = ["nextPage", "offset", "found", "exhausted", "failures", "lastError", "failedAt", "runs", "lastAt"]
STATE = "nextPage int, offset int, found int, exhausted boolean, failures int, lastError string, failedAt timestamp, runs int, lastAt timestamp"
OUTPUT = f"key long, {STATE}"
START = (1, 0, 0, False, 0, None, None, 0, None)


def step(state: tuple, found: int, errors: list[str], last_page: int | None, at) -> tuple:
    """The record after one more run: the rule of ``operators.progress.apply_run``."""
    page, offset, had, exhausted, failures, _, _, runs, _ = state
    error = errors[0].lstrip().removeprefix("!").lstrip()[:200] if errors else None
    if not found and (errors or (not had and page == 1 and not offset)):
        return page, offset, had, exhausted, failures + 1, error or EMPTY_LIST, at, runs + 1, at
    if not found:
        return page, offset, had, True, 0, error, None, runs + 1, at
    if last_page is not None:
        page = last_page + 1
    else:
        offset += found
    return page, offset, had + found, exhausted, 0, error, None, runs + 1, at


def _advance(key, batches, state: GroupState):
    now = state.get if state.exists else START
    for r in pd.concat(list(batches)).sort_values("seq").itertuples():
        last_page = None if pd.isna(r.last_page) else int(r.last_page)
        now = step(now, int(r.found), list(r.errors), last_page, r.at.to_pydatetime())
    state.update(now)
    yield pd.DataFrame({"key": [key[0]], **{f: [v] for f, v in zip(FIELDS, now)}})


def fold_stream(runs: DataFrame) -> DataFrame:
    """Updates of the record per key from a stream of runs (key, seq, found, errors, last_page, at); within a batch by seq."""
    return runs.groupBy("key").applyInPandasWithState(_advance, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
