"""Remembering fitted values, so that a chain of operators can be applied again without refitting.

Every place where an operator learns something that belongs to its result
(quartiles, a mode, labels, a dictionary) is marked with :func:`fitted`.  What it
only finds out about one table (split points, hot keys, sizes, row checks) is
marked with :func:`planned`.  Under :func:`recording` both are kept by the name of
the function and the number of its call; under :func:`replaying` learned values
are handed back, while plans are made anew unless the table is the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps


class FitMemo:
    def __init__(self, values: dict[str, object] | None = None, same_table: bool = False):
        self.values = {} if values is None else values
        self.replay = values is not None
        self.same_table = same_table
        self.calls: Counter[str] = Counter()

    def next_name(self, function: Callable) -> str:
        name = f"{function.__module__}.{function.__qualname__}"
        self.calls[name] += 1
        return f"{name} {self.calls[name]}"


_active: ContextVar[FitMemo | None] = ContextVar("limpid_fit_memo", default=None)


def fitted(learn: Callable) -> Callable:
    """Mark a function whose result is learned once and holds for every table."""
    return _remembered(learn, any_table=True)


def planned(decide: Callable) -> Callable:
    """Mark a function whose result only holds for the table it was made for."""
    return _remembered(decide, any_table=False)


def _remembered(learn: Callable, *, any_table: bool) -> Callable:
    @wraps(learn)
    def wrapper(*args, **kwargs):
        memo = _active.get()
        if memo is None:
            return learn(*args, **kwargs)
        name = memo.next_name(learn)
        if memo.replay and (any_table or memo.same_table) and name in memo.values:
            return memo.values[name]
        with _activate(None):  # one entry per outermost call
            value = learn(*args, **kwargs)
        if not memo.replay:
            memo.values[name] = value
        return value

    return wrapper


@contextmanager
def _activate(memo: FitMemo | None) -> Iterator[FitMemo | None]:
    token = _active.set(memo)
    try:
        yield memo
    finally:
        _active.reset(token)


def recording():
    return _activate(FitMemo())


def replaying(values: dict[str, object], *, same_table: bool = False):
    return _activate(FitMemo(values, same_table))
