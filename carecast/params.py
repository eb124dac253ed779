"""Job parameters.

The source scripts read the wall clock (``getdate()``) and hard-code
cut-off dates. Here "now" is when the parameters are made unless given (a job, or a
micro-batch of a stream, makes its own at each call), and
no lower date applies unless given, so a job drops no visits unasked. The
registered queries and their oracle use the fixed values in ``CHECK``.
"""

from __future__ import annotations

import datetime as dt
import functools
import inspect
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from . import rules


@dataclass(frozen=True)
class Params:
    # "now" of the run: visits after it are dropped, trailing windows end here.
    as_of: dt.datetime = field(default_factory=lambda: dt.datetime.now())
    # strict lower bound on visit dates for the daily reports (``fecha > since``).
    since: dt.date = dt.date(1900, 1, 1)
    # the same for measured demand, which starts later in the source; None: ``since``.
    demand_since: dt.date | None = None
    # trailing window of the half-hour model, in weeks.
    weeks: int = rules.DEFAULT_WEEKS
    min_year: int = rules.MIN_YEAR
    lapse: str = rules.DEFAULT_LAPSE
    # Off by default: the defaults reproduce the source as written.
    fix_union_order: bool = False   # union the two attention branches by name
    box_only: bool = False          # rank only box states when picking first attention
    dedupe_claims: bool = False     # count a visit once even if its claim repeats
    limit_synthetic: bool = False   # apply the trailing window to synthetic rows too
    # A ticket meets only visits that start at most so many minutes from it (300 in the source, commented out).
    within_minutes: int | None = None

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def demand_start(self) -> dt.date:
        return self.since if self.demand_since is None else self.demand_since

    @property
    def as_of_literal(self) -> str:
        return self.as_of.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def window_start(self) -> dt.datetime:
        """``as_of`` minus ``weeks`` weeks (a datetime, time part kept)."""
        return self.as_of - dt.timedelta(weeks=self.weeks)

    @property
    def window_first_date(self) -> dt.date:
        """First date d with ``d >= window_start`` when d is read as midnight."""
        start = self.window_start
        first = start.date()
        if start.time() != dt.time(0, 0):
            first += dt.timedelta(days=1)
        return first

    @property
    def last_date(self) -> dt.date:
        """Last date d with ``d <= as_of`` when d is read as midnight."""
        return self.as_of.date()


def now_unless_given(job: Callable) -> Callable:
    """``job`` with ``Params()`` made at each call that gives no ``params``."""
    signature = inspect.signature(job)

    @functools.wraps(job)
    def run(*args, **kw):
        given = signature.bind(*args, **kw)
        if given.arguments.get("params") is None:
            given.arguments["params"] = Params()
        return job(*given.args, **given.kwargs)

    return run


#: For the registered queries and tests: every date filter drops some of the driver's rows.
CHECK = Params(as_of=dt.datetime(2024, 1, 28, 12, 0, 0), since=dt.date(2024, 1, 5),
               demand_since=dt.date(2024, 1, 8), weeks=3)
