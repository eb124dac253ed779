"""Summarise the executed (adaptive) physical plans of the headline queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carecast.registry import queries  # noqa: E402
from carecast.session import local_session  # noqa: E402

NAMES = ["visit_classification", "covid_daily", "movement_detail", "demand_vs_capacity",
         "shift_demand"]


def formatted(df) -> str:
    df.collect()  # runs this frame's own plan, so that explain shows the final adaptive one
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summary(plan: str) -> list[str]:
    # the trees of the adaptive plans as executed name the operators by number; what each does follows below
    trees = re.findall(r"== Final Plan ==(.*?)== Initial Plan ==", plan, re.S) or [plan]
    ran = {n for tree in trees for n in re.findall(r"\((\d+)\)", tree)}
    nodes = [x for x in re.findall(r"^\((\d+)\) ([A-Za-z][A-Za-z ]*?)\s*(?:\[[^\n]*\])?$\n(.*?)(?=^\(\d+\) |\Z)",
                                   plan, re.S | re.M) if x[0] in ran]
    kinds: dict[str, int] = {}
    exchanges: dict[str, int] = {}
    scans = []
    for _, kind, body in nodes:
        kinds[kind] = kinds.get(kind, 0) + 1
        if kind == "Exchange":
            arg = re.search(r"Arguments: (\w+)", body)
            how = arg.group(1) if arg else "?"
            if "REPARTITION_BY_COL" in body:
                how = "repartition by column"
            exchanges[how] = exchanges.get(how, 0) + 1
        if kind.startswith("Scan parquet"):
            scans.append(body)
    get = lambda k: kinds.get(k, 0)
    out = [
        "- shuffle exchanges: " + (", ".join(f"{n} {k}" for k, n in sorted(exchanges.items())) or "none")
        + f"; broadcast exchanges: {get('BroadcastExchange')}",
        f"- joins: {get('BroadcastHashJoin')} broadcast hash, {get('SortMergeJoin')} sort-merge, "
        f"{get('ShuffledHashJoin')} shuffled hash",
        f"- aggregates: {get('HashAggregate')} hash, {get('ObjectHashAggregate')} object-hash "
        f"(percentile), {get('SortAggregate')} sort; windows: {get('Window')}, "
        f"window group limits: {get('WindowGroupLimit')}",
    ]
    for body in scans:
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", body)
        pushed = re.search(r"PushedFilters: (\[[^\n]*\])", body)
        pruned = re.search(r"PartitionFilters: \[([^\n]*)\]", body)
        schema = re.search(r"ReadSchema: (struct<[^\n]*>)", body)
        where = os.path.basename(loc.group(1).rstrip("/")) if loc else "?"
        where = re.sub(r"-[0-9a-f]{12}$", "-<run>", where)
        out.append(f"- scan `{where}`: pushed {pushed.group(1) if pushed else '[]'}; "
                   f"reads {schema.group(1) if schema else '?'}"
                   + (f"; partitions {re.sub(r'#[0-9]+L?', '', pruned.group(1))}" if pruned and pruned.group(1) else ""))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=8)
    print("# Executed plans of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on; final adaptive "
          "plans).\nCounts are of physical operators in the executed plan.\n")
    for name in NAMES:
        plan = formatted(queries()[name](spark, sf_dir))
        print(f"## {name}\n")
        print("\n".join(summary(plan)))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
