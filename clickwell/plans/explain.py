"""Print the final (adaptive) physical plan of registered queries as a compact tree.

``python -m clickwell.plans.explain [sf_dir] [query ...]`` runs each query into the
``noop`` sink and prints its executed plan with expressions elided, plus each scan's
``ReadSchema`` and pushed filters; ``PLANS.md`` is generated with it."""

from __future__ import annotations

import re
import sys

DEFAULT = ("daily_kpis", "segment_performance", "top_segments", "hourly_range", "ab_lift",
           "forecast_results", "profile_top_values", "profile_distribution")


def compact(plan: str) -> str:
    out = []
    for line in plan.split("\n"):
        m = re.match(r"^([\s:+\-]*)(\w+)(.*)$", line)
        if not m or not m.group(2):
            continue
        prefix, op, rest = m.groups()
        detail = ""
        if op == "FileScan":
            table = re.search(r"Location: \w+\([^)]*\)\[file:[^\]]*/([\w.]+)\]", rest)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", rest)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", rest)
            detail = " ".join(x for x in [table and table.group(1), schema and schema.group(1),
                                          pushed and f"pushed={pushed.group(1)}"] if x)
        elif op in ("Exchange", "ShuffleQueryStage", "BroadcastQueryStage"):
            part = re.search(r"(hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning)", rest)
            detail = part.group(1) if part else ""
            detail = re.sub(r"#\d+L?", "", detail)
        elif op in ("HashAggregate", "ObjectHashAggregate", "SortAggregate"):
            funcs = re.search(r"functions=\[([^\]]*)\]", rest)
            detail = re.sub(r"#\d+L?", "", funcs.group(1)) if funcs else ""
        elif op == "TakeOrderedAndProject":
            lim = re.search(r"limit=(\d+)", rest)
            detail = f"limit={lim.group(1)}" if lim else ""
        out.append(f"{prefix}{op} {detail}".rstrip())
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(DEFAULT)
    from ..session import local_session
    from .registry import QUERIES, load_all
    load_all()
    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        print(f"### {name}\n\n```\n{compact(df._jdf.queryExecution().executedPlan().toString())}\n```\n")


if __name__ == "__main__":
    main()
