"""Summarise the executed physical plan of registered queries: exchanges
(and their partitioning), join strategies, scans with their pushed filters
and read columns, and single-partition steps.

    python -m checks.plans [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re
import sys


def final_plan(df) -> str:
    """Execute ``df`` itself and return the final part of its adaptive plan
    (a write would run a separate query execution and leave this plan
    unexecuted)."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return drop_initial_plans(buf.getvalue())


def drop_initial_plans(text: str) -> str:
    """Remove every ``== Initial Plan ==`` subtree (the main query's and each
    subquery's), keeping the final plans."""
    kept, skip_deeper_than = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|"))
        if skip_deeper_than is not None:
            if line.strip() and indent <= skip_deeper_than:
                skip_deeper_than = None
            else:
                continue
        if "== Initial Plan ==" in line:
            skip_deeper_than = indent
            continue
        kept.append(line)
    return "\n".join(kept)


KINDS = "ENSURE_REQUIREMENTS|REPARTITION_BY_COL|REBALANCE_PARTITIONS_BY_COL|REPARTITION_BY_NUM"
JOINS = "SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct"
JOIN_TYPES = "Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti|Cross|ExistenceJoin"


def _clean(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)
    return re.sub(r"knownfloatingpointnormalized\(normalizenanandzero\((.*?)\)\)", r"\1", text)


def summarise(plan: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {"exchanges": [], "joins": [], "scans": [], "single": [], "windows": []}
    for m in re.finditer(rf"\bExchange (.*?), (?:{KINDS})", plan):
        arg = _clean(m.group(1))
        out["single" if arg.startswith("SinglePartition") else "exchanges"].append(arg)
    out["broadcasts"] = re.findall(r"BroadcastExchange ", plan)
    for m in re.finditer(rf"({JOINS})(\(skew=true\))? .*?\b({JOIN_TYPES})\b", plan):
        out["joins"].append(f"{m.group(1)}{m.group(2) or ''} {m.group(3)}")
    for m in re.finditer(
        r"FileScan parquet \[(.*?)\].*?Location: \w+\(\d+ paths\)\[(.*?)\], "
        r"PartitionFilters: (\[.*?\]), PushedFilters: (\[.*?\]), ReadSchema",
        plan,
    ):
        table = m.group(2).rsplit("/", 1)[-1]
        cols = len(m.group(1).split(","))
        out["scans"].append(f"{table}: {cols} cols, pushed {_clean(m.group(4))}")
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            m = re.search(r"\], \[([^\[\]]*)\], \[([^\[\]]*)\]\s*$", line)
            if m:
                out["windows"].append(_clean(m.group(1)) or "(none: single partition)")
    return out


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from strata.plans.queries import QUERIES
    from strata.session import build_session

    spark = build_session("local[8]")
    for name in args.names or list(QUERIES):
        s = summarise(final_plan(QUERIES[name](spark, args.sf_dir)))
        print(f"### {name}")
        print(f"- joins: {', '.join(s['joins']) or 'none'}")
        print(f"- shuffles ({len(s['exchanges'])}): " + "; ".join(sorted(set(s["exchanges"]))))
        print(f"- broadcasts: {len(s['broadcasts'])}; single-partition exchanges: {len(s['single'])}")
        if s["windows"]:
            print(f"- window partitioning: {'; '.join(s['windows'])}")
        for scan in sorted(set(s["scans"])):
            print(f"- scan {scan}")
        print()

if __name__ == "__main__":
    main()
