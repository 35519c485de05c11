"""Command line over a folder of Parquet tables: `python -m tidemark.cli COMMAND --data FOLDER`."""

from __future__ import annotations

import argparse

from tidemark.operators import briefs, diffusion, extraction, store
from tidemark.plans import queries as core
from tidemark.runtime import local_session, table
from tidemark.sources import adapters, sinks

FRAMES = ("share_current", "share_year", "share_month", "diffusion_frame", "watchlist", "track_summary", "track_coverage")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, data: bool = True, out: bool = False) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=text)
        if data:
            s.add_argument("--data", required=True, help="folder of the tables")
        if out:
            s.add_argument("--out", required=True)
        return s

    command("list", "names of the queries", data=False)
    command("sources", "registered boards by segment", data=False)
    run = command("run", "run a query and show its first rows")
    run.add_argument("query", choices=sorted(core.QUERIES))
    run.add_argument("--rows", type=int, default=20)
    command("report", "track briefs as Markdown")
    command("export", "share and diffusion frames as CSV and Parquet", out=True)
    command("aggregate", "the same frames as Parquet only", out=True)
    command("extract", "terms of all postings as Parquet", out=True)
    command("status", "postings by segment and year, history, the crawl queue, runs by stage")
    command("cache", "entries and bytes of the response cache")
    retry = command("retry", "the crawl queue with failed addresses pending again, as Parquet", out=True)
    retry.add_argument("--max-attempts", type=int, default=6)
    retry.add_argument("--source")
    watch = command("watchlist", "skills to teach ahead and those the following segment asks for by itself", data=False)
    given = watch.add_mutually_exclusive_group(required=True)
    given.add_argument("--data", help="folder of the tables")
    given.add_argument("--csv", help="a diffusion frame exported before")
    watch.add_argument("--limit", type=int, default=25)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "list":
        print(*sorted(core.QUERIES), sep="\n")
        return 0
    if a.command == "sources":
        for n in adapters.names():
            print(adapters.REGISTRY[n][0], n)
        return 0
    spark = local_session()
    if a.command == "run":
        core.QUERIES[a.query](spark, a.data).show(a.rows, truncate=60)
    elif a.command == "report":
        coverage = core.track_coverage(spark, a.data)
        print(briefs.to_markdown(briefs.build_briefs(core.compared(spark, a.data), coverage)))
    elif a.command == "export":
        for n, where in sinks.export({n: core.QUERIES[n](spark, a.data) for n in FRAMES}, a.out).items():
            print(n, where)
    elif a.command == "aggregate":
        for n in FRAMES:
            core.QUERIES[n](spark, a.data).write.mode("overwrite").parquet(f"{a.out}/{n}")
            print(n, f"{a.out}/{n}")
    elif a.command == "extract":
        core.posting_terms(spark, a.data).write.mode("overwrite").parquet(a.out)
    elif a.command == "status":
        for n in ("counts_by_group_year", "history_counts", "trend_usability", "queue_stats", "run_report"):
            print(n)
            core.QUERIES[n](spark, a.data).show(100, truncate=60)
    elif a.command == "cache":
        core.response_cache(spark, a.data).show()
    elif a.command == "retry":
        queue = store.latest_state(table(spark, a.data, "crawl_queue"))
        store.requeue_failed(queue, a.max_attempts, a.source).write.mode("overwrite").parquet(a.out)
    else:
        frame = extraction.read_diffusion(spark, a.csv) if a.csv else core.compared(spark, a.data)
        diffusion.watchlist(frame, a.limit).select("skill", "track", "calibrated_gap", "lead_trend_12m", "confidence").show(a.limit, truncate=60)
        diffusion.own_demand(frame).select("skill", "track", "calibrated_gap").show(truncate=60)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
