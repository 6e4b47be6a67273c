"""inkstrata validate-schemas | export | rollback | review-queue | review-apply | sync, over a store folder."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from inkstrata import __version__


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="inkstrata")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("validate-schemas")
    commands = {
        "export": ("out",), "rollback": ("run", "now"), "review-queue": ("out", "now"), "review-apply": ("review", "run", "now"), "sync": ("source", "seed", "corpus", "run", "now"),
    }
    for name, needed in commands.items():
        s = sub.add_parser(name)
        for a in ("store", *needed):
            s.add_argument(f"--{a}", required=True)
        if name == "sync":
            s.add_argument("--dry-run", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from inkstrata.operators import export, fetch_policy, resolution, store
    from inkstrata.operators.pipeline import sync
    from inkstrata.schemas import SCHEMAS
    from inkstrata.session import get_session
    from inkstrata.sources.documents import read_review
    from inkstrata.sources.feeds import read_seeds

    if args.command == "validate-schemas":
        problems = [f"{n}: {x}" for n in SCHEMAS for x in export.schema_problems(n)]
        print("\n".join(problems) or "ok")
        return int(bool(problems))
    if wrong := fetch_policy.limit_problems():
        print("error: " + "; ".join(wrong), file=sys.stderr)
        return 1
    spark = get_session("inkstrata-cli")
    try:
        held = store.load(spark, args.store)
        if args.command == "export":
            print(export.export_jsonl(export.with_evidence(held.articles, held.evidence), args.out))
        elif args.command == "rollback":
            back = store.rollback(held, args.run, args.now)
            counts = {name: c.first()["n"] for name, c in back.counts.items()}
            store.commit(back, args.store)
            print(counts)
        elif args.command == "review-queue":
            found = resolution.candidates(resolution.author_profiles(held.articles, held.accounts))
            resolution.review_document(found, args.now).coalesce(1).write.text(args.out)
        elif args.command == "review-apply":
            people, decisions, tally = resolution.apply_review(read_review(spark, args.review), held.authors, held.merge_decisions, args.run, args.now)
            counts = {r["outcome"]: r["count"] for r in tally.collect()}
            invalid = counts.get("invalid", 0)
            run = (args.run, "review:apply", args.now, args.now, "COMPLETED", f"{invalid} invalid candidate rows skipped" if invalid else None, 0, 0, 0, invalid)
            reviewed = replace(held, authors=people, merge_decisions=decisions)
            store.commit(store.logged(reviewed, run_log=spark.createDataFrame([run], SCHEMAS["run_log"])), args.store, checked=True)
            print(counts)
            return int(invalid > 0)
        elif args.command == "sync":
            done = sync(held, read_seeds(spark, args.seed), args.source, spark.read.parquet(args.corpus), args.run, args.now, args.dry_run)
            if not args.dry_run:
                store.commit(done.store, args.store)
            print(done.run_log.first().asDict())
            done.close()
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
