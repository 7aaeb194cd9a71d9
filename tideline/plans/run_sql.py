"""Run a SQL script as a job: ``spark-submit … run_sql.py --sql-path PATH``."""

from __future__ import annotations

import argparse

from tideline.plans.scripts import read_script, run_script, start_script
from tideline.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--sql-path", required=True, help="script in any file system Spark can read")
    parser.add_argument("--sql-delimiter", default=";")
    parser.add_argument("--mode", choices=("batch", "immediate", "stream"), default="batch")
    parser.add_argument("--parallel", type=int, default=1, help="inserts into different tables at a time")
    parser.add_argument("--arg", action="append", default=[], metavar="NAME=VALUE", help="named query parameter")
    parser.add_argument("--share", action="store_true", help="scan a source of several inserts once (batch)")
    parser.add_argument("--checkpoint", help="folder for the checkpoints of streams")
    parser.add_argument("--interval", help="go on for ever, a batch per interval such as '1 minute' (stream)")
    options = parser.parse_args(argv)
    if options.mode == "stream" and not options.checkpoint:
        parser.error("--mode stream needs --checkpoint")
    spark = build_session("sql-script")
    args = dict(pair.split("=", 1) for pair in options.arg)
    text = read_script(spark, options.sql_path)
    if options.mode == "stream":
        trigger = {"processingTime": options.interval} if options.interval else None
        queries = start_script(spark, text, options.checkpoint, options.sql_delimiter, args, trigger)
        for query in queries:
            query.awaitTermination()
        return len(queries)
    return run_script(spark, text, options.sql_delimiter, options.mode, args, options.parallel, options.share)


if __name__ == "__main__":
    main()
