"""Command line: ``python -m klaxon stream|metrics|overview|index|similar ...``

Under ``spark-submit`` give the package with ``--py-files`` and this file as program.
"""

import argparse

from klaxon import plans, sinks, sources
from klaxon.functions import decode_alerts
from klaxon.session import engine_session, job, store


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _stream(spark, args) -> None:
    raw = sources.stream_alerts(spark, args.source, args.input, **_options(args.option))
    trigger = None if args.once else args.trigger
    query = plans.count_stream(
        raw,
        args.output,
        args.checkpoint,
        trigger,
        sink=args.format,
        files=args.files,
        window=args.window,
        fraction=args.fraction,
    )
    query.awaitTermination()


def _write_all(results, output: str, single_file: bool = False) -> None:
    """Write each result to its folder below ``output``; what is shown is the beginning."""
    for name, frame in results.items():
        sinks.write_metrics(frame, f"{output}/{name}", "parquet", single_file=single_file)
        print(f"{name}: all rows in {output}/{name}, the first of them")
        frame.sparkSession.read.parquet(f"{output}/{name}").show(truncate=False)


def _metrics(spark, args) -> None:
    with job(spark, "metrics"):
        counts = sources.read_counts(spark, args.input, args.all_runs, args.format)
        result = plans.daily_metrics(counts, args.as_of)
        enriched = result.pop("enriched")
        sinks.write_metrics(enriched, f"{args.output}/enriched", single_file=args.single_file)
        result.pop("windows")
        _write_all(result, args.output, args.single_file)


def _overview(spark, args) -> None:
    with job(spark, "overview"):
        metrics = sources.read_metrics(spark, args.input, args.drifting)
        if metrics.isEmpty():
            print(f"no metrics in {args.input}")
            return
        _write_all(plans.overview(store(metrics, "metrics"), system=args.system), args.output)


def _index(spark, args) -> None:
    with job(spark, "index"):
        rows = plans.index_history(sources.read_history(spark, args.input), args.output)
    print(f"{rows} incidents indexed")


def _similar(spark, args) -> None:
    with job(spark, "similar"):
        raw = sources.read_alerts(spark, path=args.input)
        found = plans.similar_incidents(
            decode_alerts(raw, args.fraction), spark.read.parquet(args.corpus), args.k
        )
        found.write.mode("overwrite").parquet(args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="klaxon")
    commands = top.add_subparsers(required=True)

    def command(name, run, *paths):
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(path)
        return sub

    stream = command("stream", _stream, "output", "checkpoint")
    stream.add_argument("--source", default="kafka")
    stream.add_argument("--input", help="folder of a file source")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    stream.add_argument("--window", default="10 seconds")
    stream.add_argument("--trigger", default="10 seconds")
    stream.add_argument("--once", action="store_true", help="end when all input is read")
    stream.add_argument("--fraction", default="required", choices=["required", "optional"])
    stream.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    stream.add_argument("--files", type=int, help="tasks that write a batch; by default as its size asks for")

    metrics = command("metrics", _metrics, "input", "output")
    metrics.add_argument("--as-of", help="day as YYYY-MM-DD, by default today")
    metrics.add_argument("--all-runs", action="store_true")
    metrics.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    metrics.add_argument("--single-file", action="store_true")

    overview = command("overview", _overview, "input", "output")
    overview.add_argument("--system", default="All")
    overview.add_argument("--drifting", action="store_true")

    command("index", _index, "input", "output")

    similar = command("similar", _similar, "input", "corpus", "output")
    similar.add_argument("-k", type=int, default=5)
    similar.add_argument("--fraction", default="required", choices=["required", "optional"])
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(engine_session(), args)


if __name__ == "__main__":
    main()
