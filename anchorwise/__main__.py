"""python -m anchorwise JOB ...: runs a batch job."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="anchorwise", description=__doc__)
    top.add_argument("--master", help="Spark master; Spark's own setting by default")
    top.add_argument("--planfile", help="where generate and analyze write their physical plan")
    top.add_argument("--debug", action="store_true", help="run in this process")
    sub = top.add_subparsers(dest="job", required=True)
    p = sub.add_parser("dump", help="split a dump into articles and side tables")
    p.add_argument("--inputfile", required=True)
    p.add_argument("--outputdir", required=True)
    p.add_argument("--metadatadir", required=True)
    p.add_argument("--pagesperfile", type=int, default=100_000)
    p.add_argument("--numpages", type=int)
    p.add_argument("--samplepercent", type=float, default=100.0)
    p.add_argument("--compress", action="store_true")
    p = sub.add_parser("generate", help="find terms near links")
    p.add_argument("--inputdir", required=True)
    p.add_argument("--workingdir", required=True)
    p.add_argument("--maxdistance", type=int, default=100)
    p = sub.add_parser("analyze", help="score terms")
    p.add_argument("--workingdir", required=True)
    p.add_argument("--numarticles", type=int)
    p = sub.add_parser("markup", help="look at the markup of a dump: pairs, templates without a rule, categories, redirects")
    p.add_argument("--inputfile", required=True)
    p.add_argument("--outputdir", required=True)
    p.add_argument("--maxdistance", type=int, default=100)
    for name, what in (("category-graph", "build the category graph"), ("redirect-map", "build the redirect map")):
        p = sub.add_parser(name, help=what)
        p.add_argument("--inputfile", required=True)
        p.add_argument("--outputfile", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"anchorwise {a.job}")
    if a.debug or a.master:
        builder = builder.master("local[*]" if a.debug else a.master)
    spark = builder.getOrCreate()
    if a.job == "dump":
        out = jobs.dump_job(spark, a.inputfile, a.outputdir, a.metadatadir, pages_per_file=a.pagesperfile, num_pages=a.numpages, sample_percent=a.samplepercent, compress=a.compress)
    elif a.job == "generate":
        out = jobs.generate_job(spark, a.inputdir, a.workingdir, max_distance=a.maxdistance, plan_file=a.planfile)
    elif a.job == "analyze":
        out = jobs.analyze_job(spark, a.workingdir, num_articles=a.numarticles, plan_file=a.planfile)
    elif a.job == "markup":
        out = jobs.markup_job(spark, a.inputfile, a.outputdir, max_distance=a.maxdistance)
    elif a.job == "category-graph":
        out = {"nodes": jobs.category_graph_job(spark, a.inputfile, a.outputfile)}
    else:
        out = {"redirects": jobs.redirect_map_job(spark, a.inputfile, a.outputfile)}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
