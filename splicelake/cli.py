"""Command line: ``python -m splicelake.cli --references DIR --outpath DIR --outname NAME``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .plans.config import ADD, DISABLE, KEEP, Config
from .plans.pipeline import Pending, Run, reports
from .sources import files, model


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="splicelake")
    for name in ("assemblies", "references", "sj-data", "genome", "quant", "fastq", "prefix", "outpath", "outname"):
        p.add_argument(f"--{name}")
    p.add_argument("--sj-reads", nargs=2, type=float, default=(2, 1), metavar=("READS", "SAMPLES"))
    p.add_argument("--tpm", nargs=2, type=float, default=(1, 1), metavar=("TPM", "SAMPLES"))
    p.add_argument("--fragment-len", type=float, default=0.7)
    p.add_argument("--antisense-len", type=float, default=0.5)
    p.add_argument("--add", nargs="*", default=(), choices=sorted(ADD))
    p.add_argument("--disable", nargs="*", default=(), choices=sorted(DISABLE))
    p.add_argument("--keep", nargs="*", default=(), choices=sorted(KEEP))
    p.add_argument("--quantify", action="store_true", help="count the reads of --fastq against the spliced transcripts instead of stopping for another quantifier")
    p.add_argument("--overwrite", action="store_true", help="write over the results of an earlier run; other files stay")
    p.add_argument("--resume", action="store_true", help="go on with an earlier run of the same options: stages whose tables are there aren't repeated")
    p.add_argument("--semantics", default="reference", choices=("reference", "corrected"))
    p.add_argument("--fastq-manifest", metavar="DIR", help="only print the pairs of read files in a folder")
    p.add_argument("--report-only", metavar="GTF", help="only write the report of one annotation")
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = vars(p.parse_args(argv))
    if not a["fastq_manifest"] and not (a["outpath"] and a["outname"]):
        p.error("--outpath and --outname are required")
    spark = SparkSession.builder.appName("splicelake").getOrCreate()
    fastq, single = a.pop("fastq_manifest"), a.pop("report_only")
    if fastq:
        for row in files.fastq_manifest(spark, fastq).toLocalIterator():
            print(*row, sep=",")
        return 0
    if single:
        reports(model.build(files.gtf(spark, single))[0], f"{a['outpath']}/{a['outname']}_report")
        return 0
    for name in ("add", "disable", "keep"):
        a[name] = frozenset(a[name])
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    try:
        Run(spark, Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in a.items()}))()
    except Pending as e:
        print(e)
        return 3
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
