"""Run the whole job on an image folder from the command line.

usage: spark-submit tools/run_job.py --dir-path /data/images [--model-type AlexNet]
       [--epochs 50] [--batch-size-per-worker 30] [--workers N] [--averaging-frequency 5]
       [--height 100] [--width 100] [--channels 3] [--max-examples N] [--glob '*.jpg']
       [--master local[2]]

Prints the run's report: parameters, labels, evaluation, run times and one
sample prediction. Defaults are the original distributed job's.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.plans.job import JobConfig, run_job  # noqa: E402
from tessera.plans.models import preset  # noqa: E402
from tessera.plans.report import report_text  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.images import list_images, read_capped, read_images, to_tensors  # noqa: E402


def main(argv=None):
    a = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    a.add_argument("--dir-path", required=True)
    a.add_argument("--model-type", default="AlexNet")
    a.add_argument("--epochs", type=int, default=50)
    a.add_argument("--batch-size-per-worker", type=int, default=30)
    a.add_argument("--workers", type=int, default=None)  # by the number of rows
    a.add_argument("--averaging-frequency", type=int, default=5)
    a.add_argument("--height", type=int, default=100)
    a.add_argument("--width", type=int, default=100)
    a.add_argument("--channels", type=int, default=3)
    a.add_argument("--max-examples", type=int, default=None)
    a.add_argument("--glob", default="*.jpg")
    a.add_argument("--master", default=None, help="only for runs outside spark-submit, e.g. local[2]")
    args = a.parse_args(argv)

    spark = build_session(args.master)
    if args.max_examples is not None:  # cap the paths before any image is decoded
        images = read_capped(spark, args.dir_path, args.max_examples, glob=args.glob)
    else:
        images = read_images(spark, args.dir_path, glob=args.glob)
    # Classes from the path listing: no image is read or decoded for this.
    n_labels = list_images(spark, args.dir_path, args.glob).select("label").distinct().count()
    spec = preset(args.model_type, channels=args.channels, height=args.height, width=args.width,
                  num_labels=n_labels).with_scale(1 / 255)
    ex = to_tensors(images, args.height, args.width, args.channels, as_bytes=True) \
        .select(F.col("path").alias("id"), "label", "features")
    cfg = JobConfig(epochs=args.epochs, batch_size=args.batch_size_per_worker, workers=args.workers,
                    averaging_frequency=args.averaging_frequency)
    res = run_job(spark, ex, spec, cfg)
    print(report_text(res))
    res.release(delete_files=True)


if __name__ == "__main__":
    main()
