"""spark-submit jobs/score_stream.py --requests DIR --model DIR --output DIR
--rejects DIR --checkpoint DIR [--available-now | --every '10 seconds']"""

from _common import parser, session


def main(argv=None, spark=None):
    """Run the job; a passed-in session is used and left running."""
    p = parser("Continuous trip-duration scoring of JSON requests")
    p.add_argument("--requests", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--rejects", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--every", default="10 seconds")
    p.add_argument("--shape", choices=("round", "trunc", "raw"), default="raw")
    a = p.parse_args(argv)
    from trip_engine.plans.score_requests import run
    own = spark is None
    spark = spark or session("score-stream", a.master)
    q = run(spark, a.requests, a.model, a.output, a.rejects, a.checkpoint, a.shape, a.available_now, a.every)
    q.awaitTermination()
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
